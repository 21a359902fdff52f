"""Spelling variants: words one edit apart, found in a trie of letter counts, and the form each stands for.

Words are maximal runs of letters. Every word has a vector: how many of its letters fall into each of the
letter groups ``GROUPS``. The vectors form a trie, one level per group. Two words one edit apart differ by
at most one letter too many in one group (a surplus) and one too few in another (a deficit); so a word's
near words are found by a depth-first search that at every level goes on to the same count, to one more
while the surplus is unspent, and to one less while the deficit is unspent. Every pair is found from one
side only: the deficit may be spent behind the surplus, and of equal vectors the lesser word finds the
other. Words at the leaves are verified, first by the parities of all single letters, of which an edit
changes two at most, then letter by letter. A whole set of queries goes down together; subtrees of at most
``FEW`` words are compared at once.

The trie is dealt out by Spark. Counts of all prefixes give the nodes with more than ``bound`` words, the
larger of ``LEAST`` and a ``SHARDS``-th of all words: at most ``SHARDS`` per level, so this top of the trie
is small at every size and goes to all tasks. The subtrees below it are shards of at most ``bound`` words;
a full vector with more words is split by a hash of the word. Every word goes to its shard, and as a query,
with what is left of its budget, to all shards that its search reaches. A task holds the words of one
shard and a bounded number of queries at a time.

``counted_words`` can change single occurrences before counting (``slips``): of ``slips`` documents and runs
one loses a letter, as the hash of key and run decides.

Cases: a null or empty text has no words; a null key hashes as the empty string. Repeated rows count as
rows. Of near words with the same count the first in code-point order is the form. Words of any length
are compared. An empty table gives an empty result. Other columns do not matter.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from townform.llm.tables import staged, width

#: UTF-8 of [A-Za-zÀ-ÿ]+ once A-Z are lower-cased
RUN = re.compile(rb"(?:[a-z]+|\xc3[\x80-\xbf])+")
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))
COMMON = "enirtasduholcmgpbvfwkzjyqx"  # dealt in turns, so that groups are hit about equally often
LEVELS = 10
GROUPS = ["".join(c for c in LETTERS if (COMMON.index(c) if c in COMMON else ord(c)) % LEVELS == k) for k in range(LEVELS)]
LEAST = 4096
SHARDS = 4096
FEW = 8
HELD = 1 << 18     # different words that a task counts before it passes them on
QUERIES = 1 << 15  # that go down a trie together
PAIRS = 1 << 15    # compared at once
WIDE = 48          # letters of words compared as arrays; longer ones are compared one by one


# --- words and how often they stand -------------------------------------------------

def slip(run: bytes, h: int) -> bytes:
    """``run`` without one letter, the one that its hash says."""
    letters = run.decode()
    at = h % len(letters)
    return (letters[:at] + letters[at + 1:]).encode()


def counted_words(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = 6, often: int = 5, slips: int = 0) -> DataFrame:
    """word, n: words of at least ``least`` letters that stand at least ``often`` times in all texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def flush() -> pa.RecordBatch:
            long = [(w, n) for w, n in counts.items() if len(w) - w.count(b"\xc3") >= least]
            return pa.RecordBatch.from_arrays([pa.array([w.decode() for w, _ in long], pa.string()), pa.array([n for _, n in long], pa.int64())], ["word", "n"])

        for batch in batches:
            for name, body in zip(batch.column(0), batch.column(1)):
                runs = RUN.findall((body.as_py() or "").encode().lower())
                counts.update(runs)
                if slips:
                    named = crc32((name.as_py() or "").encode() + b":")
                    for word in [w for w in set(runs) if not crc32(w, named) % slips]:
                        n = runs.count(word)
                        counts[word] -= n
                        counts[slip(word, crc32(word, named))] += n
                if len(counts) > HELD:
                    yield flush()
                    counts.clear()
        yield flush()

    rows = docs.select(F.col(f"`{key}`").cast("string").alias("key"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= often)


def vector(word: Column) -> Column:
    """Letters of ``word`` in each group."""
    return F.array(*[(F.length(word) - F.length(F.translate(word, group, ""))).cast("int") for group in GROUPS])


# --- the top of the trie ------------------------------------------------------------

def heavy_nodes(words: DataFrame, bound: int) -> dict[tuple[int, ...], int]:
    """Prefixes of vectors with more than ``bound`` words, and how many they have."""
    prefixes = F.array(*[F.slice("v", 1, k) for k in range(LEVELS + 1)])
    rows = words.select(F.explode(prefixes).alias("prefix")).groupBy("prefix").agg(F.count("*").alias("n")).where(F.col("n") > bound)
    return {tuple(r["prefix"]): r["n"] for r in rows.collect()}  # at most SHARDS for each level


def reached(v: tuple[int, ...], heavy: dict[tuple[int, ...], int], bound: int) -> list[tuple[str, bool, bool]]:
    """Shards that the search for ``v`` enters, with the surplus and the deficit left there."""
    out = []

    def down(node: tuple[int, ...], surplus: bool, deficit: bool) -> None:
        name = ".".join(map(str, node))
        if node not in heavy:
            out.append((name, surplus, deficit))
        elif len(node) == LEVELS:
            out.extend((f"{name}#{k}", surplus, deficit) for k in range(-(-heavy[node] // bound)))
        else:
            own = v[len(node)]
            down((*node, own), surplus, deficit)
            if surplus:
                down((*node, own + 1), False, deficit)
            if deficit and own and not surplus:
                down((*node, own - 1), surplus, False)

    down((), True, True)
    return out


def dealt(words: DataFrame, heavy: dict[tuple[int, ...], int], bound: int) -> DataFrame:
    """Rows of shards: every word once as a word, and as a query wherever its search goes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known: dict[tuple[int, ...], list] = {}
            cells, source = [], []
            for k, (word, v) in enumerate(zip(batch.column(0).to_pylist(), map(tuple, batch.column(2).to_pylist()))):
                ways = known.get(v)
                if ways is None:
                    ways = known[v] = reached(v, heavy, bound)
                node = next(v[:d] for d in range(LEVELS + 1) if v[:d] not in heavy or d == LEVELS)
                home = ".".join(map(str, node))
                if node in heavy:
                    home += f"#{crc32(word.encode()) % -(-heavy[node] // bound)}"
                cells.append((home, False, True, True))
                cells.extend((name, True, s, d) for name, s, d in ways)
                source.extend([k] * (1 + len(ways)))
                if len(source) > PAIRS:
                    yield rows(batch, cells, source)
                    cells, source = [], []
            if source:
                yield rows(batch, cells, source)

    def rows(batch: pa.RecordBatch, cells: list, source: list[int]) -> pa.RecordBatch:
        given = batch.take(pa.array(source))
        return pa.RecordBatch.from_arrays([*map(pa.array, zip(*cells)), *given.columns], ["shard", "asks", "surplus", "deficit", "word", "n", "v"])

    return words.select("word", "n", "v").mapInArrow(run, "shard string, asks boolean, surplus boolean, deficit boolean, word string, n long, v array<int>")


# --- the search in one shard --------------------------------------------------------

class Asked:
    """Words as arrays: letters (one byte each, as none is beyond U+00FF), their parities, counts and vectors."""

    def __init__(self, words: list[str], n: list[int], v: list[list[int]]):
        self.words = np.array([w.encode("latin-1") for w in words], object)
        self.n, self.v = np.array(n, np.int64), np.array(v, np.int8 if max(map(max, v)) < 64 else np.int32).reshape(-1, LEVELS)
        self.size = np.array([len(w) for w in words], np.int64)
        self.wide = min(WIDE, int(self.size.max()) + 1)
        self.letters = np.array([w[:self.wide] for w in self.words], f"S{self.wide}").view(np.uint8).reshape(-1, self.wide)
        flat = np.frombuffer(b"".join(self.words), np.uint8)
        bits = np.left_shift(np.uint64(1), (flat & 63).astype(np.uint64))
        self.parity = np.bitwise_xor.reduceat(bits, np.cumsum(self.size) - self.size)

    def sorted(self) -> Asked:
        order = np.lexsort(self.v.T[::-1])
        out = object.__new__(Asked)
        out.words, out.n, out.v, out.size, out.letters, out.parity = (
            a[order] for a in (self.words, self.n, self.v, self.size, self.letters, self.parity))
        out.wide = self.wide
        return out

    def padded(self, wide: int) -> np.ndarray:
        return np.pad(self.letters, ((0, 0), (0, wide - self.wide)))


def one_edit(a: bytes, b: bytes) -> bool:
    """Whether one letter inserted, deleted or replaced makes ``a`` of ``b``."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    short = min(len(a), len(b))
    ahead = next((k for k in range(short) if a[k] != b[k]), short)
    return a[ahead + 1:] == b[ahead + (len(a) == len(b)):] if len(a) >= len(b) else a[ahead:] == b[ahead + 1:]


def verified(asks: Asked, letters_q: np.ndarray, q: np.ndarray, words: Asked, letters_w: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Which of the pairs are one edit apart."""
    a, b = letters_q[q], letters_w[w]
    la, lb = asks.size[q], words.size[w]
    wide = a.shape[1]
    apart = a != b
    near = (la == lb) & (apart.sum(axis=1) == 1)
    for k in (1, -1):  # the longer without its letter at the first difference
        some = np.flatnonzero(lb - la == k)
        short, long = (a[some], b[some]) if k > 0 else (b[some], a[some])
        ahead = np.where(apart[some].any(axis=1), apart[some].argmax(axis=1), wide)[:, None]
        near[some] = ((short[:, :-1] == long[:, 1:]) | (np.arange(wide - 1) < ahead)).all(axis=1)
    for k in np.flatnonzero(np.maximum(la, lb) >= wide):
        near[k] = one_edit(asks.words[q[k]], words.words[w[k]])
    return near


def candidates(asks: Asked, surplus: np.ndarray, deficit: np.ndarray, words: Asked, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (query, word) whose vectors the budgets allow, by a depth-first search from ``depth``. ``words`` are sorted."""
    stack = [(depth, 0, len(words.n), np.arange(len(asks.n)), surplus, deficit)]
    while stack:
        depth, low, high, who, s, d = stack.pop()
        if depth == LEVELS or high - low <= FEW:
            for first in range(0, high - low, FEW):
                some = np.arange(low + first, min(low + first + FEW, high))
                more = words.v[some, depth:][None] - asks.v[who, depth:][:, None]
                parted = np.bitwise_count(words.parity[some][None] ^ asks.parity[who][:, None]) <= 2
                q, w = np.nonzero(parted & ((more > 0).sum(axis=2) <= s[:, None]) & ((more < 0).sum(axis=2) <= d[:, None]) & (np.abs(more) <= 1).all(axis=2))
                more, s_, who_ = more[q, w], s[q], who[q]
                first_sign = np.take_along_axis(more, (more != 0).argmax(axis=1)[:, None], 1)[:, 0] if depth < LEVELS else np.zeros(len(q))
                same = s_ & (first_sign == 0)
                keep = ~s_ | (first_sign == 1)
                keep[same] = asks.words[who_[same]] < words.words[some[w[same]]]
                if keep.any():
                    yield who_[keep], some[w[keep]]
            continue
        column = words.v[low:high, depth]
        cut = low + np.flatnonzero(np.diff(column, prepend=-1))
        own = asks.v[who, depth]
        for first, last in zip(cut, np.append(cut[1:], high)):
            more = words.v[first, depth] - own
            goes = (more == 0) | ((more == 1) & s) | ((more == -1) & d & ~s)
            if goes.any():
                more = more[goes]
                stack.append((depth + 1, first, last, who[goes], s[goes] & (more != 1), d[goes] & (more != -1)))


def _most_frequent(own: Asked, k: np.ndarray, other: Asked, m: np.ndarray) -> pa.RecordBatch:
    """For every ``own`` word of the pairs: how many others, and the most frequent, the first of equal ones."""
    place = np.empty(len(other.n), np.int64)
    place[np.argsort(other.words)] = np.arange(len(other.n))  # code-point order
    order = np.lexsort((place[m], -other.n[m], k))
    k, m = k[order], m[order]
    first = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
    best = m[first]
    word, form = ([x.decode("latin-1") for x in group] for group in (own.words[k[first]], other.words[best]))
    return pa.RecordBatch.from_arrays([pa.array(word), pa.array(np.diff(np.append(first, len(k)))), pa.array(other.n[best]), pa.array(form)],
                                      ["word", "near", "form_n", "form"])


def nearest(asks: Asked, surplus: np.ndarray, deficit: np.ndarray, words: Asked, depth: int) -> Iterator[pa.RecordBatch]:
    """For every word of a pair found in the shard: how many partners it has there, and the most frequent of them."""
    wide = max(asks.wide, words.wide)
    letters = asks.padded(wide), words.padded(wide)
    found, open_, size = [], [], 0

    def settle() -> None:
        q, w = (np.concatenate([p[k] for p in open_]) for k in (0, 1))
        keep = verified(asks, letters[0], q, words, letters[1], w)
        found.append((q[keep], w[keep]))
        open_.clear()

    for q, w in candidates(asks, surplus, deficit, words, depth):
        for first in range(0, len(q), PAIRS):
            open_.append((q[first:first + PAIRS], w[first:first + PAIRS]))
            size += len(open_[-1][0])
            if size >= PAIRS:
                settle()
                size = 0
    if open_:
        settle()
    q, w = (np.concatenate([p[k] for p in found] or [np.zeros(0, np.int64)]) for k in (0, 1))
    if len(q):
        yield _most_frequent(asks, q, words, w)
        yield _most_frequent(words, w, asks, q)


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shards one after another, words ahead of queries."""
    shard, trie, words, asks = None, None, [], []

    def settle() -> Iterator[pa.RecordBatch]:
        nonlocal trie, asks
        if asks and words:
            trie = trie or Asked(*zip(*words)).sorted()
            depth = LEVELS if "#" in shard else shard.count(".") + 1 if shard else 0
            s, d, *rest = zip(*asks)
            yield from nearest(Asked(*rest), np.array(s), np.array(d), trie, depth)
        asks = []

    for batch in batches:
        for name, is_query, s, d, word, n, v in zip(*(c.to_pylist() for c in batch.columns)):
            if name != shard:
                yield from settle()
                shard, trie, words = name, None, []
            if not is_query:
                words.append((word, n, v))
            elif words:
                asks.append((s, d, word, n, v))
                if len(asks) >= QUERIES:
                    yield from settle()
    yield from settle()


def near_words(words: DataFrame, least: int = LEAST, shards: int = SHARDS) -> DataFrame:
    """word, near, form, form_n for the words (word, n) that have others one edit apart: their number and the most frequent one."""
    rows = staged(words.select("word", "n", vector(F.col("word")).alias("v")), "vectors")
    bound = max(least, -(-rows.count() // shards))
    pieces = dealt(rows.repartition(width(words.sparkSession)), heavy_nodes(rows, bound), bound)
    found = pieces.repartition("shard").sortWithinPartitions("shard", "asks", "word").mapInArrow(_search, "word string, near long, form_n long, form string")
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form"))
    return (found.groupBy("word").agg(F.sum("near").alias("near"), best.alias("best"))
            .select("word", "near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n")))


def roots(forms: DataFrame) -> DataFrame:
    """word, root for the words (word, form) with a form: the last of the chain, by doubling. Chains have no circles."""
    ways = staged(forms.select("word", F.col("form").alias("root")), "ways")
    while True:
        ahead = ways.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = staged(ways.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "ways")
        if further.where("moved").isEmpty():
            return further.select("word", "root")
        ways = further.select("word", "root")


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = 6, often: int = 5, times: int = 5, slips: int = 0, **how: int) -> DataFrame:
    """word, form, root, n, n_near, form_n for every counted word.

    A form has at least ``times`` the word's count, so counts grow along chains of forms.
    """
    words = staged(counted_words(docs, key, text, least, often, slips), "words")
    near = near_words(words, **how)
    stands = F.col("form_n") >= times * F.col("n")
    table = staged(words.join(near, "word", "left").select(
        "word", F.when(stands, F.col("form")).alias("form"), "n", F.coalesce("near", F.lit(0)).cast("long").alias("n_near"),
        F.when(stands, F.col("form_n")).alias("form_n")), "forms")
    return (table.join(roots(table.where("form is not null")), "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
