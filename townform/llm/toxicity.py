"""Toxicity: a lexicon trie met with Levenshtein automata, hits weighed by their context.

Fit, on at most ``FIT_ROWS`` labelled documents drawn by a hash of the identifier (a bound on what
is gathered, a parameter): near copies among them count once, and what always stands between the same words does not count; words and stems (the first 4 to 6
bytes) that stand almost only in toxic ones become the lexicon, at most ``TERMS``. A logistic
regression then weighs a document's hits.

Search: the trie of the lexicon and, for whole words of ``FUZZY`` bytes or more, the automata of all
spellings one edit away are one nondeterministic machine, made deterministic once. All words of a
batch run through its table together, one byte per step; most are dead after a few bytes.

Context: a hit counts less inside a quotation (an odd number of quotation marks of a kind ahead of it in
its paragraph, however long; the kinds are the straight, the curly and the angle marks, and a paragraph
begins behind a blank line, where quotations that go on are opened anew), and hits within ``NEAR`` words of each other add up to a window score, so abuse
in a row weighs more than a word that is quoted.

Every whole text is scored. Cases: a null or empty text has no hits and gets the score of such
texts. Null labels and labels without a document teach nothing; without toxic examples every score
is that of a text without hits. Repeated documents are each scored, repeated labels weigh more.
Empty tables give empty results; other columns do not matter.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from townform.llm.tables import staged
from townform.llm.words import ALNUM, NOT_BLANK, mix, split_words, text_slices, window_prints

FIT_ROWS, TERMS, FUZZY, NEAR = 20_000, 400, 5, 20
MIN_DOCS, MIN_SHARE, PURITY = 6, 0.02, 0.97
APART = 0.7
STEMS = (4, 5, 6)
QUOTED, MISSPELLED = 0.25, 0.5
WORD = re.compile(rb"[a-z0-9\x80-\xff]+")
NONE, NEARLY, EXACT = 0, 1, 2


@dataclass
class Machine:
    """Deterministic automaton: ``step[state, class of byte]``, what a word that ends there is, and stems met."""

    classes: np.ndarray
    step: np.ndarray
    ends: np.ndarray
    stem: np.ndarray

    def spot(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the words that hit, and how (NEARLY or EXACT)."""
        lanes, state = np.arange(len(starts)), np.zeros(len(starts), np.int64)
        found, how = [], []
        at = 0
        while len(lanes):
            over = starts[lanes] + at >= ends[lanes]
            if over.any():
                kind = self.ends[state[over]]
                found.append(lanes[over][kind > 0])
                how.append(kind[kind > 0])
                lanes, state = lanes[~over], state[~over]
            state = self.step[state, self.classes[buf[starts[lanes] + at]]]
            met = self.stem[state]
            found.append(lanes[met])
            how.append(np.full(int(met.sum()), EXACT, np.int8))
            live = (state >= 0) & ~met
            lanes, state, at = lanes[live], state[live], at + 1
        which = np.concatenate(found or [np.zeros(0, np.int64)])
        kind = np.concatenate(how or [np.zeros(0, np.int8)])
        order = np.argsort(which, kind="stable")
        return which[order], kind[order]


@dataclass
class Trie:
    next: list[dict[int, int]] = field(default_factory=lambda: [{}])
    word: list[bool] = field(default_factory=lambda: [False])
    stem: list[bool] = field(default_factory=lambda: [False])

    def add(self, term: bytes, stem: bool = False) -> None:
        at = 0
        for c in term:
            if c not in self.next[at]:
                self.next[at][c] = len(self.next)
                self.next.append({})
                self.word.append(False)
                self.stem.append(False)
            at = self.next[at][c]
        (self.stem if stem else self.word)[at] = True


def machine(words: list[bytes], stems: list[bytes], fuzzy: int = FUZZY, edits: int = 1) -> Machine:
    """Meet the trie of all terms with the automata of at most ``edits`` edits of the longer words."""
    trie, long_trie = Trie(), Trie()
    for w in words:
        trie.add(w)
        if len(w) >= fuzzy:
            long_trie.add(w)
    for s in stems:
        trie.add(s, stem=True)
    alphabet = sorted({c for t in (*words, *stems) for c in t})
    classes = np.zeros(256, np.int64)
    for k, c in enumerate(alphabet):
        classes[c] = k + 1

    def closed(states: set[tuple[int, int, int]]) -> frozenset:
        todo, out = list(states), set(states)
        while todo:  # an edit may leave out a byte of the word
            which, node, e = todo.pop()
            if which and e < edits:
                for child in long_trie.next[node].values():
                    if (new := (1, child, e + 1)) not in out:
                        out.add(new)
                        todo.append(new)
        return frozenset(out)

    def after(states: frozenset, c: int | None) -> frozenset:
        out = set()
        for which, node, e in states:
            tree = long_trie if which else trie
            if c is not None and c in tree.next[node]:
                out.add((which, tree.next[node][c], e))
            if which and e < edits:
                out.add((1, node, e + 1))
                out.update((1, child, e + 1) for child in tree.next[node].values())
        return closed(out)

    first = closed({(0, 0, 0), (1, 0, 0)})
    number, queue, rows = {first: 0}, [first], []
    for states in queue:
        row = []
        for c in (None, *alphabet):
            to = after(states, c)
            if not to:
                row.append(-1)
                continue
            if to not in number:
                number[to] = len(queue)
                queue.append(to)
            row.append(number[to])
        rows.append(row)
    ends = [EXACT if any(not w and trie.word[n] for w, n, _ in s) else NEARLY if any(w and long_trie.word[n] for w, n, _ in s) else NONE
            for s in queue]
    stem = [any(not w and trie.stem[n] for w, n, _ in s) for s in queue]
    return Machine(classes, np.array(rows, np.int64), np.array(ends, np.int8), np.array([*stem, False], bool))


def in_quotation(buf: np.ndarray, offsets: np.ndarray, place: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Whether a quotation is open at each place."""
    ends = np.flatnonzero(buf == 0x0A)
    solid = np.concatenate([[0], np.cumsum(NOT_BLANK[buf])])
    breaks = ends[1:][solid[ends[1:]] == solid[ends[:-1]]]  # nothing but blanks since the last line's end
    opened = np.concatenate([[0], breaks + 1])
    begin = np.maximum(offsets[row], opened[np.searchsorted(opened, place, "right") - 1])
    one, two = np.append(buf[1:], [0]), np.append(buf[2:], [0, 0])[:len(buf)]
    curly = (buf == 0xE2) & (one == 0x80) & (two >= 0x9C) & (two <= 0x9F)
    angle = (buf == 0xC2) & ((one == 0xAB) | (one == 0xBB))
    quoted = np.zeros(len(place), bool)
    for kind in (buf == 0x22, curly, angle):
        marks = np.concatenate([[0], np.cumsum(kind)])
        quoted |= (marks[place] - marks[begin]) % 2 == 1
    return quoted


def features(buf: np.ndarray, offsets: np.ndarray, auto: Machine) -> np.ndarray:
    """Of each text: hits outside quotations, misspelled ones, quoted ones, the best window score (all as log(1 + x))."""
    words = split_words(buf, offsets, ALNUM, prints=False)
    which, how = auto.spot(words.buf, words.starts, words.ends)
    n, row, place = len(offsets) - 1, words.row[which], words.starts[which]
    quoted = in_quotation(words.buf, offsets, place, row)
    weight = np.where(how == EXACT, 1.0, MISSPELLED) * np.where(quoted, QUOTED, 1.0)
    sums = np.concatenate([[0.0], np.cumsum(weight)])
    # words are numbered through all texts: a window ends with its text as well
    low = np.searchsorted(which, np.maximum(which - NEAR, words.first[row]))
    high = np.searchsorted(which, np.minimum(which + NEAR, words.first[row + 1] - 1), "right")
    out = np.zeros((n, 4))
    for k, chosen in enumerate(((how == EXACT) & ~quoted, (how == NEARLY) & ~quoted, quoted)):
        out[:, k] = np.bincount(row[chosen], minlength=n)
    np.maximum.at(out[:, 3], row, sums[high] - sums[low])
    return np.log1p(out)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Weights of a ridge logistic regression, the intercept first."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    keep = np.full(len(w), ridge)
    keep[0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + keep * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(keep), grad)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return w


@dataclass
class Model:
    words: list[bytes]
    stems: list[bytes]
    weights: np.ndarray
    _auto: Machine | None = None

    def auto(self) -> Machine:
        if self._auto is None:
            self._auto = machine(self.words, self.stems)
        return self._auto

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_auto": None}  # every worker builds its own

    def score(self, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        x = features(buf, offsets, self.auto())
        return 1 / (1 + np.exp(-np.clip(self.weights[0] + x @ self.weights[1:], -30, 30)))


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Three smallest-shingle hashes of each text; near copies share most of them."""
    for batch in batches:
        for begin, buf, offsets in text_slices(batch.column(1)):
            words = split_words(buf, offsets, NOT_BLANK)
            prints, at = window_prints(words, 3)
            n = len(offsets) - 1
            cols = []
            for seed in (1, 2, 3):
                least = np.full(n, np.iinfo(np.uint64).max, np.uint64)
                np.minimum.at(least, words.row[at], mix(prints * np.uint64(2 * seed + 1)))
                cols.append(pa.array(least.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, n), *cols], ["id", "m1", "m2", "m3"])


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of either label that hold a term (``=`` a word, ``^`` a stem)."""
    for batch in batches:
        for begin in range(0, batch.num_rows, 400):
            toxic, clean = Counter(), Counter()
            part = batch.slice(begin, 400)
            for text, label in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                terms = set()
                for w in set(WORD.findall((text or "").encode().lower())):
                    if len(w) >= STEMS[0]:
                        terms.add(b"=" + w)
                        terms.update(b"^" + w[:k] for k in STEMS if len(w) > k)
                (toxic if label else clean).update(terms)
            names = list(toxic.keys() | clean.keys())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array([toxic[t] for t in names], pa.int64()),
                                              pa.array([clean[t] for t in names], pa.int64())], ["term", "toxic", "clean"])


def _contexts(terms: frozenset[bytes]):
    """The words before and after each occurrence of a term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = set()
            for text in batch.column(0).to_pylist():
                words = [b"", *WORD.findall((text or "").encode().lower()), b""]
                for before, w, after in zip(words, words[1:], words[2:]):
                    if len(w) >= STEMS[0]:
                        out.update((t, before + b" " + after) for t in (b"=" + w, *(b"^" + w[:k] for k in STEMS)) if t in terms)
            names = list(out)
            yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in names], pa.binary()), pa.array([c for _, c in names], pa.binary())], ["term", "context"])
    return run


def lexicon(rows: list[tuple[bytes, int]], most: int = TERMS) -> tuple[list[bytes], list[bytes]]:
    """Words and stems from (term, toxic documents). A stem must gather several words; what it covers goes."""
    support = {t: n for t, n in rows}
    stems = []
    for t in sorted((t for t in support if t[:1] == b"^"), key=lambda t: (len(t), t)):
        single = max((n for w, n in support.items() if w[:1] == b"=" and w[1:].startswith(t[1:])), default=0)
        if single < 0.6 * support[t] and not any(t[1:].startswith(s) for s in stems):
            longest = max((u for u in support if u.startswith(t) and support[u] >= 0.95 * support[t]), key=lambda u: (len(u), u))
            stems.append(longest[1:])
    words = [t[1:] for t in support if t[:1] == b"=" and not t[1:].startswith(tuple(stems) or (b"\xff\xff",))]
    rank = sorted([(-support[b"=" + w], w, False) for w in words] + [(-support[b"^" + s], s, True) for s in stems])[:most]
    return [w for _, w, stem in rank if not stem], [w for _, w, stem in rank if stem]


def fit(docs: DataFrame, labels: DataFrame, learns: Column, key: str = "doc_id", text: str = "text", label: str = "toxic",
        fit_rows: int = FIT_ROWS) -> Model:
    """Learn from the labelled documents that ``learns`` (a condition on the identifier) admits."""
    drawn = (labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & learns)
             .select(F.col(key).alias("id"), (F.col(label) > 0).cast("int").alias("label"))
             .orderBy(F.xxhash64("id"), "id", "label").limit(fit_rows))
    plain = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    sample = staged(plain.join(F.broadcast(drawn), "id"), "labelled")  # at most fit_rows identifiers are broadcast
    apart = sample.select("id", "text").mapInArrow(_sketch, "id long, m1 long, m2 long, m3 long")
    for m in ("m1", "m2", "m3"):  # of near copies the least stays, however the rows are dealt
        apart = apart.groupBy(m).agg(F.min(F.struct("id", "m1", "m2", "m3")).alias("row")).select("row.*")
    apart = staged(apart.select("id").distinct(), "apart")  # at most fit_rows, as drawn has no more
    once = staged(sample.join(F.broadcast(apart), "id", "left_semi"), "once")
    n_toxic = once.where("label = 1").count()
    least = max(MIN_DOCS, int(MIN_SHARE * n_toxic))
    terms = (once.mapInArrow(_counts, "term binary, toxic long, clean long").groupBy("term")
             .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
             .where((F.col("toxic") >= least) & (F.col("toxic") >= PURITY * (F.col("toxic") + F.col("clean"))))
             .orderBy(F.desc("toxic"), "term").limit(20 * TERMS).collect())
    # a term of abuse stands between all kinds of words; what copied passages share stands between the same
    counts = {bytes(r["term"]): r["toxic"] for r in terms}
    around = {bytes(r["term"]): r["n"] for r in once.where("label = 1").select("text")
              .mapInArrow(_contexts(frozenset(counts)), "term binary, context binary").distinct()
              .groupBy("term").agg(F.count("*").alias("n")).collect()}
    words, stems = lexicon([(t, n) for t, n in counts.items() if around.get(t, 0) >= APART * n])
    bare = Model(words, stems, np.zeros(5))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, buf, offsets in text_slices(batch.column(0)):
                x = features(buf, offsets, bare.auto())
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(begin, len(x)), *map(pa.array, x.T)], ["row", "a", "b", "c", "d"])

    # rows of repeated identifiers beyond the bound go in the order of a hash, not of partitions
    seen = np.array(sample.select("text", F.struct("id", "label").alias("row"))
                    .mapInArrow(measure, "row struct<id: long, label: int>, a double, b double, c double, d double")
                    .orderBy(F.xxhash64("row.id"), "row", "a", "b", "c", "d").limit(2 * fit_rows)
                    .select("row.label", "a", "b", "c", "d").collect(), float)
    if not len(seen):
        return Model([], [], np.array([-3.0, 0, 0, 0, 0]))
    order = np.lexsort(seen.T)
    return Model(words, stems, logistic(seen[order, 1:], seen[order, 0]))


def scored(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, score."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, buf, offsets in text_slices(batch.column(1)):
                n = len(offsets) - 1
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, n), pa.array(model.score(buf, offsets), pa.float64())], ["doc_id", "score"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double").withColumnRenamed("doc_id", key)


def without_toxic(docs: DataFrame, model: Model, text: str = "text", threshold: float = 0.7) -> DataFrame:
    """The documents whose score is below the threshold, with all their columns."""
    place, plain = docs.columns.index(text), docs.toDF(*(f"c{k}" for k in range(len(docs.columns))))  # mapInArrow takes no names with dots

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, buf, offsets in text_slices(batch.column(place)):
                keep = model.score(buf, offsets) < threshold
                yield batch.slice(begin, len(keep)).filter(pa.array(keep))

    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)
