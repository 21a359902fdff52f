"""Alignment of the tokens of two tokenizers, and how often ids are linked in the whole corpus.

Every text is tokenised whole by both sides. Where a token of either side that begins with a space starts
at the same byte, both sides end there: such anchors split a text into windows of ids, mostly one word
each. A window's alignment, the groups between all byte offsets where tokens of both sides end, hangs on
its ids only, so it is remembered by its ids of both sides and computed once (a worker remembers ``MEMO``
of them). Side A gets a space and the text; side B, which adds that space itself, the text.

An A id and a B id are linked where they share a group. ``scores`` counts for every pair of ids the
documents that hold it linked: documents give their different pairs once, Spark sums them with partial
sums ahead of the exchange. The table of pairs is bounded by the vocabularies, not by the corpus; it is
broadcast to the second pass while it has at most ``PAIRS`` rows, otherwise joined by an exchange. Links of
one document are summed ahead of the exchange that follows, as its rows stand together.

Cases: texts that are null or empty, and texts whose tokens on either side do not join up to a space and
the text, have no tokens, no groups and no links. Strings of special tokens inside texts are plain text.
Repeated rows are documents of their own, and a null key is a key like any other. An empty table gives an
empty result. Other columns do not matter.
"""

from __future__ import annotations

import base64
import json
import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from townform.llm.packing import byte_level, text_groups
from townform.llm.tables import staged

MEMO = 1 << 18
PAIRS = 1 << 21
SIGN = 0xFFFFFFFF  # no id
LARGE = 1 << 12    # pairs of a group that are listed one by one
LINK = StructType([StructField("a", IntegerType()), StructField("b", IntegerType()), StructField("n", LongType())])
#: Letters whose class no Unicode version disputes: only texts of these go the faster way.
DISPUTED = re.compile("[^\x00-ɏ]")


class ByteLevel:
    """A byte-level tokenizer file; ``ranks`` are the same vocabulary, for texts that both read alike."""

    def __init__(self, path: str, ranks: str | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        byte = byte_level()
        vocabulary = self.tokenizer.get_vocab()
        special = {t["content"] for t in json.load(open(path))["added_tokens"]}
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            self.bytes[number] = token.encode() if token in special else bytes(byte[c] for c in token)
        self.fast = None
        if ranks:
            import tiktoken
            of = {base64.b64decode(t): int(n) for t, n in map(bytes.split, open(ranks, "rb"))}
            if all(self.bytes[n] == t for t, n in of.items()):
                self.fast = tiktoken.Encoding("side", pat_str=public_tokenizers.PATTERN, mergeable_ranks=of, special_tokens={})

    def __call__(self, texts: list[str]) -> list[list[int]]:
        texts = [f" {t}" for t in texts]
        slow = [k for k, t in enumerate(texts) if self.fast is None or DISPUTED.search(t)]
        out = [[]] * len(texts)
        for k, found in zip(slow, self.tokenizer.encode_batch([texts[k] for k in slow], add_special_tokens=False)):
            out[k] = found.ids
        for k in sorted(set(range(len(texts))).difference(slow)):
            out[k] = self.fast.encode_ordinary(texts[k])
        return out


class Pieces:
    """A sentence-piece model that adds a space ahead of the text."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        self.model = SentencePieceProcessor(model_file=path)
        ids = range(self.model.get_piece_size())
        names = [self.model.id_to_piece(k) for k in ids]
        self.bytes = [bytes([int(n[3:5], 16)]) if self.model.is_byte(k) else n.replace("▁", " ").encode() for k, n in zip(ids, names)]

    def __call__(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


class Aligner:
    """Windows and their alignments for two sides."""

    def __init__(self, a, b):
        self.sides = (a, b)
        self.lengths = [np.array([len(t) for t in s.bytes], np.int64) for s in self.sides]
        self.names = [[np.array([f"{k}{sign}" for k in range(len(s.bytes))], object) for sign in signs] for s, signs in zip(self.sides, (",|", ",;"))]
        self.marked = [np.array([t[:1] == b" " for t in s.bytes]) for s in self.sides]
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.groups, self.texts, self.links = array("q"), [], array("q")
        self.codes, self.times, self.first = array("q"), array("q"), array("q", [0])

    def learn(self, a: np.ndarray, cut_a: np.ndarray, b: np.ndarray, cut_b: np.ndarray) -> None:
        """Align windows: ids of both sides in a row and where each window's ids begin, the end included."""
        width, n = len(self.sides[1].bytes), len(cut_a) - 1
        ends = [np.cumsum(size[ids]) for size, ids in zip(self.lengths, (a, b))]
        common = np.intersect1d(*ends, assume_unique=True)  # groups end here, windows among them
        group_a, group_b = (np.searchsorted(common, e) for e in ends)
        in_a, in_b = (np.bincount(g, minlength=len(common)) for g in (group_a, group_b))
        window = np.searchsorted(ends[0][cut_a[1:] - 1], common)
        self.groups.extend(np.bincount(window, minlength=n).tolist())
        self.links.extend(np.bincount(window, in_a * in_b, n).astype(np.int64).tolist())
        self.texts.extend(self._texts(a, group_a, b, group_b, window))
        # pairs of a group: every A id with every B id; of large groups, different ids only and how often
        large = in_a * in_b > LARGE
        of_a = np.flatnonzero(~large[group_a])
        reps = in_b[group_a[of_a]]
        begin_b = np.cumsum(in_b) - in_b
        at_b = np.arange(reps.sum()) + np.repeat(begin_b[group_a[of_a]] - np.cumsum(reps) + reps, reps)
        code = np.repeat(a[of_a].astype(np.int64), reps) * width + b[at_b]
        owner, times = np.repeat(window[group_a[of_a]], reps), np.ones(len(code), np.int64)
        for g in np.flatnonzero(large):
            ids, n_a = np.unique(a[group_a == g].astype(np.int64), return_counts=True)
            others, n_b = np.unique(b[group_b == g].astype(np.int64), return_counts=True)
            code = np.append(code, (ids[:, None] * width + others).ravel())
            times = np.append(times, np.outer(n_a, n_b).ravel())
            owner = np.append(owner, np.full(len(ids) * len(others), window[g]))
        if large.any():
            order = np.argsort(owner, kind="stable")
            code, times, owner = code[order], times[order], owner[order]
        first = self.first[-1]
        self.codes.frombytes(code.tobytes())
        self.times.frombytes(times.tobytes())
        self.first.extend((first + np.cumsum(np.bincount(owner, minlength=n))).tolist())

    def _texts(self, a: np.ndarray, group_a: np.ndarray, b: np.ndarray, group_b: np.ndarray, window: np.ndarray) -> list[str]:
        """Groups of windows as text: ids with a comma behind, the last of a group on either side with its own sign."""
        parts = [np.where(np.append(g[1:] != g[:-1], True), last[ids], more[ids]) for ids, g, (more, last) in
                 zip((a, b), (group_a, group_b), self.names)]
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        listed = np.concatenate(parts)[order].tolist()
        sizes = np.bincount(window[group_a], minlength=window[-1] + 1) + np.bincount(window[group_b], minlength=window[-1] + 1)
        cut = [0, *np.cumsum(sizes).tolist()]
        return ["".join(listed[i:j])[:-1] for i, j in zip(cut, cut[1:])]

    def __call__(self, texts: list[str]) -> list[pa.Array]:
        """n_a, n_b, n_groups, n_links, groups and links of every text."""
        if len(self.known) > MEMO:
            self.forget()
        ids = [side(texts) for side in self.sides]
        size = np.zeros(len(texts), np.int64)
        for k, text in enumerate(texts):
            whole = b" " + text.encode()
            if text and all(b"".join(map(s.bytes.__getitem__, of[k])) == whole for s, of in zip(self.sides, ids)):
                size[k] = len(whole)
            else:
                ids[0][k], ids[1][k] = [], []
        counts = [np.fromiter(map(len, of), np.int64, len(texts)) for of in ids]
        flat = [np.fromiter(chain.from_iterable(of), np.uint32, n.sum()) for of, n in zip(ids, counts)]
        begins = [np.cumsum(n[f]) - n[f] for n, f in zip(self.lengths, flat)]
        # common begins of tokens with a space, those of texts among them: both sides end there
        cut = np.intersect1d(*(begin[m[f]] for begin, m, f in zip(begins, self.marked, flat)), assume_unique=True)
        at = [np.append(np.searchsorted(begin, cut), len(f)) for begin, f in zip(begins, flat)]
        # a window's key: its A ids, a sign, its B ids
        row = np.full(len(flat[0]) + len(flat[1]) + len(cut), SIGN, np.uint32)
        for side in (0, 1):
            window = np.repeat(np.arange(len(cut)), np.diff(at[side]))
            row[np.arange(len(flat[side])) + window + (at[1][window] if side == 0 else at[0][window + 1] + 1)] = flat[side]
        raw, ends = row.tobytes(), (4 * (at[0] + at[1] + np.arange(len(cut) + 1))).tolist()
        keys = [raw[i:j] for i, j in zip(ends, ends[1:])]
        new = dict.fromkeys(k for k in keys if k not in self.known)
        if new:
            self._learn_keys(list(new))
        number = np.fromiter(map(self.known.__getitem__, keys), np.int64, len(keys))
        owner = np.searchsorted(np.cumsum(size), cut, "right")
        return [*(pa.array(c) for c in counts), *self._of_texts(len(texts), owner, number)]

    def _learn_keys(self, keys: list[bytes]) -> None:
        first = len(self.texts)
        ids = np.frombuffer(b"".join(keys), np.uint32)
        sign = np.flatnonzero(ids == SIGN)
        ends = np.cumsum(np.fromiter(map(len, keys), np.int64, len(keys)) // 4)
        begins = np.append(0, ends[:-1])
        in_a, in_b = sign - begins, ends - sign - 1
        is_a = np.repeat(np.tile([True, False], len(keys)), np.stack([in_a, in_b + 1], 1).ravel())
        is_b = ~is_a
        is_b[sign] = False
        self.learn(ids[is_a], np.append(0, np.cumsum(in_a)), ids[is_b], np.append(0, np.cumsum(in_b)))
        self.known.update(zip(keys, range(first, first + len(keys))))

    def _of_texts(self, n: int, owner: np.ndarray, number: np.ndarray) -> list[pa.Array]:
        def numbers(of: array) -> np.ndarray:
            return np.frombuffer(of, np.int64) if of else np.zeros(0, np.int64)

        sums = [np.bincount(owner, numbers(of)[number], n).astype(np.int64) for of in (self.groups, self.links)]
        text = [self.texts[k] for k in number.tolist()]
        cut = np.searchsorted(owner, np.arange(n + 1)).tolist()
        joined = [";".join(text[i:j]) for i, j in zip(cut, cut[1:])]
        # different pairs of every text: sort (text, pair), add up
        first = numbers(self.first)
        many = np.diff(first)[number]
        at = np.arange(many.sum()) + np.repeat(first[number] - np.cumsum(many) + many, many)
        width = len(self.sides[1].bytes)
        span = len(self.sides[0].bytes) * width
        key = np.repeat(owner, many) * span + numbers(self.codes)[at]
        order = np.argsort(key, kind="stable")
        key, n_of = key[order], numbers(self.times)[at][order]
        new = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
        key, n_of = key[new], np.add.reduceat(n_of, new) if len(key) else n_of
        code = key % span
        rows = pa.StructArray.from_arrays([pa.array(c, t) for c, t in ((code // width, pa.int32()), (code % width, pa.int32()), (n_of, pa.int64()))],
                                          ["a", "b", "n"])
        offsets = np.searchsorted(key // span, np.arange(n + 1)).astype(np.int32)
        return [*map(pa.array, sums), pa.array(joined, pa.string()), pa.ListArray.from_arrays(pa.array(offsets), rows)]


@lru_cache(maxsize=1)
def aligner(a: str, b: str, ranks: str | None) -> Aligner:
    """One aligner for all tasks of a worker."""
    return Aligner(ByteLevel(a, ranks), Pieces(b))


def aligned(docs: DataFrame, key: str = "doc_id", text: str = "text", a: str | None = None, b: str | None = None,
            ranks: str | None = None) -> DataFrame:
    """One row per document: key, n_a, n_b, n_groups, n_links, groups (``a1,a2|b1;a3|b2,b3``) and links (a, b, n) of different ids."""
    a = a or public_tokenizers.path("byte_bpe_50k.json")
    b = b or public_tokenizers.path("piece_bpe_32k.model")
    names = ["key", "n_a", "n_b", "n_groups", "n_links", "groups", "links"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = aligner(a, b, ranks)
        for batch in batches:
            at = 0
            for keys, texts in text_groups(batch.column(0), batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(keys)), *align(texts)], names)
                at += len(keys)

    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    counts = [StructField(n, LongType()) for n in names[1:5]]
    fields = StructType([rows.schema["key"], *counts, StructField("groups", StringType()), StructField("links", ArrayType(LINK))])
    return rows.mapInArrow(run, fields).withColumnRenamed("key", key)


def pair_counts(links: DataFrame) -> DataFrame:
    """a, b, docs, best for every linked pair of ids: documents that hold it, and whether no pair of that A id has more."""
    counts = staged(links.select(F.explode("links").alias("link")).groupBy("link.a", "link.b").agg(F.count("*").alias("docs")), "pairs")
    return counts.join(counts.groupBy("a").agg(F.max("docs").alias("most")), "a").select("a", "b", "docs", (F.col("docs") == F.col("most")).alias("best"))


def scores(docs: DataFrame, key: str = "doc_id", text: str = "text", pairs: int = PAIRS, **sides: str) -> DataFrame:
    """One row per document: key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    row = F.struct(F.col(f"`{key}`").alias("key"), F.monotonically_increasing_id().alias("row"))  # written once, so it names a row
    rows = aligned(docs.select(row.alias("key"), F.col(f"`{text}`").alias("text")), "key", "text", **sides)
    digest = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("")
    found = staged(rows.select("key.*", "n_a", "n_b", "n_groups", "n_links", digest.alias("groups_sha256"), "links"), "links")
    counts = staged(pair_counts(found.select("links")), "counts")
    counts = counts.hint("broadcast") if counts.count() <= pairs else counts
    sums = (found.select("row", F.inline("links")).join(counts, ["a", "b"]).groupBy("row")
            .agg(F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("docs")).alias("count_sum")))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return (found.drop("links").join(sums, "row", "left")
            .select(F.col("key").alias(key), "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256"))
