"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Texts are lower-cased (A-Z) and cut into words; words are compared by 64-bit fingerprints. A window
is ``WINDOW`` consecutive words of a test item; an item with fewer words, but not none, is one
window. Windows of one length form a set of patterns with its own tables:

* the shift table has, for each block of two words, the least distance from any place of the block
  in a pattern to the pattern's end (the table is indexed by hash bits; where blocks fall together
  the smaller distance holds), so clean text is read at every twelfth word or so;
* where the shift is 0, the suffix bucket names the patterns that end with this block;
* direct comparison of all words of the pattern confirms.

Texts are searched many at once: each has its own position, and all move by their own shifts. Long
texts are cut into stretches that overlap by one window less a word, so they move in parallel too.

Windows are cut in tasks, and each window of an item is kept once. The patterns travel with the
tasks; ``PATTERN_BYTES`` bounds what the driver holds and what travels at once: more windows are
searched in several passes, and each row adds up what they find. A pass lies in the shared folder
before the next one's windows are sent.

Cases: null texts have no words; items without words have no window. Repeated items and windows
count once by identifier; an item without identifier is named ``null``. Repeated documents are
reported each. Empty tables on either side are fine; other columns do not matter.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from townform.llm.tables import columns, fresh, staged
from townform.llm.words import ALNUM, split_words, text_slices

WINDOW = 13
PATTERN_BYTES = 8 << 20
STRETCH = 2048
TABLE_BITS = 16
ROWS = 1 << 16  # windows in one batch
TYPES = (LongType(), ArrayType(IntegerType()), ArrayType(StringType()))


class Patterns:
    """Search tables for windows of one length."""

    def __init__(self, windows: dict[tuple[int, ...], set[str]], length: int):
        self.length, self.block = length, min(2, length)
        self.words = np.array(sorted(windows), np.uint64).reshape(-1, length)
        self.items = [windows[tuple(int(w) for w in row)] for row in self.words]
        most = length - self.block + 1
        self.shift = np.full(1 << TABLE_BITS, most, np.int64)
        for end in range(self.block - 1, length):
            np.minimum.at(self.shift, self.slot(self.blocks(self.words[:, :end + 1])), length - 1 - end)
        suffix = self.blocks(self.words)
        order = np.argsort(suffix, kind="stable")
        self.words, self.items = self.words[order], [self.items[i] for i in order]
        self.suffix = suffix[order]

    def blocks(self, words: np.ndarray) -> np.ndarray:
        """Hash of the last block of each row of words."""
        h = words[:, -1] * np.uint64(0x9E3779B97F4A7C15)
        return h if self.block == 1 else h ^ (words[:, -2] * np.uint64(0xC2B2AE3D27D4EB4F))

    @staticmethod
    def slot(blocks: np.ndarray) -> np.ndarray:
        return (blocks >> np.uint64(64 - TABLE_BITS)).astype(np.int64)

    def find(self, words: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First word and pattern number of every occurrence inside the stretches [begin, end)."""
        at, stop = begins + self.length - 1, ends
        live = at < stop
        at, stop = at[live], stop[live]
        where, which = [], []
        while len(at):
            h = words[at] * np.uint64(0x9E3779B97F4A7C15)
            if self.block == 2:
                h = h ^ (words[at - 1] * np.uint64(0xC2B2AE3D27D4EB4F))
            step = self.shift[self.slot(h)]
            zero = np.flatnonzero(step == 0)
            if len(zero):
                low = np.searchsorted(self.suffix, h[zero], "left")
                count = np.searchsorted(self.suffix, h[zero], "right") - low
                lane = np.repeat(at[zero], count) - self.length + 1
                pattern = np.repeat(low - (np.cumsum(count) - count), count) + np.arange(count.sum())
                good = np.ones(len(lane), bool)
                for k in range(self.length):
                    good &= words[lane + k] == self.words[pattern, k]
                where.append(lane[good])
                which.append(pattern[good])
                step = np.maximum(step, 1)
            at = at + step
            live = at < stop
            at, stop = at[live], stop[live]
        none = [np.zeros(0, np.int64)]
        return np.concatenate(where or none), np.concatenate(which or none)


def _cut(window: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The windows of items (name, text): number of words, their prints, the item's name."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, buf, offsets in text_slices(batch.column(1)):
                words = split_words(buf, offsets, ALNUM)
                names, counts = batch.column(0).slice(begin, len(offsets) - 1), np.diff(words.first)
                for size in np.unique(np.minimum(counts[counts > 0], window)).tolist():
                    own = np.flatnonzero(np.minimum(counts, window) == size)
                    many = counts[own] - size + 1
                    item = np.repeat(own, many)
                    start = words.first[item] + np.arange(len(item)) - np.repeat(np.cumsum(many) - many, many)
                    for k in range(0, len(item), ROWS):
                        rows = words.prints[start[k:k + ROWS, None] + np.arange(size)].astype("<u8")
                        prints = pa.array([row.tobytes() for row in rows], pa.binary())
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), size, np.int32)), prints, names.take(pa.array(item[k:k + ROWS]))],
                                                         ["size", "prints", "item"])
    return run


def windows(benchmark: DataFrame, item: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """size, prints, item: every window of every item once."""
    named = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("null")).alias("item"), F.col(text).alias("text"))
    return named.mapInArrow(_cut(window), "size int, prints binary, item string").distinct()


def _lots(rows: DataFrame, most: int) -> Iterator[list[Patterns]]:
    """Search tables, one for each length of window, of lots of windows with at most ``most`` bytes."""
    lot: dict[int, dict[tuple[int, ...], set[str]]] = defaultdict(lambda: defaultdict(set))
    held = 0
    for size, prints, name in rows.toLocalIterator(prefetchPartitions=False):
        if held and held + len(prints) + len(name) > most:
            yield [Patterns(w, n) for n, w in sorted(lot.items())]
            lot.clear()
            held = 0
        lot[size][tuple(np.frombuffer(prints, "<u8").tolist())].add(name)
        held += len(prints) + len(name)
    if held:
        yield [Patterns(w, n) for n, w in sorted(lot.items())]


def search(tables: list[Patterns], buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], list[set[str]]]:
    """Words of each text, the places of its hit words, the items found in it."""
    words = split_words(buf, offsets, ALNUM)
    n = len(offsets) - 1
    edge = np.zeros(len(words.prints) + 1, np.int64)
    found: list[set[str]] = [set() for _ in range(n)]
    counts = np.diff(words.first)
    for table in tables:
        pieces = np.maximum(1, -(-counts // STRETCH))
        row = np.repeat(np.arange(n), pieces)
        begins = words.first[row] + (np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * STRETCH
        ends = np.minimum(begins + STRETCH + table.length - 1, words.first[row + 1])
        where, which = table.find(words.prints, begins, ends)
        np.add.at(edge, where, 1)
        np.add.at(edge, where + table.length, -1)
        for k, p in set(zip(words.row[where].tolist(), which.tolist())):
            found[k] |= table.items[p]
    hit = np.cumsum(edge[:-1]) > 0
    places = np.flatnonzero(hit)
    cut = np.searchsorted(places, words.first)
    return counts, [places[cut[k]:cut[k + 1]] - words.first[k] for k in range(n)], found


def _searcher(tables: list[Patterns], text: int, carried: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Carry the named columns and add words, hit words and items of the text in column number ``text``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, buf, offsets in text_slices(batch.column(text)):
                counts, places, found = search(tables, buf, offsets)
                own = batch.slice(begin, len(counts))
                new = [pa.array(counts, pa.int64()), pa.array(places, pa.list_(pa.int32())), pa.array([sorted(f) for f in found], pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays([*(own.column(c) for c in range(len(carried))), *new], [*carried, "w", "h", "i"])
    return run


def searched(rows: DataFrame, benchmark: DataFrame, text: str, names: tuple[str, str, str], item: str = "item_id",
             item_text: str = "text", window: int = WINDOW, most: int = PATTERN_BYTES) -> DataFrame:
    """``rows`` with three more columns: number of words, places of hit words, items with occurring windows."""
    carried = rows.toDF(*(f"c{k}" for k in range(len(rows.columns))))  # mapInArrow takes no names with dots
    place, plain, out = rows.columns.index(text), carried.columns, None
    lots = _lots(windows(benchmark, item, item_text, window), most)
    lot = next(lots, None)
    while lot is not None:
        source = carried if out is None else staged(out, "searched")
        fields = StructType([*source.schema, *(StructField(f"new{k}", t) for k, t in enumerate(TYPES))])
        new = source.mapInArrow(_searcher(lot, place, source.columns), fields)
        found = [F.col("new0")] + [F.col(f"new{k}") if out is None else F.array_union(f"found{k}", f"new{k}") for k in (1, 2)]
        out = new.select(*plain, *(f.alias(f"found{k}") for k, f in enumerate(found)))
        lot = next(lots, None)
    if out is None:
        fields = StructType([*carried.schema, *(StructField(f"found{k}", t) for k, t in enumerate(TYPES))])
        out = carried.mapInArrow(_searcher([], place, plain), fields)
    return out.toDF(*rows.columns, *names)


def _is_contaminated(words: str, hits: str) -> Column:
    return (F.size(hits) > 0) & (20 * F.size(hits) >= F.col(words))


def contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
                  item_text: str = "text", window: int = WINDOW, most: int = PATTERN_BYTES) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    found = searched(rows, benchmark, "text", ("n_words", "hits", "items"), item, item_text, window, most)
    return found.select(F.col("id").alias(key), "n_words", F.size("hits").cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
                        _is_contaminated("n_words", "hits").alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", **how) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    names = [fresh(n, docs.columns) for n in ("words found", "hits found", "items found")]
    found = searched(docs, benchmark, text, tuple(names), **how)
    return found.where(~_is_contaminated(f"`{names[0]}`", f"`{names[1]}`")).select(*columns(docs.columns))
