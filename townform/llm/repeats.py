"""Suffix-array dedup: bytes inside a 200-byte string that also starts elsewhere are removed.

1. *Anchors.* Of the ``GRAMS`` grams of ``GRAM`` bytes that begin in the first part of a 200-byte
   string, the one with the least hash (the first of equals) is its anchor. Equal strings have the
   same anchor at the same offset, and agree in the ``COMMON`` bytes behind it. An anchor whose
   common bytes occur nowhere else belongs to no repeat and needs no further work.
2. *Shards.* The strings of each other anchor (from its first start to the end of its last string)
   go as one snippet to the bucket of its common bytes; so all occurrences of a repeated string
   meet. A snippet becomes a row of ``BLOCK``-byte symbols, cut from the anchor. What one batch sends
   to a bucket is a shard, with its own Burrows-Wheeler transform.
3. *Merge.* The shards' transforms are merged by interleave refinement: the interleave is a vector of
   shard numbers; a round pulls the transforms' symbols in its order and deals them stably by symbol,
   which orders suffixes by one symbol more. Where neighbours part in round h, their common prefix
   is h - 1 symbols. After ``DEPTH`` rounds runs with a common prefix of 9 symbols are the repeated
   intervals; no suffix of the whole is sorted again.
4. *Exact check.* A 200-byte string holds 9 whole symbols; strings of an interval are compared by the
   fingerprint of their 200 bytes at each of the ``BLOCK`` offsets before the symbol.

Equal snippets of one batch are settled there and go on as one, and so do equal anchors, so the inside
of a passage in a third of all documents is one row per batch. At its ends every document has a snippet
of its own under the same anchor: an anchor that more than ``HOT`` places share is not transformed.
Its 200-byte strings go by their fingerprints, settled within the batch and then spread over all
tasks, so its documents do not meet in one. Only the keys of such anchors (8 bytes each) pass the driver.
Copies of a whole text are removed whole and stand for each other as one text. Buckets are read one
after the other; a bucket grows with what shares its anchors, not with the corpus.

Cases: a null text is empty; texts below 200 bytes lose nothing. Repeated rows are copies. A null
identifier is reported like any other. Empty tables give empty results; other columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from townform.llm.tables import staged, width
from townform.llm.words import prefix_sums, slice_prints, text_slices

LENGTH, GRAMS, GRAM, BLOCK = 200, 141, 24, 20
COMMON = LENGTH - GRAMS + 1
DEPTH = LENGTH // BLOCK - 1
HOT, PRINT_BUCKETS = 2048, 8
ANCHOR, FLAG, PRINT = 0, 1, 2
SHIPPED = "kind int, bucket int, node long, payload binary"
SNIPPETS = "kind int, bucket int, shard long, node long, payload binary"
MARKS = "node long, marks binary"


def anchors(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Text, place, first and last start of every anchor, and the running sums of the buffer."""
    sums = prefix_sums(buf)
    starts = np.diff(offsets) - LENGTH + 1
    starts = np.maximum(starts, 0)
    none = np.zeros(0, np.int64)
    if not starts.sum():
        return none, none, none, none, sums
    at = np.arange(len(buf) - GRAM + 1)
    least = (slice_prints(sums, at, at + GRAM) & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64)
    size = 1
    while 2 * size <= GRAMS:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < GRAMS:
        least = np.minimum(least[:size - GRAMS], least[GRAMS - size:])
    row = np.repeat(np.arange(len(starts)), starts)
    s = np.arange(len(row)) - np.repeat(np.cumsum(starts) - starts, starts) + offsets[row]
    place = (least[s] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.ones(len(s), bool)
    first[1:] = (place[1:] != place[:-1]) | (row[1:] != row[:-1])
    begin = np.flatnonzero(first)
    end = np.append(begin[1:], len(s)) - 1
    return row[begin], place[begin], s[begin], s[end], sums


def _by_node(node: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Values (rows of int32) of each node as bytes."""
    order = np.argsort(node, kind="stable")
    node, values = node[order], np.ascontiguousarray(values[order], np.int32)
    names, cut = np.unique(node, return_index=True)
    return names, [values[a:b].tobytes() for a, b in zip(cut, np.append(cut[1:], len(node)))]


def _fresh(names: np.ndarray, seen: set[int]) -> np.ndarray:
    out = np.zeros(len(names), bool)
    for k, name in enumerate(names.tolist()):
        out[k] = name not in seen
        seen.add(name)
    return out


def _rows(kind: int, bucket, node, payload) -> pa.RecordBatch:
    n = len(payload)
    return pa.RecordBatch.from_arrays([pa.array(np.full(n, kind), pa.int32()), pa.array(bucket, pa.int32()), pa.array(node, pa.int64()),
                                       pa.array(payload, pa.binary())], ["kind", "bucket", "node", "payload"])


OCCURRENCE = np.dtype([("key", "<u8"), ("node", "<i8"), ("at", "<i4"), ("places", "<i4")])


def _find_anchors(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for begin, buf, offsets in text_slices(batch.column(1)):
                names = batch.column(0).slice(begin, len(offsets) - 1).to_numpy()
                row, place, _, _, sums = anchors(buf, offsets)
                use = _fresh(names, seen)[row]
                row, place = row[use], place[use]
                if not len(row):
                    continue
                key = slice_prints(sums, place, place + COMMON)
                _, first, which, count = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
                at, again = (place - offsets[row]).astype(np.int32), count[which] > 1
                if again.any():
                    nodes, payload = _by_node(names[row[again]], at[again])
                    yield _rows(FLAG, (nodes.view(np.uint64) % np.uint64(buckets)).astype(np.int32), nodes, payload)
                one = np.empty(len(first), OCCURRENCE)
                one["key"], one["node"], one["at"], one["places"] = key[first], names[row[first]], at[first], count
                home = (one["key"] >> np.uint64(40)) % np.uint64(buckets)
                order = np.argsort(home, kind="stable")
                cut = np.searchsorted(home[order], np.arange(buckets + 1))
                one = one[order]
                some = np.flatnonzero(np.diff(cut))
                yield _rows(ANCHOR, some, pa.nulls(len(some), pa.int64()), [one[cut[b]:cut[b + 1]].tobytes() for b in some])
    return run


def _flag_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors whose common bytes occur more than once, by text; without a text the keys of hot anchors."""
    def flags(parts: list[bytes]) -> pa.RecordBatch:
        all_of = np.unique(np.concatenate([np.frombuffer(p, OCCURRENCE) for p in parts]))
        keys, which, count = np.unique(all_of["key"], return_inverse=True, return_counts=True)
        again = all_of[count[which] > 1]
        nodes, payload = _by_node(again["node"], again["at"])
        hot = keys[np.bincount(which, all_of["places"], len(keys)) > HOT]
        return pa.RecordBatch.from_arrays([pa.array([*nodes.tolist(), *[None] * bool(len(hot))], pa.int64()),
                                           pa.array([*payload, *[hot.tobytes()] * bool(len(hot))], pa.binary())], ["node", "marks"])

    bucket, parts = None, []
    for batch in batches:
        kind = batch.column(0).to_numpy()
        passed = batch.filter(pa.array(kind == FLAG))
        yield pa.RecordBatch.from_arrays([passed.column(2), passed.column(3)], ["node", "marks"])
        own = batch.filter(pa.array(kind == ANCHOR))
        for b, payload in zip(own.column(1).to_pylist(), own.column(3).to_pylist()):
            if b != bucket and parts:
                yield flags(parts)
                parts = []
            bucket = b
            parts.append(payload)
    if parts:
        yield flags(parts)


SNIPPET = np.dtype([("key", "<u8"), ("node", "<i8"), ("at", "<i4"), ("offset", "<i4"), ("size", "<i4")])


PLACED = np.dtype([("print", "<u8"), ("node", "<i8"), ("at", "<i4")])


def _cut_snippets(buckets: int, hot: np.ndarray):
    """Snippets of flagged anchors and the strings of hot ones, packed by bucket; what one batch settles itself goes on as marks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = 0
        for batch in batches:
            for begin, buf, offsets in text_slices(batch.column(1)):
                lot = len(offsets) - 1
                names = batch.column(0).slice(begin, lot).to_numpy()
                flagged = np.zeros(len(buf) + 1, bool)
                for k, marks in enumerate(batch.column(2).slice(begin, lot).to_pylist()):
                    for m in marks:
                        flagged[offsets[k] + np.frombuffer(m, np.int32)] = True
                row, place, low, high, sums = anchors(buf, offsets)
                use = flagged[place]
                row, place, low, high = row[use], place[use], low[use], high[use]
                if not len(row):
                    continue
                whole = slice_prints(sums, low, high + LENGTH) + (place - low).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                _, first, which, count = np.unique(whole, return_index=True, return_inverse=True, return_counts=True)
                again = count[which] > 1
                if again.any():
                    spans = np.column_stack([low - offsets[row], high - offsets[row]])[again]
                    nodes, payload = _by_node(names[row[again]], spans)
                    yield _snippet_rows(FLAG, (nodes.view(np.uint64) % np.uint64(buckets)).astype(np.int32), 0, nodes, payload)
                row, place, low, high = row[first], place[first], low[first], high[first]
                key = slice_prints(sums, place, place + COMMON)
                if len(hot) and (many := np.isin(key, hot)).any():
                    yield from _hot_strings(buckets, names, offsets, sums, row[many], low[many], high[many])
                    row, place, low, high, key = row[~many], place[~many], low[~many], high[~many], key[~many]
                    if not len(row):
                        continue
                one = np.empty(len(row), SNIPPET)
                one["key"], one["node"] = key, names[row]
                one["at"], one["offset"], one["size"] = low - offsets[row], place - low, high - low + LENGTH
                home = (one["key"] >> np.uint64(40)) % np.uint64(buckets)
                order = np.argsort(home, kind="stable")
                one, low = one[order], low[order]
                cut = np.searchsorted(home[order], np.arange(buckets + 1))
                some, payload = np.flatnonzero(np.diff(cut)), []
                for b in some:
                    part = slice(cut[b], cut[b + 1])
                    size = one["size"][part].astype(np.int64)
                    body = np.repeat(low[part] - (np.cumsum(size) - size), size) + np.arange(size.sum())
                    payload.append(np.int64(len(size)).tobytes() + one[part].tobytes() + buf[body].tobytes())
                shard += 1
                yield _snippet_rows(ANCHOR, some, shard, pa.nulls(len(some), pa.int64()), payload)
    return run


def _hot_strings(buckets: int, names: np.ndarray, offsets: np.ndarray, sums: np.ndarray, row: np.ndarray,
                 low: np.ndarray, high: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One place of each string of hot anchors, by bucket of its fingerprint, and marks where the batch repeats it."""
    size = high - low + 1
    start = np.repeat(low - (np.cumsum(size) - size), size) + np.arange(size.sum())
    row = np.repeat(row, size)
    prints = slice_prints(sums, start, start + LENGTH)
    _, first, which, count = np.unique(prints, return_index=True, return_inverse=True, return_counts=True)
    again = count[which] > 1
    if again.any():
        nodes, payload = _by_node(*runs(names[row[again]], (start - offsets[row])[again]))
        yield _snippet_rows(FLAG, (nodes.view(np.uint64) % np.uint64(buckets)).astype(np.int32), 0, nodes, payload)
    one = np.empty(len(first), PLACED)
    one["print"], one["node"], one["at"] = prints[first], names[row[first]], (start - offsets[row])[first]
    lots = PRINT_BUCKETS * buckets
    home = (one["print"] >> np.uint64(32)) % np.uint64(lots)
    order = np.argsort(home, kind="stable")
    cut = np.searchsorted(home[order], np.arange(lots + 1))
    one, some = one[order], np.flatnonzero(np.diff(cut))
    yield _snippet_rows(PRINT, some + buckets, 0, pa.nulls(len(some), pa.int64()), [one[cut[b]:cut[b + 1]].tobytes() for b in some])


def _snippet_rows(kind: int, bucket, shard: int, node, payload) -> pa.RecordBatch:
    plain = _rows(kind, bucket, node, payload)
    return pa.RecordBatch.from_arrays([plain.column(0), plain.column(1), pa.array(np.full(len(payload), shard), pa.int64()), plain.column(2),
                                       plain.column(3)], ["kind", "bucket", "shard", "node", "payload"])


def shard_transforms(symbols: np.ndarray, first: np.ndarray, left: np.ndarray, shard: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order of every shard (shard after shard) and the symbols before these suffixes.

    ``symbols`` of all strings, each closed by 0; ``first`` marks a string's first symbol, ``left``
    counts the symbols up to and with the closing 0, ``shard`` does not fall.
    """
    n = len(symbols)
    rank, reach = symbols.astype(np.int64), 1
    while True:
        ahead = np.minimum(np.arange(n) + reach, n - 1)
        next_rank = np.where(left > reach, rank[ahead], -1)
        order = np.lexsort((next_rank, rank, shard))
        key = np.column_stack([shard[order], rank[order], next_rank[order]])
        step = np.ones(n, bool)
        step[1:] = (key[1:] != key[:-1]).any(1)
        if left.max() <= 2 * reach or step.all():
            break
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(step)
        reach *= 2
    before = np.where(first, 0, np.roll(symbols, 1))
    return order, before[order]


def merged(before: np.ndarray, shard_of: np.ndarray, strings: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Merge shard transforms by interleave refinement.

    ``before``: the transforms, shard after shard; ``shard_of``: their shards; ``strings``: strings of
    each shard. Returns the merged place of every suffix (in the order of ``before``) and, for every
    merged place, its common prefix with the place before, up to ``depth`` symbols.
    """
    n, ends = len(before), int(strings.sum())
    closing = np.repeat(np.arange(len(strings)), strings).astype(np.int32)
    z = shard_of.astype(np.int32)
    same = np.zeros(n, np.int64)  # number of the run of suffixes that agree so far
    common = np.full(n, depth, np.int64)
    common[0] = 0
    for h in range(1, depth + 1):
        pulled = np.empty(n, before.dtype)
        pulled[np.argsort(z, kind="stable")] = before
        source = np.flatnonzero(pulled)
        source = source[np.argsort(pulled[source], kind="stable")]
        symbol, run = pulled[source], same[source]
        part = np.ones(n, bool)  # closing symbols all differ
        part[ends + 1:] = (symbol[1:] != symbol[:-1]) | (run[1:] != run[:-1])
        common[part & (common == depth)] = h - 1
        z = np.concatenate([closing, z[source]])
        same = np.cumsum(part)
    return np.argsort(z, kind="stable"), common


def repeated_starts(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Node and start of every 200-byte string that stands twice in the shards (snippets, bytes)."""
    snippets = np.concatenate([p[0] for p in parts])
    buf = np.concatenate([p[1] for p in parts])
    shard = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
    size = snippets["size"].astype(np.int64)
    base = np.cumsum(size) - size
    sums = prefix_sums(buf)
    before, behind = snippets["offset"] // BLOCK, (size - snippets["offset"]) // BLOCK
    count = before + behind  # symbols of each snippet
    string = np.repeat(np.arange(len(count)), count + 1)
    index = np.arange(len(string)) - np.repeat(np.cumsum(count + 1) - count - 1, count + 1)
    at = base[string] + snippets["offset"][string] + (index - before[string]) * BLOCK
    closing = index == count[string]
    symbols = np.zeros(len(string), np.int64)
    _, which = np.unique(slice_prints(sums, at[~closing], at[~closing] + BLOCK), return_inverse=True)
    symbols[~closing] = which + 1
    order, transform = shard_transforms(symbols, index == 0, count[string] + 1 - index, shard[string])
    place, common = merged(transform, shard[string][order], np.bincount(shard, minlength=len(parts)), DEPTH)
    interval = np.empty(len(order), np.int64)
    interval[order] = np.cumsum(common < DEPTH)[place]
    many = np.bincount(interval, minlength=interval.max() + 1)[interval] > 1
    some = np.flatnonzero(many & (count[string] - index >= DEPTH))
    starts = (at[some][:, None] - np.arange(BLOCK)).ravel()
    owner = np.repeat(string[some], BLOCK)
    inside = (starts >= base[owner]) & (starts + LENGTH <= base[owner] + size[owner])
    starts, owner = starts[inside], owner[inside]
    node, offset = snippets["node"][owner], snippets["at"][owner] + starts - base[owner]
    return twice(slice_prints(sums, starts, starts + LENGTH), node, offset)


def twice(prints: np.ndarray, node: np.ndarray, offset: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Node and start of the strings whose fingerprint stands at two places."""
    # a text that several batches sent counts once
    by = np.lexsort((offset, node, prints))
    prints, node, offset = prints[by], node[by], offset[by]
    own = np.ones(len(by), bool)
    own[1:] = (prints[1:] != prints[:-1]) | (node[1:] != node[:-1]) | (offset[1:] != offset[:-1])
    prints, node, offset = prints[own], node[own], offset[own]
    new = np.ones(len(prints), bool)
    new[1:] = prints[1:] != prints[:-1]
    group = np.cumsum(new) - 1
    again = np.bincount(group)[group] > 1 if len(group) else new
    return node[again], offset[again]


def runs(node: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Join consecutive starts of a node to (first, last) spans."""
    if not len(node):
        return node, np.zeros((0, 2), np.int64)
    order = np.lexsort((start, node))
    node, start = node[order], start[order]
    new = np.ones(len(node), bool)
    new[1:] = (node[1:] != node[:-1]) | (start[1:] > start[:-1] + 1)
    begin = np.flatnonzero(new)
    return node[begin], np.column_stack([start[begin], start[np.append(begin[1:], len(node)) - 1]])


def _merge_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def unpack(payload: bytes) -> tuple[np.ndarray, np.ndarray]:
        n = int(np.frombuffer(payload, np.int64, 1)[0])
        end = 8 + n * SNIPPET.itemsize
        return np.frombuffer(payload[8:end], SNIPPET), np.frombuffer(payload, np.uint8, offset=end)

    def marks(kind: int, parts: list[bytes]) -> pa.RecordBatch:
        if kind == PRINT:
            strings = np.concatenate([np.frombuffer(p, PLACED) for p in parts])
            found = twice(strings["print"], strings["node"], strings["at"].astype(np.int64))
        else:
            found = repeated_starts([unpack(p) for p in parts])
        node, spans = runs(*found)
        nodes, payload = _by_node(node, spans) if len(node) else (node, [])
        return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(payload, pa.binary())], ["node", "marks"])

    bucket, sort, parts = None, ANCHOR, []
    for batch in batches:
        kind = batch.column(0).to_numpy()
        passed = batch.filter(pa.array(kind == FLAG))
        yield pa.RecordBatch.from_arrays([passed.column(3), passed.column(4)], ["node", "marks"])
        own = batch.filter(pa.array(kind != FLAG))
        for k, b, payload in zip(own.column(0).to_pylist(), own.column(1).to_pylist(), own.column(4).to_pylist()):
            if b != bucket and parts:
                yield marks(sort, parts)
                parts = []
            bucket, sort = b, k
            parts.append(payload)
    if parts:
        yield marks(sort, parts)


def covered(size: int, marks: list[bytes]) -> np.ndarray:
    """Flags of the bytes that the marked strings cover."""
    edge = np.zeros(size + 1, np.int64)
    for m in marks:
        spans = np.frombuffer(m, np.int32).reshape(-1, 2)
        np.add.at(edge, spans[:, 0], 1)
        np.add.at(edge, spans[:, 1] + LENGTH, -1)
    return np.cumsum(edge[:size]) > 0


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for node, text, marks in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
            data = np.frombuffer(text.as_buffer(), np.uint8)
            gone = covered(len(data), marks)
            spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
            kept = data[~gone].tobytes()
            out.append((node, int(gone.sum()), spans, kept, hashlib.sha256(kept).hexdigest()))
        cols = list(zip(*out)) if out else [()] * 5
        types = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["node", "removed", "spans", "kept", "sha"])


def marked_texts(docs: DataFrame, text: str = "text", key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """Facts on every row (doc, node, bytes, sha) and, for texts with repeats, node, text and marks (spans of starts)."""
    spark = docs.sparkSession
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.select(F.col(key).alias("doc"), body.alias("text")).withColumn("node", F.xxhash64("text", F.octet_length("text")))
    facts = staged(rows.select("doc", "node", F.octet_length("text").cast("long").alias("bytes"), F.sha2("text", 256).alias("sha")), "facts")
    buckets = 8 * width(spark)
    flags = (rows.select("node", "text").mapInArrow(_find_anchors(buckets), SHIPPED).repartition(width(spark), "bucket")
             .sortWithinPartitions("bucket").mapInArrow(_flag_anchors, MARKS))
    flags = staged(flags.where("marks IS NOT NULL"), "flags")
    hot = [np.frombuffer(r["marks"], np.uint64) for r in flags.where("node IS NULL").select("marks").collect()]
    hot = np.unique(np.concatenate([np.zeros(0, np.uint64), *hot]))
    flags = flags.where("node IS NOT NULL")
    # one row of each text carries it on; copies have keys of their own in this join
    ask = facts.groupBy("node").agg(F.min(F.struct(F.coalesce(F.col("doc").cast("string"), F.lit("")).alias("d"))).alias("one"))
    ask = flags.groupBy("node").agg(F.collect_list("marks").alias("marks")).join(ask, "node").select("node", F.col("one.d").alias("d"), "marks")
    texts = rows.withColumn("d", F.coalesce(F.col("doc").cast("string"), F.lit(""))).drop("doc").join(ask, ["node", "d"])
    texts = staged(texts.select("node", "text", "marks"), "texts")
    marks = (texts.mapInArrow(_cut_snippets(buckets, hot), SNIPPETS).repartition(width(spark), "bucket")
             .sortWithinPartitions("bucket", "shard").mapInArrow(_merge_shards, MARKS))
    marks = staged(marks.where("marks IS NOT NULL"), "marks").groupBy("node").agg(F.collect_list("marks").alias("marks"))
    return facts, texts.select("node", "text").dropDuplicates(["node"]).join(marks, "node")


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    facts, texts = marked_texts(docs, text, key)
    cut = staged(texts.mapInArrow(_cut_out, "node long, removed long, spans long, kept binary, sha string").drop("kept"), "cut")
    cut = cut.withColumnRenamed("sha", "cut_sha")
    copies = facts.groupBy("node").agg(F.count("*").alias("copies")).where("copies > 1")
    nodes = copies.join(cut, "node", "full")
    whole = (F.col("copies") > 1) & (F.col("bytes") >= LENGTH)
    pick = lambda if_whole, if_cut, otherwise: F.when(whole, if_whole).otherwise(F.coalesce(if_cut, otherwise))
    return facts.join(nodes, "node", "left").select(
        F.col("doc").alias(key), F.col("bytes").alias("n_bytes"),
        pick(F.col("bytes"), F.col("removed"), F.lit(0).cast("long")).alias("n_removed"),
        pick(F.lit(1).cast("long"), F.col("spans"), F.lit(0).cast("long")).alias("n_spans"),
        pick(F.lit(hashlib.sha256(b"").hexdigest()), F.col("cut_sha"), F.col("sha")).alias("kept_sha256"))
