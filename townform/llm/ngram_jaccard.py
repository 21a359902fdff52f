"""N-gram Jaccard join: blocked product of the document by n-gram incidence matrix.

A document is the set of its word n-grams, as 64-bit fingerprints. Documents link when
``intersection * den >= union * num``. The result is exact up to fingerprint collisions.

1. *Bounds.* Documents of linked sizes stand in the same or in neighbouring size classes, and their
   sets differ in at most ``d`` n-grams, which follows from the class. So the columns of the matrix
   are cut into more than ``d`` parts: two linked documents agree wholly in one part at least, and
   in one that is not empty if either has more than ``d`` such parts. (Else it names its empty parts
   as well.) A part's content has a fingerprint; a boilerplate passage seldom makes parts agree, as a
   part also holds what is the document's own. N-grams in ``COMMON`` of a bounded sample of documents
   are left out of the parts, which leaves the argument as it is and parts more telling. No n-gram
   has a posting list, however frequent.
2. *Families.* Documents with a part in common are joined to a hub, the least of them, first inside
   each batch, then by part; so a part that a third of all documents share reaches its reducer as
   one row per batch. Equal sets are one member from here on. Components of the hub links are
   families; no link leaves a family.
3. *Parities.* Long texts meet in a part of one or two n-grams by chance, and the more texts there are
   the more of them such links chain into one family. So a family too large for one block is cut up
   first: a set's n-grams are hashed to about as many bits as it has n-grams, each bit the parity of
   those on it. Two sets differ in at least as many n-grams as their bits do; where that is more than
   linked sets of their sizes can, they do not link. Components of the pairs left are the families
   from here on. Bits take a 64th to a 32nd of the n-grams' room.
4. *Blocked product.* A family's rows are cut into blocks (``BLOCK_ROWS``, ``BLOCK_BYTES``) and each
   pair of blocks is a task. Rows are ordered by size; a group of rows meets only those whose size
   the bound admits. Overlap counts are added up over slices of columns, pairs below the bound go,
   and a spanning forest of the links leaves the task, never all pairs. The pairs of blocks take turns:
   of b blocks, those i and j with the same (i + j) mod b ship every row once. A turn ships about what all sets
   hold once (``TURN_BYTES`` if that is more) and its exchange is removed before the next.
5. Components of the links give the result.

Work is in proportion to the text but for families of many texts: n of them cost n^2 / 2 comparisons
of bits, and products where bits are near, inside tasks of bounded size, which an exact join cannot
avoid. Disk is in proportion to the text for any families.

Cases: a document with fewer words than n is one n-gram; without words or text its set is empty and
it links with nothing. A row without identifier links with nothing and has no component. Rows
repeated with the same identifier are reported each; if their texts differ, each links by its own
text under the same identifier. Empty tables give empty results; other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from townform.llm.links import components
from townform.llm.tables import passing, staged, width
from townform.llm.words import NOT_BLANK, mix, split_words, text_slices, window_prints

SAMPLE, COMMON = 10_000, 0.002
BLOCK_ROWS, BLOCK_BYTES, ROWS_AT_ONCE, CELLS, TURN_BYTES = 2048, 24 << 20, 512, 1 << 21, 256 << 20
PART, HUB, DOC = 0, 1, 2
PACKED = "kind int, bucket int, payload binary, doc long, node long, n long"
FACTS = "kind int, doc long, node long, n long, bits binary"
SET = "family long, node long, blocks long, n long, body binary"
SET_COLUMNS = [c.split()[0] for c in SET.split(", ")]


@lru_cache(maxsize=8)
def size_classes(num: int, den: int, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower bounds of the size classes up to ``most``, differences that pairs from each class can have, parts.

    The largest size that links with any of class c is in class c + 1 at most.
    """
    lows, apart = [], []
    low = 1
    while low <= most:
        high = low * den // num
        partner = high * den // num
        lows.append(low)
        apart.append((high + partner) * (den - num) // (den + num))
        low = high + 1
    d = np.array(apart or [0])
    return np.array(lows or [1]), d, np.where(d > 0, d + 2 + (d + 1) * 3 // 20, 1)


def classes_for(num: int, den: int, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    size = 1024
    while size < most:
        size *= 4
    return size_classes(num, den, size)


def gram_sets(buf: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of all texts, sorted inside each text, and the bounds of the texts."""
    prints, at = window_prints(split := split_words(buf, offsets, NOT_BLANK), n)
    row = split.row[at]
    order = np.lexsort((prints, row))
    prints, row = prints[order], row[order]
    fresh = np.ones(len(row), bool)
    fresh[1:] = (row[1:] != row[:-1]) | (prints[1:] != prints[:-1])
    prints, row = prints[fresh], row[fresh]
    return prints, np.searchsorted(row, np.arange(len(offsets)))


def set_names(grams: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A fingerprint of each set."""
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(grams))])
    return mix(sums[bounds[1:]] - sums[bounds[:-1]] + np.diff(bounds).astype(np.uint64)).view(np.int64)


def parities(grams: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """Bits of each set, 64 times a power of two and at least as many as n-grams: the parity of the n-grams on each.

    The bits of half the width are the lower half xor the upper half.
    """
    sizes = np.diff(bounds)
    wide = np.left_shift(64, np.frexp((np.maximum(sizes, 1) - 1) >> 6)[1].astype(np.int64))
    base = np.concatenate([[0], np.cumsum(wide)])
    spot = (mix(grams ^ np.uint64(0x2545F4914F6CDD1D)) & np.repeat(wide - 1, sizes).astype(np.uint64)).astype(np.int64)
    odd = np.bincount(spot + np.repeat(base[:-1], sizes), minlength=base[-1]) & 1
    body = np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()
    return [body[a:b] for a, b in zip(base[:-1] // 8, base[1:] // 8)]


def part_prints(grams: np.ndarray, bounds: np.ndarray, num: int, den: int, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of the parts of all sets, for their own class and the one below; and the sets' numbers."""
    sizes = np.diff(bounds)
    own_gram = ~np.isin(grams, common)
    lows, apart, parts = classes_for(num, den, int(sizes.max(initial=1)))
    own = np.searchsorted(lows, sizes, "right") - 1
    value, spread = mix(grams * np.uint64(3)), mix(grams ^ np.uint64(0x5851F42D4C957F2D))
    prints, owners = [], []
    for below in (0, 1):
        kind = own - below
        m = np.where((sizes > 0) & (kind >= 0), parts[np.maximum(kind, 0)], 0)
        base = np.concatenate([[0], np.cumsum(m)])
        row = np.repeat(np.arange(len(sizes)), np.where(m > 0, sizes, 0))
        use = np.repeat(m > 0, sizes)
        row, use = row[own_gram[use]], use & own_gram
        cells, filled = np.zeros(base[-1], np.uint64), np.zeros(base[-1], bool)
        slot = base[row] + ((spread[use] >> np.uint64(33)) % m[row].astype(np.uint64)).astype(np.int64)
        np.add.at(cells, slot, value[use])
        filled[slot] = True
        owner = np.repeat(np.arange(len(sizes)), m)
        few = np.bincount(owner[filled], minlength=len(sizes)) <= apart[np.maximum(kind, 0)]
        part = np.arange(len(cells)) - base[owner]
        tag = part.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + kind[owner].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        named = filled | few[owner]
        prints.append(mix(cells + mix(tag))[named])
        owners.append(owner[named])
    return np.concatenate(prints), np.concatenate(owners)


def hubs(prints: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct prints, the least node of each, and links (node, hub) as an array of pairs."""
    order = np.lexsort((nodes, prints))
    prints, nodes = prints[order], nodes[order]
    first = np.ones(len(prints), bool)
    first[1:] = prints[1:] != prints[:-1]
    hub = nodes[first]
    of = hub[np.cumsum(first) - 1] if len(prints) else hub
    apart = of != nodes
    pairs = np.unique(np.column_stack([nodes[apart], of[apart]]), axis=0) if apart.any() else np.zeros((0, 2), np.int64)
    return prints[first], hub, pairs


def _batch(kind, bucket, payload, doc, node, n) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(kind, pa.int32()), pa.array(bucket, pa.int32()), pa.array(payload, pa.binary()), pa.array(doc, pa.int64()),
         pa.array(node, pa.int64()), pa.array(n, pa.int64())], ["kind", "bucket", "payload", "doc", "node", "n"])


def _emit(n: int, num: int, den: int, buckets: int, common: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            ids = batch.column(0)
            for begin, buf, offsets in text_slices(batch.column(1)):
                own = ids.slice(begin, len(offsets) - 1)
                grams, bounds = gram_sets(buf, offsets, n)
                names, sizes = set_names(grams, bounds), np.diff(bounds)
                linked = (sizes > 0) & own.is_valid().to_numpy(zero_copy_only=False)
                node = pa.array(names, mask=~linked)
                lot = len(sizes)
                fresh = np.zeros(lot, bool)
                for k in np.flatnonzero(linked):
                    name = int(names[k])
                    fresh[k] = name not in seen
                    seen.add(name)
                bits = pa.array(parities(grams, bounds), pa.binary(), mask=~fresh)
                yield _batch(np.full(lot, DOC), np.arange(lot, dtype=np.int32) % buckets, bits, own, node, sizes)
                prints, owner = part_prints(grams, bounds, num, den, common)
                use = fresh[owner]
                prints, hub, pairs = hubs(prints[use], names[owner[use]])
                place = (prints >> np.uint64(40)) % np.uint64(buckets)
                order = np.argsort(place, kind="stable")
                cut = np.searchsorted(place[order], np.arange(buckets + 1))
                prints, hub = prints[order].view(np.int64), hub[order]
                some = np.flatnonzero(np.diff(cut))
                body = [np.concatenate([prints[cut[b]:cut[b + 1]], hub[cut[b]:cut[b + 1]]]).tobytes() for b in some]
                no = pa.nulls(len(some), pa.int64())
                yield _batch(np.full(len(some), PART), some, body, no, no, no)
                if len(pairs):
                    no = pa.nulls(len(pairs), pa.int64())
                    yield _batch(np.full(len(pairs), HUB), (pairs[:, 0].view(np.uint64) % np.uint64(buckets)).astype(np.int32),
                                 pa.nulls(len(pairs), pa.binary()), pairs[:, 0], pairs[:, 1], no)
    return run


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hub links of each bucket; documents and links found before pass through."""
    def links(parts: list[bytes]) -> pa.RecordBatch:
        both = [np.frombuffer(p, np.int64).reshape(2, -1) for p in parts]
        _, _, pairs = hubs(np.concatenate([b[0] for b in both]), np.concatenate([b[1] for b in both]))
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(pairs), HUB), pa.int32()), pa.array(pairs[:, 0]), pa.array(pairs[:, 1]),
                                           pa.nulls(len(pairs), pa.int64()), pa.nulls(len(pairs), pa.binary())], ["kind", "doc", "node", "n", "bits"])

    at, parts = None, []
    for batch in batches:
        kind = batch.column(0).to_numpy(zero_copy_only=False)
        yield batch.filter(pa.array(kind != PART)).select(["kind", "doc", "node", "n", "payload"]).rename_columns(["kind", "doc", "node", "n", "bits"])
        own = batch.filter(pa.array(kind == PART))
        for bucket, payload in zip(own.column(1).to_pylist(), own.column(2).to_pylist()):
            if bucket != at and parts:
                yield links(parts)
                parts = []
            at = bucket
            parts.append(payload)
    if parts:
        yield links(parts)


def _sets(n: int):
    """The n-gram sets of the members of families: their texts, with the set that is asked for."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, buf, offsets in text_slices(batch.column(3)):
                grams, bounds = gram_sets(buf, offsets, n)
                lot = batch.slice(begin, len(offsets) - 1)
                asked = lot.column(1)
                good = pa.array(set_names(grams, bounds) == asked.to_numpy())
                body = pa.array([grams[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])], pa.binary())
                out = pa.RecordBatch.from_arrays([lot.column(0), asked, lot.column(2), pa.array(np.diff(bounds)), body],
                                                 ["family", "node", "blocks", "n", "body"])
                yield out.filter(good)
    return run


def spanning(nodes: np.ndarray, side: np.ndarray, link: np.ndarray) -> np.ndarray:
    """Spanning forest (pairs of nodes) of the links between two sides, or within side 0 if it is the only one.

    Of ``link`` only what lies above the diagonal counts.
    """
    k = len(nodes)
    if side.any():
        for low in range(0, k, ROWS_AT_ONCE):
            link[low:low + ROWS_AT_ONCE] &= side[low:low + ROWS_AT_ONCE, None] != side[None, :]
    link = np.triu(link, 1)
    link |= link.T
    todo, pairs = np.ones(k, bool), []
    for root in range(k):
        if not todo[root]:
            continue
        reached, edge = np.zeros(k, bool), np.array([root])
        reached[root] = True
        while len(edge):
            edge = np.flatnonzero(link[edge].any(0) & ~reached)
            reached[edge] = True
        todo &= ~reached
        reached[root] = False
        pairs += [(nodes[i], nodes[root]) for i in np.flatnonzero(reached)]
    return np.array(pairs, np.int64).reshape(-1, 2)


def near(nodes: np.ndarray, side: np.ndarray, sizes: np.ndarray, bits: list[bytes], num: int, den: int) -> np.ndarray:
    """Spanning forest of the pairs whose parities do not rule a link out."""
    order = np.argsort(sizes, kind="stable")
    nodes, side, sizes, bits = nodes[order], side[order], sizes[order], [bits[i] for i in order]
    wide = np.array([len(b) for b in bits])
    k, link = len(bits), np.zeros((len(bits), len(bits)), bool)
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(wide)) + 1, [k]])
    groups = [(a, b, np.frombuffer(b"".join(bits[a:b]), np.uint8).reshape(b - a, -1)) for a, b in zip(cuts[:-1], cuts[1:])]
    for g, (begin, stop, own) in enumerate(groups):  # sets of one width with those and wider ones
        def end(row):  # larger ones cannot link
            return int(np.searchsorted(sizes, sizes[row] * den // num, "right"))

        body = []
        for a, b, other in groups[g:]:
            other = other[:max(0, end(stop - 1) - a)]
            while other.shape[1] > own.shape[1]:
                other = other[:, :other.shape[1] // 2] ^ other[:, other.shape[1] // 2:]
            body.append(other)
        body = np.concatenate(body)
        ones = np.bitwise_count(body).sum(1, dtype=np.int64)
        step, lots = max(16, CELLS // 8 // len(body)), range(0, stop - begin, ROWS_AT_ONCE)
        counts = np.zeros((stop - begin, len(body)), np.float32)
        for c in range(0, own.shape[1], step):
            m = np.unpackbits(body[:, c:c + step], axis=1).astype(np.float32)
            for low in lots:
                high = min(stop - begin, low + ROWS_AT_ONCE)
                last = end(begin + high - 1) - begin
                counts[low:high, low:last] += m[low:high] @ m[low:last].T
        for low in lots:
            high = min(stop - begin, low + ROWS_AT_ONCE)
            last = end(begin + high - 1) - begin
            apart = ones[low:high, None] + ones[None, low:last] - 2 * counts[low:high, low:last].astype(np.int64)
            one, other = sizes[begin + low:begin + high, None], sizes[None, begin + low:begin + last]
            link[begin + low:begin + high, begin + low:begin + last] = (apart <= (one + other) * (den - num) // (den + num)) & (one * den >= other * num)
    return spanning(nodes, side, link)


def forest(nodes: np.ndarray, side: np.ndarray, sets: list[np.ndarray], num: int, den: int) -> np.ndarray:
    """Spanning forest of the links."""
    sizes = np.array([len(s) for s in sets])
    order = np.argsort(sizes, kind="stable")
    nodes, side, sizes, sets = nodes[order], side[order], sizes[order], [sets[i] for i in order]
    col = np.concatenate(sets)
    by = np.argsort(col, kind="stable")
    col, rows = col[by], np.repeat(np.arange(len(sets), dtype=np.int32), sizes)[by]
    del by
    as_before = np.zeros(len(col) + 1, bool)
    as_before[1:-1] = col[1:] == col[:-1]
    keep = as_before[:-1] | as_before[1:]  # a column of one row adds to no overlap
    rows, first = rows[keep], ~as_before[:-1][keep]
    col = np.cumsum(first, dtype=np.int32) - np.int32(1)
    k, total = len(sets), int(first.sum())
    del keep, first, as_before
    step = max(128, CELLS // k)
    counts = np.zeros((k, k), np.float32)
    cut = np.searchsorted(col, np.arange(0, total + step, step))
    for c in range(len(cut) - 1):
        part = slice(cut[c], cut[c + 1])
        m = np.zeros((k, step), np.float32)
        m[rows[part], col[part] - c * step] = 1
        for low in range(0, k, ROWS_AT_ONCE):
            high = min(k, low + ROWS_AT_ONCE)
            end = int(np.searchsorted(sizes, sizes[high - 1] * den // num, "right"))  # larger ones cannot link
            counts[low:high, low:end] += m[low:high] @ m[low:end].T
    link = np.zeros((k, k), bool)
    for low in range(0, k, ROWS_AT_ONCE):
        rows = slice(low, low + ROWS_AT_ONCE)
        both = counts[rows].astype(np.int64)
        link[rows] = both * den >= (sizes[rows, None] + sizes[None, :] - both) * num
    return spanning(nodes, side, link)


def _product(num: int, den: int, by_bits: bool = False):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, nodes, sides, sizes, sets = None, [], [], [], []

        def done() -> pa.RecordBatch:
            names, first = np.unique(np.array(nodes, np.int64), return_index=True)
            side, pairs = np.array(sides, np.int64)[first], np.zeros((0, 2), np.int64)
            if len(names) > 1 and by_bits:
                pairs = near(names, side, np.array(sizes, np.int64)[first], [sets[i] for i in first], num, den)
            elif len(names) > 1:
                pairs = forest(names, side, [np.frombuffer(sets[i], np.uint64) for i in first], num, den)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

        for batch in batches:
            for family, i, j, block, node, n, body in zip(*(c.to_pylist() for c in batch.columns)):
                if at != (family, i, j):
                    if nodes:
                        yield done()
                    at, nodes, sides, sizes, sets = (family, i, j), [], [], [], []
                nodes.append(node)
                sides.append(int(block != i))
                sizes.append(n)
                sets.append(body)
        if nodes:
            yield done()
    return run


def in_blocks(members: DataFrame, room: Column) -> DataFrame:
    """``members`` (family, node, ...) with the number of blocks of their family; ``room`` is a row's bytes."""
    blocks = F.ceil(F.greatest(F.count("*") / BLOCK_ROWS, F.sum(room) / BLOCK_BYTES)).cast("long")
    return members.join(members.groupBy("family").agg(blocks.alias("blocks")), "family")


def turns(room: dict[int, int], most: int) -> list[tuple[int, int]]:
    """Ranges of (i + j) mod blocks that together ship at most ``most`` bytes, or one each. ``room``: bytes by number of blocks."""
    out, low, held = [], 0, 0
    for t in range(max(room, default=0)):
        now = sum(size for blocks, size in room.items() if blocks > t)
        if t > low and held + now > most:
            out, low, held = [*out, (low, t)], t, 0
        held += now
    return [*out, (low, max(room, default=0))]


def linked_in_blocks(members: DataFrame, sets: DataFrame, room: Column, run) -> DataFrame:
    """node, root: components of what ``run`` links in pairs of blocks of ``sets`` (SET), the sets of ``members``."""
    def met(sets: DataFrame, low: int, high: int) -> DataFrame:
        ends = [F.lit(low).cast("long"), F.least(F.lit(high).cast("long"), "blocks") - 1]
        spread = (sets.where(F.col("blocks") > low).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
                  .withColumn("turn", F.explode(F.sequence(*ends))).withColumn("other", F.pmod(F.col("turn") - F.col("block"), F.col("blocks"))))
        return (spread.select("family", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "n", "body")
                .repartition("family", "i", "j").sortWithinPartitions("family", "i", "j").mapInArrow(run, "a long, b long"))

    # a row for each number of blocks that occurs
    rooms = {r["blocks"]: int(r["room"]) for r in members.groupBy("blocks").agg(F.sum(room + 64).alias("room")).collect()}
    parts = turns(rooms, max(TURN_BYTES, sum(rooms.values())))
    if len(parts) == 1:
        return components(met(sets, *parts[0]))
    with passing(sets, "sets") as kept:
        return components(reduce(DataFrame.unionByName, [staged(met(kept, *part), "links") for part in parts]))


def common_grams(rows: DataFrame, n: int, sample: int = SAMPLE, share: float = COMMON) -> np.ndarray:
    """N-grams in more than ``share`` of ``sample`` documents drawn by a hash of the identifier; only speed hangs on them.

    There are at most 1 / ``share`` times as many as a sampled document has on average.
    """
    def grams_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, buf, offsets in text_slices(batch.column(0)):
                yield pa.RecordBatch.from_arrays([pa.array(gram_sets(buf, offsets, n)[0].view(np.int64))], ["gram"])

    drawn = rows.select("doc").where("doc IS NOT NULL").orderBy(F.xxhash64("doc"), "doc").limit(sample)
    texts = rows.join(F.broadcast(drawn.distinct()), "doc").select("text")  # at most ``sample`` identifiers
    found = texts.mapInArrow(grams_of, "gram long").groupBy("gram").count().where(F.col("count") > max(20, share * sample))
    return np.sort(np.array([r["gram"] for r in found.select("gram").collect()], np.int64)).view(np.uint64)


def linked_groups(docs: DataFrame, n: int = 3, num: int = 90, den: int = 100, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the least doc_id reachable by links)."""
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))
    buckets = 8 * width(spark)
    facts = (rows.mapInArrow(_emit(n, num, den, buckets, common_grams(rows, n)), PACKED).repartition(width(spark), "bucket")
             .sortWithinPartitions("bucket").mapInArrow(_gather, FACTS))
    facts = staged(facts, "facts")
    sets = facts.where(F.col("kind") == DOC).where("node IS NOT NULL").groupBy("node").agg(F.min("doc").alias("doc"), F.max("n").alias("n"))
    families = components(facts.where(F.col("kind") == HUB).select(F.col("doc").alias("a"), F.col("node").alias("b")))
    families = staged(families.join(sets, "node").select("node", F.col("root").alias("family"), "doc", "n"), "families")
    grams_room, bits_room = F.col("n") * 8, F.length("body")
    families = in_blocks(families, grams_room)
    if not families.where("blocks > 1").isEmpty():
        bits = facts.where(F.col("kind") == DOC).where("bits IS NOT NULL").select("node", "bits")
        bits = (families.where("blocks > 1").select("family", "node", "n").join(bits, "node").groupBy("family", "node")
                .agg(F.max("n").alias("n"), F.max("bits").alias("body")))
        with passing(bits, "bits") as bits:
            bits = in_blocks(bits, bits_room)
            apart = linked_in_blocks(bits, bits.select(*SET_COLUMNS), bits_room, _product(num, den, by_bits=True))
        cut = families.where("blocks > 1").join(apart, "node").select("node", F.col("root").alias("family"), "doc", "n")
        families = in_blocks(staged(families.where("blocks = 1").select("node", "family", "doc", "n").unionByName(cut), "families"), grams_room)
    # one way for every size: the texts are dealt by identifier, the members are not broadcast
    texts = rows.join(families.hint("merge"), "doc").select("family", "node", "blocks", "text")
    links = linked_in_blocks(families, texts.mapInArrow(_sets(n), SET), grams_room, _product(num, den))
    least = links.join(sets, "node").groupBy("root").agg(F.min("doc").alias("component"))
    names = sets.join(links, "node", "left").join(least, "root", "left").select("node", F.coalesce("component", "doc").alias("component"))
    known = facts.where(F.col("kind") == DOC).select("doc", "node", "n")
    return known.join(names, "node", "left").select(F.col("doc").alias(key), F.col("n").alias("n_shingles"),
                                                    F.coalesce("component", "doc").alias("component_id"))


def one_of_each(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that are the least of their component, with all their columns; rows without identifier stay."""
    groups = linked_groups(docs, n, num, den, key, text)
    name = "gone"
    while name in docs.columns:
        name += "_"
    gone = staged(groups.where(F.col(key) != F.col("component_id")).select(F.col(key).alias(name)).distinct(), "gone")
    return docs.join(gone.hint("merge"), docs[key] == gone[name], "left_anti")
