"""Votes of many trees over many rows at once: a test is a bitmap of rows, a leaf the rows that meet its tests."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TEST_BYTES = 1 << 25  # bitmaps of tests kept for later trees
NODE = np.dtype([("place", "i4"), ("split", "f8"), ("left", "i4"), ("right", "i4"), ("leaf", "i4"), ("root", "?")])


def packed(table: pa.Table, classes: list[str]) -> bytes:
    """Nodes of whole trees as ``NODE`` records that point at each other by position. ``place`` is -1 at a leaf."""
    tree, node, place, split, left, right = (
        table[c].fill_null(-1).to_numpy() for c in ("tree", "node", "place", "split", "left", "right"))
    order = np.lexsort((node, tree))
    tree, node = tree[order], node[order]
    out = np.zeros(len(order), dtype=NODE)
    inner = place[order] >= 0
    out["place"], out["split"] = place[order], split[order]
    out["root"] = np.append(True, tree[1:] != tree[:-1])[:len(order)]
    names = {c: k for k, c in enumerate(classes)}
    out["leaf"] = np.array([names.get(c, -1) for c in table["class"].to_pylist()], dtype="i4")[order]
    for side, to in (("left", left), ("right", right)):
        at = np.flatnonzero(inner)
        # positions of (tree, node): ranks among all asked and all present
        asked = np.lexsort((np.append(np.zeros(len(order)), np.ones(len(at))),
                            np.append(node, to[order][at]), np.append(tree, tree[at])))
        own = asked < len(order)
        place_of = np.empty(len(asked), dtype=np.int64)
        place_of[asked] = np.cumsum(own) - 1
        out[side][at] = place_of[len(order):]
    return out.tobytes()


class Tally:
    """Counts set bits row by row: numbers of one bit each, added up in planes of powers of two."""

    def __init__(self):
        self.planes = []

    def add(self, mask):
        for plane in self.planes:
            if plane[1] is None:
                plane[1] = mask
                return
            a, b = plane
            either = a ^ b
            plane[0], plane[1], mask = either ^ mask, None, (a & b) | (either & mask)
        self.planes.append([mask, None])

    def counts(self, n):
        out = np.zeros(n, dtype=np.int32)
        for k, plane in enumerate(self.planes):
            for mask in plane:
                if mask is not None:
                    out += np.unpackbits(mask.view(np.uint8), count=n, bitorder="little").astype(np.int32) << k
        return out


def ballots(nodes, x, classes):
    """Votes of every class (rows of the result) for the ``n`` rows of ``x``, predictors by rows, counted over all trees."""
    n = x.shape[1]
    words = -(-n // 64)
    kept, most = {}, max(1, TEST_BYTES // (8 * words))
    full = np.full(words, ~np.uint64(0))
    bits = np.zeros(8 * words, dtype=np.uint8)
    tallies = [Tally() for _ in range(classes)]
    place, split, left, right, leaf = (nodes[c].tolist() for c in ("place", "split", "left", "right", "leaf"))

    def met(k):
        test = (place[k], split[k])
        mask = kept.get(test)
        if mask is None:
            if len(kept) >= most:
                kept.clear()
            # as in Spark, an unknown number is above all others and equals itself
            low = x[place[k]] <= split[k] if split[k] == split[k] else np.ones(n, dtype=bool)
            bits[:-(-n // 8)] = np.packbits(low, bitorder="little")
            mask = kept[test] = bits.view(np.uint64).copy()
        return mask

    for root in np.flatnonzero(nodes["root"]).tolist():
        found = {}
        walk = [(root, full, 0)]
        while walk:
            k, rows, depth = walk.pop()
            if place[k] < 0:
                of = leaf[k]
                found[of] = found[of] | rows if of in found else rows
            elif depth % 4 or not depth or rows.any():  # deep branches without rows are not gone down
                low = rows & met(k)
                walk.append((left[k], low, depth + 1))
                walk.append((right[k], rows ^ low, depth + 1))
        for of, rows in found.items():
            tallies[of].add(rows)
    return np.stack([t.counts(n) for t in tallies])
