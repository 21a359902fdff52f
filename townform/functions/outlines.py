"""Free outlines of buildings as chains of walls, for whole Arrow batches at once."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

from townform.functions.kernels import along, centred, first_points, free_pieces, list_sizes, next_segments, segments, sliced, starts

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WALLS = "array<struct<x1: double, y1: double, x2: double, y2: double>>"
ENDS = ("sx", "sy", "sdx", "sdy", "ex", "ey", "edx", "edy")
SUMS = ("moment", "length", "corner")
CHAIN = ", ".join(["closed: boolean", *(f"{c}: double" for c in (*ENDS, *SUMS))])
NEAR_END = 1e-9  # of a wall's length


def ranked(after):
    """First item of every item's chain, its place there, and whether the chain is a circle.

    ``after`` names the next item of each, -1 at the end of a chain. Pointers are doubled, so the rounds
    grow with the logarithm of the longest chain. A circle begins at its least item.
    """
    item = np.arange(len(after))
    before = np.full(len(after), -1)
    linked = after >= 0
    before[after[linked]] = item[linked]
    rounds = range(len(after).bit_length())
    low, far = item, np.where(before >= 0, before, item)
    for _ in rounds:
        low, far = np.minimum(low, low[far]), far[far]
    circle = before[far] >= 0  # the way back never came to a first item
    before[circle & (low == item)] = -1
    place, first = (before >= 0).astype(np.int64), np.where(before >= 0, before, item)
    for _ in rounds:
        place, first = place + place[first], first[first]
    return first, place, circle[first]


def free_chains_of(seg, offs, after, wall, t0, t1):
    """Chains of the walls that the covered intervals leave, in order of shapes.

    Gives the number of chains of each shape, the columns of ``CHAIN``, the number of walls of each chain
    and the walls. ``moment`` is twice the signed area about the origin; ``corner`` sums the share of each
    corner in the area between the outline and its offset by 1.
    """
    origin = first_points(seg, offs)
    owner = np.repeat(np.arange(len(offs) - 1), np.diff(offs))
    seg = centred(seg, offs, origin)
    s, a, b = free_pieces(seg.shape[1], wall, t0, t1)
    met = np.zeros((2, seg.shape[1] + 1), dtype=bool)
    met[0, wall[t1 > 1 - NEAR_END]] = True  # a contact at the end, or at the begin, of a wall parts chains
    met[1, wall[t0 < NEAR_END]] = True
    first_on = np.full(seg.shape[1] + 1, -1)
    whole = np.flatnonzero(a < NEAR_END)
    first_on[s[whole]] = whole
    goes_on = (b > 1 - NEAR_END) & ~met[0, s] & ~met[1, after[s]]
    first, place, closed = ranked(np.where(goes_on, first_on[after[s]], -1))
    order = np.lexsort((place, first))
    head = np.flatnonzero(place[order] == 0)
    last = np.append(head[1:], len(order))[:len(head)] - 1
    x1, y1, x2, y2 = pieces = along(seg, s[order], a[order], b[order])
    of = owner[s[order]]
    dx, dy = x2 - x1, y2 - y1
    # the corner behind each wall; the last wall of a circle turns into its first, that of an open chain ends
    nxt = np.arange(1, len(order) + 1)
    nxt[last] = head
    turning = np.arctan2(dx * dy[nxt] - dy * dx[nxt], dx * dx[nxt] + dy * dy[nxt]) if len(order) else dx
    corner = np.where(turning > 0, np.tan(turning / 2), turning / 2)
    corner[last[~closed[order][head]]] = 0.0
    ox, oy = origin[:, of[head]]
    sums = [np.add.reduceat(v, head) if len(head) else v for v in (x1 * y2 - x2 * y1, np.hypot(dx, dy), corner)]
    sums[0] += ox * (y2[last] - y1[head]) - oy * (x2[last] - x1[head])
    ends = [x1[head] + ox, y1[head] + oy, dx[head], dy[head], x2[last] + ox, y2[last] + oy, dx[last], dy[last]]
    pieces = pieces + np.tile(origin[:, of], (2, 1))
    return np.bincount(of[head], minlength=len(offs) - 1), [closed[order][head], *ends, *sums], last - head + 1, pieces


def chains(geom: Column, spans: Column, walls: bool = False) -> Column:
    """Free outline of a building as chains, cut where the covered ``spans`` begin and end; with their ``walls`` on request."""
    kind = f"array<struct<{CHAIN}{', walls: ' + WALLS if walls else ''}>>"

    def measure(rings: pa.Array, spans: pa.Array) -> pa.Array:
        seg, offs = segments(rings)
        span = spans.flatten()
        wall, t0, t1 = (span.field(n).to_numpy(zero_copy_only=False) for n in ("wall", "t0", "t1"))
        wall = wall + np.repeat(offs[:-1], list_sizes(spans))
        counts, columns, sizes, pieces = free_chains_of(seg, offs, next_segments(rings), wall, t0, t1)
        fields = [pa.array(columns[0], pa.bool_()), *(pa.array(c, pa.float64()) for c in columns[1:])]
        names = ["closed", *ENDS, *SUMS]
        if walls:
            piece = pa.StructArray.from_arrays([pa.array(c, pa.float64()) for c in pieces], ["x1", "y1", "x2", "y2"])
            fields.append(pa.ListArray.from_arrays(pa.array(starts(sizes).astype(np.int32)), piece))
            names.append("walls")
        return pa.ListArray.from_arrays(pa.array(starts(counts).astype(np.int32)), pa.StructArray.from_arrays(fields, names))

    @F.arrow_udf(kind)
    def run(rings: pa.Array, spans: pa.Array) -> pa.Array:
        return sliced(measure)(rings, spans)

    return run(geom["rings"], spans)
