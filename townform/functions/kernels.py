"""Arrow kernels for the few shape measures that column expressions cannot express.

Each works on whole Arrow batches inside a task; Spark decides which rows meet. They are
shipped by value with the plan, so executors need no copy of this package.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

COMBINATIONS = 1 << 16  # segment pairs held in memory at once
SLICE = 1024  # rows of a batch that a kernel works on at once


def sliced(kernel, rows=SLICE, members=0):
    """The kernel over slices of its batch, so that what it holds does not grow with the batch.

    A slice goes on beyond ``rows`` as long as the lists of the first column have at most ``members`` members together.
    """
    def run(*columns):
        n, firsts, first = len(columns[0]), [], 0
        before = starts(list_sizes(columns[0])) if members else None
        while first < n or not firsts:
            firsts.append(first)
            first += rows
            if members:
                first = max(first, int(np.searchsorted(before, before[firsts[-1]] + members, "right")) - 1)
        parts = [kernel(*(c.slice(at, end - at) for c in columns)) for at, end in zip(firsts, [*firsts[1:], n])]
        return parts[0] if len(parts) == 1 else pa.concat_arrays(parts)

    return run


# --- ragged arrays ----------------------------------------------------------------

def starts(counts):
    return np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)


def spread(counts):
    """For each group its number, once per member, and the member's rank in the group."""
    group = np.repeat(np.arange(len(counts)), counts)
    return group, np.arange(len(group)) - starts(counts)[group]


def list_sizes(lists):
    return pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


def segments(rings):
    """Segments of each geometry as a (4, n) array x1, y1, x2, y2 and their offsets."""
    ring_counts = list_sizes(rings)
    ring = rings.flatten()
    pts = ring.field("pts")
    pt_counts = list_sizes(pts)
    pt = pts.flatten()
    x = pt.field("x").to_numpy(zero_copy_only=False)
    y = pt.field("y").to_numpy(zero_copy_only=False)
    first = np.ones(len(x), dtype=bool)
    first[np.cumsum(pt_counts)[pt_counts > 0] - 1] = False
    s = np.flatnonzero(first)
    of_geometry = np.repeat(np.arange(len(ring_counts)), ring_counts)
    counts = np.bincount(of_geometry, weights=np.maximum(pt_counts - 1, 0),
                         minlength=len(ring_counts)).astype(np.int64)
    return np.stack([x[s], y[s], x[s + 1], y[s + 1]]), starts(counts)


def next_segments(rings):
    """For each segment the one that follows it around its ring."""
    counts = np.maximum(list_sizes(rings.flatten().field("pts")) - 1, 0)
    ring, rank = spread(counts)
    base = starts(counts)[ring]
    return base + (rank + 1) % np.maximum(counts[ring], 1)


def combinations(na, nb):
    """All (group, i, j) with i < na[group], j < nb[group], in bounded pieces by group order."""
    rows = np.maximum(1, COMBINATIONS // np.maximum(nb, 1))
    group, piece = spread(-(-na // rows))
    first = piece * rows[group]
    work = np.minimum(rows[group], na[group] - first) * nb[group]
    load = np.cumsum(work) // COMBINATIONS
    for part in np.split(np.arange(len(group)), np.flatnonzero(np.diff(load)) + 1):
        member, k = spread(work[part])
        if len(k):
            g = group[part][member]
            yield g, first[part][member] + k // nb[g], k % nb[g]


def by_group(group):
    """Start of each run of equal values, for ``reduceat``."""
    return np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))


# --- distances --------------------------------------------------------------------

def to_segment(px, py, x1, y1, x2, y2):
    """Squared distance from points to segments."""
    dx, dy = x2 - x1, y2 - y1
    span = dx * dx + dy * dy
    t = ((px - x1) * dx + (py - y1) * dy) / np.where(span > 0, span, 1.0)
    t = np.clip(t, 0.0, 1.0)
    ex, ey = px - x1 - t * dx, py - y1 - t * dy
    return ex * ex + ey * ey


def turn(ax, ay, bx, by, cx, cy):
    return (bx - ax) * (cy - ay) - (by - ay) * (cx - ax)


def between_segments(a, b):
    """Squared distance between segments, 0 where they cross."""
    d = np.minimum(np.minimum(to_segment(a[0], a[1], *b), to_segment(a[2], a[3], *b)),
                   np.minimum(to_segment(b[0], b[1], *a), to_segment(b[2], b[3], *a)))
    cross = ((turn(*a, b[0], b[1]) * turn(*a, b[2], b[3]) < 0)
             & (turn(*b, a[0], a[1]) * turn(*b, a[2], a[3]) < 0))
    return np.where(cross, 0.0, d)


def facing(a, b, tol):
    """Length along which segments lie on each other in opposite directions."""
    dx, dy = a[2] - a[0], a[3] - a[1]
    size = np.sqrt(dx * dx + dy * dy)
    size = np.where(size > 0, size, 1.0)
    off1 = np.abs(turn(*a, b[0], b[1])) / size
    off2 = np.abs(turn(*a, b[2], b[3])) / size
    opposite = dx * (b[2] - b[0]) + dy * (b[3] - b[1]) < 0
    s1 = ((b[0] - a[0]) * dx + (b[1] - a[1]) * dy) / size
    s2 = ((b[2] - a[0]) * dx + (b[3] - a[1]) * dy) / size
    shared = np.minimum(s1, size) - np.maximum(s2, 0.0)
    return np.where(opposite & (off1 <= tol) & (off2 <= tol), np.maximum(shared, 0.0), 0.0)


def inside(px, py, geom, seg, offs):
    """Whether each point lies inside polygon ``geom``, by counting crossings of a ray."""
    odd = np.zeros(len(px), dtype=np.int64)
    for g, _, j in combinations(np.ones(len(px), dtype=np.int64), np.diff(offs)[geom]):
        x1, y1, x2, y2 = seg[:, offs[geom[g]] + j]
        x, y = px[g], py[g]
        rise = np.where(y2 != y1, y2 - y1, 1.0)
        hit = ((y1 > y) != (y2 > y)) & (x < (x2 - x1) * (y - y1) / rise + x1)
        runs = by_group(g)
        odd[g[runs]] += np.add.reduceat(hit.astype(np.int64), runs)
    return odd % 2 == 1


def polygon_gaps(seg_a, off_a, ia, seg_b, off_b, ib, tol=None):
    """Distance of single-part polygons ``ia[k]`` and ``ib[k]``; with ``tol`` also the wall
    length they share."""
    na, nb = np.diff(off_a)[ia], np.diff(off_b)[ib]
    best = np.full(len(ia), np.inf)
    shared = np.zeros(len(ia))
    for g, i, j in combinations(na, nb):
        a, b = seg_a[:, off_a[ia[g]] + i], seg_b[:, off_b[ib[g]] + j]
        runs = by_group(g)
        at = g[runs]
        best[at] = np.minimum(best[at], np.minimum.reduceat(between_segments(a, b), runs))
        if tol is not None:
            shared[at] += np.add.reduceat(facing(a, b, tol), runs)
    apart = np.flatnonzero((best > 0) & np.isfinite(best))
    if len(apart):
        pa_, pb_ = seg_a[:2, off_a[ia[apart]]], seg_b[:2, off_b[ib[apart]]]
        nested = (inside(*pa_, ib[apart], seg_b, off_b) | inside(*pb_, ia[apart], seg_a, off_a))
        best[apart[nested]] = 0.0
    return np.sqrt(best), shared


# --- parts of walls covered by a neighbour ----------------------------------------

def nearest(px, py, group, seg, offs):
    """Squared distance of each point to the outline of polygon ``group``."""
    best = np.full(len(px), np.inf)
    for g, _, j in combinations(np.ones(len(px), dtype=np.int64), np.diff(offs)[group]):
        runs = by_group(g)
        d = to_segment(px[g], py[g], *seg[:, offs[group[g]] + j])
        best[g[runs]] = np.minimum(best[g[runs]], np.minimum.reduceat(d, runs))
    return best


def covered_walls(seg_a, off_a, seg_b, off_b, tol, contacts=False):
    """Intervals of the walls of polygon k of a that lie in, or within ``tol`` of, polygon k
    of b: arrays pair, wall, t0, t1 with t in [0, 1] along the wall.

    With ``contacts`` also the points where the outlines meet, as intervals of no length.
    """
    na, nb = np.diff(off_a), np.diff(off_b)
    na = np.where(nb > 0, na, 0)
    wall_pair, wall = spread(na)
    wall_seg = off_a[:-1][wall_pair] + wall
    wall_base = starts(na)
    cut_wall, cut_t = [np.arange(len(wall)), np.arange(len(wall))], [np.zeros(len(wall)),
                                                                     np.ones(len(wall))]
    for g, i, j in combinations(na, nb):
        a, b = seg_a[:, off_a[g] + i], seg_b[:, off_b[g] + j]
        dx, dy = a[2] - a[0], a[3] - a[1]
        span = np.where(dx * dx + dy * dy > 0, dx * dx + dy * dy, 1.0)
        at = wall_base[g] + i
        h1, h2 = turn(*a, b[0], b[1]), turn(*a, b[2], b[3])
        for h, x, y in ((h1, b[0], b[1]), (h2, b[2], b[3])):
            t = ((x - a[0]) * dx + (y - a[1]) * dy) / span
            near = (np.abs(h) <= tol * np.sqrt(span)) & (t > 0) & (t < 1)
            cut_wall.append(at[near])
            cut_t.append(t[near])
        bend = h1 - h2
        u = h1 / np.where(bend != 0, bend, 1.0)
        x, y = b[0] + u * (b[2] - b[0]), b[1] + u * (b[3] - b[1])
        t = ((x - a[0]) * dx + (y - a[1]) * dy) / span
        hit = (bend != 0) & (u >= 0) & (u <= 1) & (t > 0) & (t < 1)
        cut_wall.append(at[hit])
        cut_t.append(t[hit])
    w, t = np.concatenate(cut_wall), np.concatenate(cut_t)
    order = np.lexsort((t, w))
    w, t = w[order], t[order]
    piece = np.flatnonzero((w[1:] == w[:-1]) & (t[1:] - t[:-1] > 1e-12))
    walls, t0, t1 = w[piece], t[piece], t[piece + 1]

    def place(walls, t):
        s = wall_seg[walls]
        return (seg_a[0, s] + t * (seg_a[2, s] - seg_a[0, s]),
                seg_a[1, s] + t * (seg_a[3, s] - seg_a[1, s]))

    x, y = place(walls, (t0 + t1) / 2)
    pair = wall_pair[walls]
    hidden = (nearest(x, y, pair, seg_b, off_b) <= tol * tol) | inside(x, y, pair, seg_b, off_b)
    walls, t0, t1 = walls[hidden], t0[hidden], t1[hidden]
    if contacts:
        meet = nearest(*place(w, t), wall_pair[w], seg_b, off_b) <= tol * tol
        walls = np.concatenate([walls, w[meet]])
        t0, t1 = np.concatenate([t0, t[meet]]), np.concatenate([t1, t[meet]])
        order = np.argsort(walls, kind="stable")
        walls, t0, t1 = walls[order], t0[order], t1[order]
    return wall_pair[walls], wall[walls], t0, t1


# --- areas of overlaid shapes -----------------------------------------------------

def places(shape, x, of, at, after=False):
    """How many of the values (shape, x), sorted, stand before each (of, at); ``after``: before or level with."""
    asked = np.concatenate([np.zeros(len(x), dtype=bool), np.ones(len(at), dtype=bool)])
    order = np.lexsort((asked == (not after), np.concatenate([x, at]), np.concatenate([shape, of])))
    before = np.empty(len(asked), dtype=np.int64)
    before[order] = np.cumsum(~asked[order])
    return before[len(x):]


def bounded(counts):
    """Cut groups into runs of at most about ``COMBINATIONS`` members: slices of group numbers."""
    load = np.cumsum(counts) // COMBINATIONS
    ends = np.flatnonzero(np.diff(load)) + 1
    return zip(np.concatenate([[0], ends]), np.concatenate([ends, [len(counts)]]))


def crossings(edge, offs):
    """Shape and x of every point where two edges of one shape cross.

    Edges are swept by their left ends: only edges with common x are compared.
    """
    shape = np.repeat(np.arange(len(offs) - 1), np.diff(offs))
    left, right = np.minimum(edge[0], edge[2]), np.maximum(edge[0], edge[2])
    order = np.lexsort((left, shape))
    shape, left, right = shape[order], left[order], right[order]
    partners = np.maximum(places(shape, left, shape, right) - np.arange(len(shape)) - 1, 0)
    for first, last in bounded(partners):
        i, rank = spread(partners[first:last])
        i = i + first
        g, i, j = shape[i], order[i], order[i + 1 + rank]
        dxi, dyi = edge[2, i] - edge[0, i], edge[3, i] - edge[1, i]
        dxj, dyj = edge[2, j] - edge[0, j], edge[3, j] - edge[1, j]
        bend = dxi * dyj - dyi * dxj
        safe = np.where(bend != 0, bend, 1.0)
        ox, oy = edge[0, j] - edge[0, i], edge[1, j] - edge[1, i]
        t, u = (ox * dyj - oy * dxj) / safe, (ox * dyi - oy * dxi) / safe
        hit = (bend != 0) & (t > 0) & (t < 1) & (u > 0) & (u < 1)
        yield g[hit], (edge[0, i] + t * dxi)[hit]


def overlay_areas(edge, layer, offs, layers):
    """For each shape the area lying inside all its layers.

    A layer is a set of closed outlines, interior to the right; outlines of one layer are
    united. The plane is cut into vertical slabs at all vertices and crossings. Inside a slab
    edges are straight and do not cross, so heights at its middle are exact.
    """
    n = len(offs) - 1
    shape = np.repeat(np.arange(n), np.diff(offs))
    if not len(shape):
        return np.zeros(n)
    found = list(crossings(edge, offs))
    cut_shape = np.concatenate([shape, shape] + [g for g, _ in found])
    cut = np.concatenate([edge[0], edge[2]] + [x for _, x in found])
    order = np.lexsort((cut, cut_shape))
    cut_shape, cut = cut_shape[order], cut[order]
    width = np.diff(cut)
    slab = np.flatnonzero((cut_shape[1:] == cut_shape[:-1]) & (width > 1e-12))
    of, mid, width = cut_shape[slab], (cut[slab] + cut[slab + 1]) / 2, width[slab]
    area = np.zeros(n)
    if not len(of):
        return area
    # the slabs that each edge spans, and how many edges span each slab
    first = places(of, mid, shape, np.minimum(edge[0], edge[2]), after=True)
    last = np.maximum(places(of, mid, shape, np.maximum(edge[0], edge[2])), first)
    active = np.cumsum(np.bincount(first, minlength=len(of) + 1) - np.bincount(last, minlength=len(of) + 1))[:-1]
    for low, high in bounded(active):
        e = np.flatnonzero((first < high) & (last > low))
        begin = np.maximum(first[e], low)
        k, rank = spread(np.minimum(last[e], high) - begin)
        s, e = begin[k] + rank, e[k]
        if not len(s):
            continue
        x1, y1, x2, y2 = edge[:, e]
        y = y1 + (mid[s] - x1) / (x2 - x1) * (y2 - y1)
        order = np.lexsort((y, s))
        s, e, y, enter = s[order], e[order], y[order], -np.sign(x2 - x1)[order]
        within = np.ones(len(s), dtype=bool)
        for k in range(layers):
            # outlines close, so the running depth is back at 0 where a slab ends
            within &= np.cumsum(np.where(layer[e] == k, enter, 0.0)) > 0.5
        inner = np.flatnonzero(within[:-1] & (s[1:] == s[:-1]))
        area += np.bincount(of[s[inner]], (y[inner + 1] - y[inner]) * width[s[inner]], n)
    return area


def joined(parts, offsets):
    """Concatenate ragged (4, n) arrays shape by shape; also the part number of each column."""
    counts = np.stack([np.diff(o) for o in offsets])
    offs = starts(counts.sum(axis=0))
    out, layer = np.empty((4, offs[-1])), np.empty(offs[-1], dtype=np.int64)
    at = offs[:-1].copy()
    for k, (part, o) in enumerate(zip(parts, offsets)):
        shape, rank = spread(counts[k])
        place = at[shape] + rank
        out[:, place], layer[place] = part[:, :o[-1]], k
        at += counts[k]
    return out, layer, offs


def centred(seg, offs, origin):
    """Coordinates relative to one point per shape: large ones lose digits in products."""
    shape = np.repeat(np.arange(len(offs) - 1), np.diff(offs))
    return seg - np.tile(origin[:, shape], (2, 1))


def first_points(seg, offs):
    """First vertex of each shape, 0 for an empty one."""
    out = np.zeros((2, len(offs) - 1))
    some = np.diff(offs) > 0
    out[:, some] = seg[:2, offs[:-1][some]]
    return out


def free_pieces(walls, wall, t0, t1):
    """What covered intervals leave of walls 0..``walls``: arrays wall, t0, t1, in order."""
    every = np.arange(walls)
    w = np.concatenate([wall, every, every])
    lo = np.concatenate([t0, np.full(walls, -1.0), np.ones(walls)])
    hi = np.concatenate([t1, np.zeros(walls), np.full(walls, 2.0)])
    order = np.lexsort((hi, lo, w))
    w, lo, hi = w[order], lo[order], hi[order]
    # furthest end so far, anew on each wall: by ranks, which keep the ends exact however many walls there are
    by_end = np.argsort(hi, kind="stable")
    rank = np.empty(len(hi), dtype=np.int64)
    rank[by_end] = np.arange(len(hi))
    reach = hi[by_end[np.maximum.accumulate(rank + w * len(hi)) - w * len(hi)]]
    gap = np.flatnonzero((w[1:] == w[:-1]) & (lo[1:] - reach[:-1] > 1e-9))
    return w[gap], reach[gap], lo[gap + 1]


def along(seg, wall, t0, t1):
    """Ends of the pieces [t0, t1] of walls."""
    dx, dy = seg[2, wall] - seg[0, wall], seg[3, wall] - seg[1, wall]
    return np.stack([seg[0, wall] + t0 * dx, seg[1, wall] + t0 * dy,
                     seg[0, wall] + t1 * dx, seg[1, wall] + t1 * dy])


def lit_areas(seg, offs, wall, t0, t1, depth):
    """Area of each footprint within ``depth`` of its free walls, seen square from the wall.
    ``wall`` numbers walls over all footprints."""
    seg = centred(seg, offs, first_points(seg, offs))
    owner = np.repeat(np.arange(len(offs) - 1), np.diff(offs))
    on, a, b = free_pieces(seg.shape[1], wall, t0, t1)
    x1, y1, x2, y2 = along(seg, on, a, b)
    size = np.hypot(x2 - x1, y2 - y1)
    real = size > 0
    on, x1, y1, x2, y2, size = on[real], x1[real], y1[real], x2[real], y2[real], size[real]
    nx, ny = (y2 - y1) / size * depth, -(x2 - x1) / size * depth
    strips = np.stack([
        np.stack([x1, y1, x2, y2]), np.stack([x2, y2, x2 + nx, y2 + ny]),
        np.stack([x2 + nx, y2 + ny, x1 + nx, y1 + ny]), np.stack([x1 + nx, y1 + ny, x1, y1])], axis=2)
    per_shape = 4 * np.bincount(owner[on], minlength=len(offs) - 1)
    return overlay_areas(*joined([seg, strips.reshape(4, -1)], [offs, starts(per_shape)]), 2)


def common_areas(seg_a, off_a, seg_b, off_b):
    """Area shared by polygon k of a and polygon k of b. Both are cut to their common range of x."""
    origin = first_points(seg_a, off_a)
    parts, offsets = [centred(seg_a, off_a, origin), centred(seg_b, off_b, origin)], [off_a, off_b]
    boxes = [shape_boxes(*p) for p in zip(parts, offsets)]
    low, high = np.maximum(boxes[0][0], boxes[1][0]), np.minimum(boxes[0][2], boxes[1][2])
    cut = [within_x(*p, low, high) for p in zip(parts, offsets)]
    return overlay_areas(*joined([c[0] for c in cut], [c[1] for c in cut]), 2)


def shape_boxes(seg, offs):
    """xmin, ymin, xmax, ymax of each shape; an empty one has an empty range."""
    owner, n = np.repeat(np.arange(len(offs) - 1), np.diff(offs)), len(offs) - 1
    low, high = np.full((2, n), np.inf), np.full((2, n), -np.inf)
    for axis in (0, 1):
        np.minimum.at(low[axis], owner, np.minimum(seg[axis], seg[axis + 2]))
        np.maximum.at(high[axis], owner, np.maximum(seg[axis], seg[axis + 2]))
    return np.concatenate([low, high])


def kept_segments(seg, offs, keep):
    owner = np.repeat(np.arange(len(offs) - 1), np.diff(offs))
    return seg[:, keep], starts(np.bincount(owner[keep], minlength=len(offs) - 1))


def within_x(seg, offs, low, high):
    """Segments cut to the range [low, high] of their shape; those outside go."""
    owner = np.repeat(np.arange(len(offs) - 1), np.diff(offs))
    low, high = low[owner], high[owner]
    x1, y1, x2, y2 = seg
    keep = (np.minimum(x1, x2) < high) & (np.maximum(x1, x2) > low)
    with np.errstate(divide="ignore", invalid="ignore"):
        slope = (y2 - y1) / (x2 - x1)
        a, b = np.clip(x1, low, high), np.clip(x2, low, high)
        ya, yb = np.where(a == x1, y1, y1 + (a - x1) * slope), np.where(b == x2, y2, y2 + (b - x2) * slope)
    return kept_segments(np.stack([a, ya, b, yb]), offs, keep)


def common_borders(seg_a, off_a, seg_b, off_b, tol):
    """Length of the walls that polygon k of a and polygon k of b share: parts within ``tol`` of each other.

    Walls are swept by their left ends; only those with a common box are compared.
    """
    origin = first_points(seg_a, off_a)
    edge, layer, offs = joined([centred(seg_a, off_a, origin), centred(seg_b, off_b, origin)], [off_a, off_b])
    n = len(offs) - 1
    total = np.zeros(n)
    shape = np.repeat(np.arange(n), np.diff(offs))
    left, right = np.minimum(edge[0], edge[2]), np.maximum(edge[0], edge[2]) + tol
    low, high = np.minimum(edge[1], edge[3]), np.maximum(edge[1], edge[3]) + tol
    order = np.lexsort((left, shape))
    shape, left, right = shape[order], left[order], right[order]
    partners = np.maximum(places(shape, left, shape, right, after=True) - np.arange(len(shape)) - 1, 0)
    for first, last in bounded(partners):
        i, rank = spread(partners[first:last])
        i, j = order[i + first], order[i + first + 1 + rank]
        meet = (layer[i] != layer[j]) & (low[i] <= high[j]) & (low[j] <= high[i])
        i, j = i[meet], j[meet]
        of = np.searchsorted(offs, i, "right") - 1
        dx, dy = edge[2, i] - edge[0, i], edge[3, i] - edge[1, i]
        size = np.hypot(dx, dy)
        some = np.where(size > 0, size, 1.0)
        along, off = [], []
        for end in (0, 2):
            ox, oy = edge[end, j] - edge[0, i], edge[end + 1, j] - edge[1, i]
            along.append((ox * dx + oy * dy) / some)
            off.append((ox * dy - oy * dx) / some)
        begin = np.clip(np.minimum(*along), 0, size)
        end = np.clip(np.maximum(*along), 0, size)
        run = along[1] - along[0]
        slope = np.where(run != 0, (off[1] - off[0]) / np.where(run != 0, run, 1.0), np.inf)
        close = end > begin
        with np.errstate(invalid="ignore"):
            for t in (begin, end):
                close &= np.abs(off[0] + (t - along[0]) * slope) <= tol
        total += np.bincount(of[close], (end - begin)[close], n)
    return total


# --- convex hulls -----------------------------------------------------------------

def half_hulls(x, y, n):
    """Chain of right-hand turns dropped, over rows of points in order: positions and sizes."""
    rows = np.arange(len(n))
    chain = np.zeros(x.shape, dtype=np.int64)
    top = np.zeros(len(n), dtype=np.int64)
    for i in range(x.shape[1]):
        live = rows[i < n]
        popping = live
        while len(popping := popping[top[popping] > 1]):
            p, q = chain[popping, top[popping] - 2], chain[popping, top[popping] - 1]
            bent = turn(x[popping, p], y[popping, p], x[popping, q], y[popping, q],
                        x[popping, i], y[popping, i]) <= 0
            popping = popping[bent]
            top[popping] -= 1
        chain[live, top[live]] = i
        top[live] += 1
    return chain, top


def convex_hulls(x, y, offs):
    """Counter-clockwise hull of each group of points, as positions in x, y and offsets.

    Groups of like size are handled together, one point of all groups at a time.
    """
    count = np.diff(offs)
    group = np.repeat(np.arange(len(count)), count)
    order = np.lexsort((y, x, group))
    owners, found, ranks = [], [], []
    size_class = np.frexp(np.maximum(count, 1))[1]
    for c in np.unique(size_class[count > 0]):
        rows = np.flatnonzero((size_class == c) & (count > 0))
        n = count[rows]
        rank = np.arange(n.max())
        for back in (False, True):
            place = np.where(rank < n[:, None], n[:, None] - 1 - rank if back else rank, 0)
            at = order[offs[rows][:, None] + place]
            chain, top = half_hulls(x[at], y[at], n)
            r, k = spread(np.maximum(top - 1, 1 - back))  # the end point starts the other half
            owners.append(rows[r])
            found.append(at[r, chain[r, k]])
            ranks.append(k + back * len(x))
    if not owners:
        return np.zeros(0, dtype=np.int64), starts(count)
    owner, at, rank = np.concatenate(owners), np.concatenate(found), np.concatenate(ranks)
    order = np.lexsort((rank, owner))
    return at[order], starts(np.bincount(owner, minlength=len(count)))


def hull_measures(x, y, offs):
    """Area, perimeter, least width and azimuth (degrees) of the side it rests on, by group;
    the azimuth of a group without extent is NaN."""
    at, hull = convex_hulls(x, y, offs)
    n = np.diff(hull)
    owner, rank = spread(n)
    first = at[hull[:-1][owner]]
    hx, hy = x[at] - x[first], y[at] - y[first]
    after = hull[:-1][owner] + (rank + 1) % n[owner]
    dx, dy = hx[after] - hx, hy[after] - hy
    size = np.hypot(dx, dy)
    area = np.bincount(owner, hx * hy[after] - hx[after] * hy, len(n)) / 2
    perimeter = np.bincount(owner, size, len(n))
    width = np.zeros(len(at))
    for side, _, j in combinations(np.ones(len(at), dtype=np.int64), n[owner]):
        point = hull[:-1][owner[side]] + j
        off = dx[side] * (hy[point] - hy[side]) - dy[side] * (hx[point] - hx[side])
        runs = by_group(side)
        width[side[runs]] = np.maximum(width[side[runs]], np.maximum.reduceat(off, runs))
    real = size > 0
    width = np.where(real, width / np.where(real, size, 1.0), np.inf)
    least = np.full(len(n), np.inf)
    np.minimum.at(least, owner, width)
    azimuth = np.degrees(np.arctan2(dx, dy)) % 180.0
    azimuth[azimuth > 180.0 - 1e-9] = 0.0
    # a square rests on either side: the smallest azimuth wins
    ties = real & (width <= least[owner] * (1 + 1e-9)) & (n[owner] > 2)
    rest = np.full(len(n), np.inf)
    np.minimum.at(rest, owner[ties], azimuth[ties])
    flat = ~np.isfinite(rest)
    return area, perimeter, np.where(flat, 0.0, least), np.where(flat, np.nan, rest)


# --- connected components of one partition -----------------------------------------

def least_labels(a, b, n):
    """Smallest vertex number of each vertex's component."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        if (low == label[a]).all() and (low == label[b]).all():
            return label
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while (label != label[label]).any():
            label = label[label]
