"""Column functions backed by the Arrow kernels."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

from townform.functions.kernels import (
    common_areas, covered_walls, hull_measures, list_sizes, lit_areas, common_borders, polygon_gaps,
    segments, sliced, starts)

cloudpickle.register_pickle_by_value(sys.modules[__name__])

HULL = "struct<area: double, perimeter: double, width: double, azimuth: double>"
GAP = "struct<dist: double, shared: double>"
SPANS = "array<struct<wall: int, t0: double, t1: double>>"


def _struct(columns: dict) -> pa.Array:
    return pa.StructArray.from_arrays([pa.array(v, pa.float64()) if isinstance(v, np.ndarray) else v
                                       for v in columns.values()],
                                      list(columns))


def hulls_of(x, y, offs) -> pa.Array:
    area, perimeter, width, azimuth = hull_measures(x, y, offs)
    return _struct({"area": area, "perimeter": perimeter, "width": width,
                    "azimuth": pa.array(azimuth, pa.float64(), mask=np.isnan(azimuth))})


def hull(geom: Column) -> Column:
    """Convex hull measures of a polygon: area, perimeter, least width, azimuth."""

    def measure(rings: pa.Array) -> pa.Array:
        seg, offs = segments(rings)
        return hulls_of(seg[0], seg[1], offs)

    @F.arrow_udf(HULL)
    def run(rings: pa.Array) -> pa.Array:
        return sliced(measure)(rings)

    return run(geom["rings"])


def polygon_gap(a: Column, b: Column, tol: float) -> Column:
    """Distance of two polygons and the wall length they share (walls closer than ``tol``)."""

    def measure(rings_a: pa.Array, rings_b: pa.Array) -> pa.Array:
        seg_a, off_a = segments(rings_a)
        seg_b, off_b = segments(rings_b)
        row = np.arange(len(rings_a))
        dist, shared = polygon_gaps(seg_a, off_a, row, seg_b, off_b, row, tol)
        return _struct({"dist": dist, "shared": shared})

    @F.arrow_udf(GAP)
    def run(rings_a: pa.Array, rings_b: pa.Array) -> pa.Array:
        return sliced(measure)(rings_a, rings_b)

    return run(a["rings"], b["rings"])


def covered_spans(a: Column, b: Column, tol: float, contacts: bool = False) -> Column:
    """Intervals of the walls of ``a`` lying in or within ``tol`` of ``b``.

    Walls are numbered in segment order; a NULL geometry gives an empty list. With
    ``contacts`` single points of contact are listed too, as intervals of no length.
    """

    def measure(rings_a: pa.Array, rings_b: pa.Array) -> pa.Array:
        seg_a, off_a = segments(rings_a)
        seg_b, off_b = segments(rings_b)
        pair, wall, t0, t1 = covered_walls(seg_a, off_a, seg_b, off_b, tol, contacts)
        spans = pa.StructArray.from_arrays(
            [pa.array(wall, pa.int32()), pa.array(t0), pa.array(t1)], ["wall", "t0", "t1"])
        offsets = starts(np.bincount(pair, minlength=len(rings_a))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), spans)

    @F.arrow_udf(SPANS)
    def run(rings_a: pa.Array, rings_b: pa.Array) -> pa.Array:
        return sliced(measure)(rings_a, rings_b)

    return run(a["rings"], b["rings"])


def lit_floor_area(geom: Column, spans: Column, depth: float) -> Column:
    """Footprint area within ``depth`` of the walls left free by the covered ``spans``."""

    def measure(rings: pa.Array, spans: pa.Array) -> pa.Array:
        seg, offs = segments(rings)
        span = spans.flatten()
        wall, t0, t1 = (span.field(n).to_numpy(zero_copy_only=False) for n in ("wall", "t0", "t1"))
        wall = wall + np.repeat(offs[:-1], list_sizes(spans))
        return pa.array(lit_areas(seg, offs, wall, t0, t1, depth), pa.float64())

    @F.arrow_udf("double")
    def run(rings: pa.Array, spans: pa.Array) -> pa.Array:
        return sliced(measure)(rings, spans)

    return run(geom["rings"], spans)


def overlap_area(a: Column, b: Column, grow: float = 0.0, tol: float = 1e-6) -> Column:
    """Area shared by two polygons; NULL where either is NULL.

    With ``grow`` both are grown by it along their common border, so polygons that only touch
    share a strip of twice that width.
    """

    def measure(rings_a: pa.Array, rings_b: pa.Array) -> pa.Array:
        seg_a, off_a = segments(rings_a)
        seg_b, off_b = segments(rings_b)
        area = common_areas(seg_a, off_a, seg_b, off_b)
        if grow:
            area = area + 2 * grow * common_borders(seg_a, off_a, seg_b, off_b, tol)
        unknown = pc.or_(rings_a.is_null(), rings_b.is_null()).to_numpy(zero_copy_only=False)
        return pa.array(area, pa.float64(), mask=unknown)

    @F.arrow_udf("double")
    def run(rings_a: pa.Array, rings_b: pa.Array) -> pa.Array:
        return sliced(measure)(rings_a, rings_b)

    return run(a["rings"], b["rings"])
