"""Geometry as nested columns, and its measures as column expressions.

A geometry is ``struct<srid, rings array<struct<part, hole, pts array<struct<x, y>>>>>``.
Polygon rings are closed; shells run clockwise and holes counter-clockwise once
normalised, so the interior always lies to the right of a wall. A line is one open ring
per part.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
RING = T.StructType([
    T.StructField("part", T.IntegerType()),
    T.StructField("hole", T.BooleanType()),
    T.StructField("pts", T.ArrayType(POINT)),
])
GEOMETRY = T.StructType([
    T.StructField("srid", T.IntegerType()),
    T.StructField("rings", T.ArrayType(RING)),
])


# --- constructors -----------------------------------------------------------------

def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def ring(pts: Column, hole: bool = False, part: int = 0) -> Column:
    return F.struct(F.lit(part).alias("part"), F.lit(hole).alias("hole"), pts.alias("pts"))


def geometry(*rings: Column, srid: int = 2154) -> Column:
    return F.struct(F.lit(srid).alias("srid"), F.array(*rings).alias("rings"))


def rectangle_ring(x0: Column, y0: Column, x1: Column, y1: Column, part: int = 0) -> Column:
    return ring(F.array(point(x0, y0), point(x0, y1), point(x1, y1), point(x1, y0),
                        point(x0, y0)), part=part)


def rectangle(x0: Column, y0: Column, x1: Column, y1: Column, srid: int = 2154) -> Column:
    return geometry(rectangle_ring(x0, y0, x1, y1), srid=srid)


def line(x1: Column, y1: Column, x2: Column, y2: Column, srid: int = 2154) -> Column:
    return geometry(ring(F.array(point(x1, y1), point(x2, y2))), srid=srid)


# --- folds over points ------------------------------------------------------------

def _origin(pts: Column) -> Column:
    return F.try_element_at(pts, F.lit(1))


def _fold(pts: Column, origin: Column, terms: dict) -> Column:
    """Sum the named terms over consecutive points, in coordinates relative to ``origin``.

    National coordinates are large; products of differences keep the digits.
    """
    def state(x, y, sums):
        return F.struct(x.alias("x"), y.alias("y"), *[v.alias(k) for k, v in sums.items()])

    def step(acc, p):
        x, y = p["x"] - origin["x"], p["y"] - origin["y"]
        return state(x, y, {k: acc[k] + term(acc["x"], acc["y"], x, y)
                            for k, term in terms.items()})

    first = _origin(pts)
    start = state(first["x"] - origin["x"], first["y"] - origin["y"],
                  {k: F.lit(0.0) for k in terms})
    return F.aggregate(pts, start, step)


def _cross(ax, ay, bx, by):
    return ax * by - bx * ay


def _length(ax, ay, bx, by):
    return F.sqrt((bx - ax) * (bx - ax) + (by - ay) * (by - ay))


def _ring_sum(geom: Column, value) -> Column:
    return F.aggregate(geom["rings"], F.lit(0.0), lambda acc, r: acc + value(r))


def signed_ring_area(pts: Column) -> Column:
    """Positive for counter-clockwise rings."""
    return _fold(pts, _origin(pts), {"s": _cross})["s"] / 2


def _sign(r: Column) -> Column:
    return F.when(r["hole"], F.lit(-1.0)).otherwise(F.lit(1.0))


# --- measures ---------------------------------------------------------------------

def area(geom: Column) -> Column:
    return _ring_sum(geom, lambda r: _sign(r) * F.abs(signed_ring_area(r["pts"])))


def ring_length(pts: Column) -> Column:
    return _fold(pts, _origin(pts), {"s": _length})["s"]


def perimeter(geom: Column) -> Column:
    """Length of the exterior rings."""
    return _ring_sum(geom, lambda r: F.when(r["hole"], F.lit(0.0))
                     .otherwise(ring_length(r["pts"])))


def length(geom: Column) -> Column:
    """Length of all rings or lines."""
    return _ring_sum(geom, lambda r: ring_length(r["pts"]))


def centroid(geom: Column) -> Column:
    """Area-weighted centre, summed over rings relative to the first vertex."""
    origin = _origin(F.try_element_at(geom["rings"], F.lit(1))["pts"])
    terms = {
        "a": _cross,
        "mx": lambda ax, ay, bx, by: (ax + bx) * _cross(ax, ay, bx, by),
        "my": lambda ax, ay, bx, by: (ay + by) * _cross(ax, ay, bx, by),
    }

    def add(acc, r):
        moments = _fold(r["pts"], origin, terms)
        turn = _sign(r) * F.signum(moments["a"])
        return F.struct(*[(acc[k] + turn * moments[k]).alias(k) for k in terms])

    zero = F.struct(*[F.lit(0.0).alias(k) for k in terms])
    total = F.aggregate(geom["rings"], zero, add)
    return F.struct(
        (origin["x"] + F.try_divide(total["mx"], 3 * total["a"])).alias("x"),
        (origin["y"] + F.try_divide(total["my"], 3 * total["a"])).alias("y"))


def point_distance(a: Column, b: Column) -> Column:
    return F.hypot(a["x"] - b["x"], a["y"] - b["y"])


def num_points(geom: Column) -> Column:
    return F.aggregate(geom["rings"], F.lit(0), lambda acc, r: acc + F.size(r["pts"]))


def num_interior_rings(geom: Column) -> Column:
    return F.size(F.filter(geom["rings"], lambda r: r["hole"]))


def num_geometries(geom: Column) -> Column:
    return F.coalesce(F.array_max(F.transform(geom["rings"], lambda r: r["part"])), F.lit(-1)) + 1


def is_empty(geom: Column) -> Column:
    return F.size(geom["rings"]) == 0


def azimuth(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Direction from a to b in radians, clockwise from north."""
    return F.pmod(F.atan2(bx - ax, by - ay), 2 * F.pi())


def start_point(geom: Column) -> Column:
    return _origin(F.try_element_at(geom["rings"], F.lit(1))["pts"])


def end_point(geom: Column) -> Column:
    return F.try_element_at(F.try_element_at(geom["rings"], F.lit(-1))["pts"], F.lit(-1))


# --- derived geometries -----------------------------------------------------------

def set_srid(geom: Column, srid: int) -> Column:
    return F.struct(F.lit(srid).alias("srid"), geom["rings"].alias("rings"))


def _with_rings(geom: Column, rings: Column) -> Column:
    return F.struct(geom["srid"].alias("srid"), rings.alias("rings"))


def exterior_rings(geom: Column) -> Column:
    return _with_rings(geom, F.filter(geom["rings"], lambda r: ~r["hole"]))


def holes(geom: Column) -> Column:
    """Interior rings, turned into shells."""
    return _with_rings(geom, F.transform(
        F.filter(geom["rings"], lambda r: r["hole"]),
        lambda r: F.struct(r["part"].alias("part"), F.lit(False).alias("hole"),
                           F.reverse(r["pts"]).alias("pts"))))


def normalize(geom: Column) -> Column:
    """Clockwise shells, counter-clockwise holes, each starting at its least vertex."""
    def shape(r, pts, *more):
        return F.struct(r["part"].alias("part"), r["hole"].alias("hole"), pts.alias("pts"), *more)

    def orient(r):
        right_way = (signed_ring_area(r["pts"]) > 0) == r["hole"]
        return shape(r, F.when(right_way, r["pts"]).otherwise(F.reverse(r["pts"])))

    def locate(r):
        least = F.array_position(r["pts"], F.array_min(r["pts"])).cast("int")
        return shape(r, r["pts"], least.alias("at"))

    def rotate(r):
        pts, at = r["pts"], r["at"]
        return shape(r, F.when(at == 1, pts).otherwise(
            F.concat(F.slice(pts, at, F.size(pts) - at), F.slice(pts, F.lit(1), at))))

    # one transform per step: a lambda variable is evaluated once, an expression at each use
    rings = geom["rings"]
    for step in (orient, locate, rotate):
        rings = F.transform(rings, step)
    return _with_rings(geom, rings)


def segments(geom: Column) -> Column:
    """Array of ``struct<hole, x1, y1, x2, y2>`` in ring order."""
    def of_ring(r):
        pts = r["pts"]
        return F.zip_with(
            F.slice(pts, 1, F.greatest(F.size(pts) - 1, F.lit(0))), F.slice(pts, 2, F.greatest(F.size(pts) - 1, F.lit(0))),
            lambda a, b: F.struct(r["hole"].alias("hole"), a["x"].alias("x1"), a["y"].alias("y1"),
                                  b["x"].alias("x2"), b["y"].alias("y2")))

    return F.flatten(F.transform(geom["rings"], of_ring))


# --- bounding boxes ---------------------------------------------------------------

def bbox(geom: Column) -> Column:
    xs = F.flatten(F.transform(geom["rings"], lambda r: r["pts"]["x"]))
    ys = F.flatten(F.transform(geom["rings"], lambda r: r["pts"]["y"]))
    return F.struct(F.array_min(xs).alias("xmin"), F.array_min(ys).alias("ymin"),
                    F.array_max(xs).alias("xmax"), F.array_max(ys).alias("ymax"))


def segment_bbox(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.struct(F.least(x1, x2).alias("xmin"), F.least(y1, y2).alias("ymin"),
                    F.greatest(x1, x2).alias("xmax"), F.greatest(y1, y2).alias("ymax"))


def expand(box: Column, by) -> Column:
    return F.struct((box["xmin"] - by).alias("xmin"), (box["ymin"] - by).alias("ymin"),
                    (box["xmax"] + by).alias("xmax"), (box["ymax"] + by).alias("ymax"))


def boxes_meet(a: Column, b: Column) -> Column:
    return ((a["xmin"] <= b["xmax"]) & (b["xmin"] <= a["xmax"])
            & (a["ymin"] <= b["ymax"]) & (b["ymin"] <= a["ymax"]))
