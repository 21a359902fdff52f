"""Length of outer walls near roads, by interval arithmetic on segments.

On a wall, the part within r of a road segment is one interval (distance to a convex set is
convex). Intervals of one wall are merged in order, and their total counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from townform.functions import geometry as G
from townform.operators.grid import grid_join
from townform.params import Params


def road_segments(roads: DataFrame, p: Params = Params()) -> DataFrame:
    """Segments of the roads with their reach: full width plus margin.

    Long segments are cut, so that none covers many grid cells; the reach of a road is the
    union of the reaches of its pieces. A piece with its reach fits into four cells, so that most pieces
    are of one level of the grid and a wall is listed for that one alone.
    """
    seg = F.col("seg")
    size = F.hypot(seg["x2"] - seg["x1"], seg["y2"] - seg["y1"])
    most = F.greatest(4 * p.road_cell - 2 * F.col("radius"), F.lit(p.road_cell))
    pieces = F.greatest(F.ceil(size / most), F.lit(1).cast("long"))
    whole = (roads.where(F.col("largeur").isNotNull())
             .select("id_zone", (F.col("largeur") + p.road_margin).alias("radius"),
                     F.explode(G.segments(F.col("the_geom"))).alias("seg"))
             .select("id_zone", "radius", "seg.x1", "seg.y1",
                     (seg["x2"] - seg["x1"]).alias("dx"), (seg["y2"] - seg["y1"]).alias("dy"),
                     pieces.alias("pieces")))
    part = F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1))
    return (whole.withColumn("part", part)
            .select("id_zone", "radius",
                    (F.col("x1") + F.col("dx") * F.col("part") / F.col("pieces")).alias("qx"),
                    (F.col("y1") + F.col("dy") * F.col("part") / F.col("pieces")).alias("qy"),
                    (F.col("dx") / F.col("pieces")).alias("ex"), (F.col("dy") / F.col("pieces")).alias("ey"))
            .withColumn("road_box", G.expand(
                G.segment_bbox(F.col("qx"), F.col("qy"), F.col("qx") + F.col("ex"), F.col("qy") + F.col("ey")),
                F.col("radius"))))


def outer_walls(buildings: DataFrame) -> DataFrame:
    """Walls of the exterior rings, numbered within the building."""
    seg = F.col("seg")
    return (buildings.select("id_zone", "pk",
                             F.posexplode(G.segments(G.exterior_rings(F.col("the_geom")))).alias("wall", "seg"))
            .select("id_zone", "pk", "wall", seg["x1"].alias("ax"), seg["y1"].alias("ay"),
                    (seg["x2"] - seg["x1"]).alias("dx"), (seg["y2"] - seg["y1"]).alias("dy"),
                    G.segment_bbox(seg["x1"], seg["y1"], seg["x2"], seg["y2"]).alias("wall_box")))


def _stage(df: DataFrame, *keep: str, **values: Column) -> DataFrame:
    """Add columns behind a generator: stacked projections would be merged into one
    expression too large to compile."""
    row = F.struct(*[v.alias(n) for n, v in values.items()])
    return df.select(*keep, F.inline(F.array(row)))


def _within(lo: Column, hi: Column, valid: Column) -> tuple[Column, Column]:
    return F.when(valid, lo), F.when(valid, hi)


def _disc(ux: str, uy: str) -> dict:
    """Roots of |U + tD| = r: where the wall enters and leaves a disc."""
    b = F.col(ux) * F.col("dx") + F.col(uy) * F.col("dy")
    c = F.col(ux) * F.col(ux) + F.col(uy) * F.col(uy) - F.col("radius") * F.col("radius")
    return {"b": b, "disc": b * b - F.col("dd") * c}


def near_intervals(pairs: DataFrame) -> DataFrame:
    """The interval of each wall near each road segment, clipped to the wall."""
    wall = ("id_zone", "pk", "wall")
    dx, dy, ex, ey = (F.col(c) for c in ("dx", "dy", "ex", "ey"))
    s1 = _stage(
        pairs.select(*wall, "dx", "dy", "ex", "ey", "radius",
                     (F.col("ax") - F.col("qx")).alias("ux"), (F.col("ay") - F.col("qy")).alias("uy")),
        *wall, "dx", "dy", "ex", "ey", "radius", "ux", "uy",
        dd=dx * dx + dy * dy, ee=ex * ex + ey * ey,
        vx=F.col("ux") - ex, vy=F.col("uy") - ey)
    q, r = _disc("ux", "uy"), _disc("vx", "vy")
    side0 = ex * F.col("uy") - ey * F.col("ux")
    slope = ex * dy - ey * dx
    along0 = ex * F.col("ux") + ey * F.col("uy")
    along = ex * dx + ey * dy
    s2 = _stage(s1.where("dd > 0"), *wall, "dd", "ee", "radius",
                qb=q["b"], qd=q["disc"], rb=r["b"], rd=r["disc"],
                side0=side0, slope=slope, along0=along0, along=along,
                reach=F.col("radius") * F.sqrt("ee"))
    dd, ee = F.col("dd"), F.col("ee")

    def roots(b, d):
        return _within((-F.col(b) - F.sqrt(d)) / dd, (-F.col(b) + F.sqrt(d)) / dd, F.col(d) >= 0)

    def slab(base, rate, low, high):
        """t with low <= base + t * rate <= high; a zero rate is all or nothing."""
        t1, t2 = F.try_divide(low - base, rate), F.try_divide(high - base, rate)
        inside = (base >= low) & (base <= high)
        lo = F.when(rate == 0, F.when(inside, F.lit(float("-inf")))).otherwise(F.least(t1, t2))
        hi = F.when(rate == 0, F.when(inside, F.lit(float("inf")))).otherwise(F.greatest(t1, t2))
        return lo, hi

    q_lo, q_hi = roots("qb", "qd")
    r_lo, r_hi = roots("rb", "rd")
    side_lo, side_hi = slab(F.col("side0"), F.col("slope"), -F.col("reach"), F.col("reach"))
    run_lo, run_hi = slab(F.col("along0"), F.col("along"), F.lit(0.0), ee)
    s3 = _stage(s2, *wall, q_lo=q_lo, q_hi=q_hi, r_lo=r_lo, r_hi=r_hi,
                side_lo=side_lo, side_hi=side_hi, run_lo=run_lo, run_hi=run_hi, flat=ee == 0)
    strip_lo, strip_hi = F.greatest("side_lo", "run_lo"), F.least("side_hi", "run_hi")
    strip = (~F.col("flat") & F.col("side_lo").isNotNull() & F.col("run_lo").isNotNull()
             & (strip_lo <= strip_hi))
    s4 = _stage(s3, *wall, "q_lo", "q_hi", "r_lo", "r_hi",
                s_lo=F.when(strip, strip_lo), s_hi=F.when(strip, strip_hi))
    # the three parts of a capsule meet, so their hull is their union; all may be missing
    hull = s4.select(*wall, F.least("q_lo", "r_lo", "s_lo").alias("lo"),
                     F.greatest("q_hi", "r_hi", "s_hi").alias("hi")).where("lo < 1 and hi > 0")
    return hull.select(*wall, F.greatest("lo", F.lit(0.0)).alias("t0"),
                       F.least("hi", F.lit(1.0)).alias("t1")).where("t0 < t1")


def near_roads(buildings: DataFrame, roads: DataFrame, p: Params = Params()) -> DataFrame:
    """Wall-road pairs close enough to be tested."""
    return grid_join(outer_walls(buildings), road_segments(roads, p), "wall_box", "road_box",
                     p.road_cell)


def walls_near_roads(buildings: DataFrame, roads: DataFrame, p: Params = Params()) -> DataFrame:
    """l_3m of every building that has outer walls near a road."""
    pairs = near_roads(buildings, roads, p)
    spans = near_intervals(pairs.withColumn("wall", F.struct(
        F.col("wall").alias("no"), F.sqrt(F.col("dx") * F.col("dx") + F.col("dy") * F.col("dy")).alias("size"))))
    # one shuffle by building serves both the merge and the sum
    spans = spans.repartition("id_zone", "pk")
    order = (Window.partitionBy("id_zone", "pk", "wall.no").orderBy("t0", "t1")
             .rowsBetween(Window.unboundedPreceding, -1))
    reached = F.coalesce(F.max("t1").over(order), F.lit(0.0))
    added = F.greatest(F.col("t1") - F.greatest(F.col("t0"), reached), F.lit(0.0))
    return (spans.withColumn("gain", added * F.col("wall.size"))
            .groupBy("id_zone", "pk").agg(F.round(F.sum("gain"), 3).alias("l_3m")))
