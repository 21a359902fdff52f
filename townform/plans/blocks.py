"""Blocks: buildings of a unit that touch once grown by the block buffer, and their table."""

from __future__ import annotations

import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from townform.functions import geometry as G
from townform.functions.kernels import convex_hulls, list_sizes, sliced, starts
from townform.functions.scalar import TWO_THIRDS, or_zero, ratio
from townform.functions.shapes import HULL, hulls_of
from townform.operators.components import components
from townform.operators.courtyards import courtyards
from townform.params import Params
from townform.schemas import BLOCK_COLUMNS

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK = ["id_zone", "pk_usr", "pk_block"]
KEY = ["id_zone", "pk_block"]  # unique, and never NULL where buildings have no unit
POINTS = "array<struct<x: double, y: double>>"
HULL_SHARE = 1024  # buildings whose vertices are gathered at once
HULLS = 64  # of these shares, worked on at once, more where they have few vertices
VERTICES = 1 << 14


def block_edges(pairs: DataFrame, p: Params = Params()) -> DataFrame:
    """Pairs that belong to one block: close enough and of one unit."""
    return (pairs.where(F.col("pk_usr_a").eqNullSafe(F.col("pk_usr_b")) & (F.col("dist") <= 2 * p.block_buffer))
            .select("id_zone", F.col("pk_usr_a").alias("pk_usr"), "pk_a", "pk_b"))


def block_members(buildings: DataFrame, pairs: DataFrame, p: Params = Params()) -> DataFrame:
    """Block of every building. A block is named by its lowest building key, which is unique
    in the commune and needs no global numbering."""
    edges = block_edges(pairs, p).withColumn("pk_usr", F.coalesce("pk_usr", F.lit(-1)))
    found = components(edges, ["id_zone", "pk_usr"], "pk_a", "pk_b")
    return (buildings.select("id_zone", "pk", "pk_usr")
            .join(found.select("id_zone", F.col("node").alias("pk"), "root"), ["id_zone", "pk"], "left")
            .select("id_zone", "pk", "pk_usr", F.coalesce("root", "pk").alias("pk_block")))


def blocks(members: DataFrame) -> DataFrame:
    return members.groupBy(*BLOCK).agg(F.count("*").alias("members"))


# --- aggregates over member buildings ----------------------------------------------

def area_and_volume(indicators: DataFrame) -> DataFrame:
    return indicators.groupBy(*BLOCK).agg(*_sums())


def heights(indicators: DataFrame) -> DataFrame:
    return indicators.groupBy(*BLOCK).agg(*_heights())


def compacity(indicators: DataFrame) -> DataFrame:
    return (indicators.where(F.col("vol") != 0).groupBy(*BLOCK).agg(_compacity()))


def _sums() -> list[Column]:
    return [F.sum(c).alias(c) for c in ("area", "floor_area", "vol")]


def _heights() -> list[Column]:
    return [ratio(F.sum(F.col("area") * F.col("hauteur")), F.sum("area")).alias("h_mean"),
            F.stddev_pop("hauteur").alias("h_std")]


def _compacity() -> Column:
    solid = F.col("vol") != 0
    free = F.sum(F.when(solid, F.col("free_ext_area")))
    return ratio(free, F.pow(F.sum(F.when(solid, F.col("vol"))), F.lit(TWO_THIRDS))).alias("compacity")


# --- main direction ------------------------------------------------------------------

def point_arrays(points: pa.Array):
    flat = points.flatten()
    x, y = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("x", "y"))
    return x, y, starts(list_sizes(points))


def hull_points(points: Column) -> Column:
    def reduce(points: pa.Array) -> pa.Array:
        x, y, offs = point_arrays(points)
        at, hull = convex_hulls(x, y, offs)
        kept = pa.StructArray.from_arrays([pa.array(x[at]), pa.array(y[at])], ["x", "y"])
        return pa.ListArray.from_arrays(pa.array(hull.astype("int32")), kept)

    @F.arrow_udf(POINTS)
    def run(points: pa.Array) -> pa.Array:
        return sliced(reduce, HULLS, VERTICES)(points)

    return run(points)


def hull_of_points(points: Column) -> Column:
    def measure(points: pa.Array) -> pa.Array:
        return hulls_of(*point_arrays(points))

    @F.arrow_udf(HULL)
    def run(points: pa.Array) -> pa.Array:
        return sliced(measure, HULLS, VERTICES)(points)

    return run(points)


def block_main_dir(buildings: DataFrame, members: DataFrame, p: Params = Params()) -> DataFrame:
    """Main direction of a block, from the hull of its members' vertices.

    Growing by a disc does not turn the narrowest rectangle, only widens it. Hulls are taken
    in two rounds, of bounded shares of a block and then of what is left, so a block of any
    size is never gathered whole.
    """
    sized = members.join(blocks(members).drop("pk_usr"), KEY)
    share = F.pmod(F.xxhash64("pk"), F.ceil(F.col("members") / HULL_SHARE))
    corners = F.flatten(F.transform(G.exterior_rings(F.col("the_geom"))["rings"], lambda r: r["pts"]))
    pts = buildings.select("id_zone", "pk", corners.alias("pts"))

    def gather(df, *keys):
        return df.groupBy(*keys).agg(F.flatten(F.collect_list("pts")).alias("pts"))

    parts = gather(sized.join(pts, ["id_zone", "pk"]).withColumn("share", share), *BLOCK, "share")
    parts = parts.withColumn("pts", hull_points(F.col("pts")))
    hulls = gather(parts, *BLOCK).withColumn("hull", hull_of_points(F.col("pts")))
    width = F.col("hull.width") + 2 * p.block_buffer
    degrees = F.pmod(F.col("hull.azimuth"), F.lit(180.0))
    if p.integer_degrees:
        degrees = F.pmod(F.floor(degrees).cast("double"), F.lit(180.0))
    return hulls.select(*BLOCK, F.when(width >= p.min_width, degrees).alias("main_dir_deg"))


# --- the block table -----------------------------------------------------------------

def block_indicators(indicators: DataFrame, buildings: DataFrame, members: DataFrame,
                     pairs: DataFrame, p: Params = Params()) -> DataFrame:
    """One row per block. Its outline is a table of its own, ``operators.outlines.block_outlines``."""
    sums = indicators.groupBy(*BLOCK).agg(*_sums(), *_heights(), _compacity())
    yards = courtyards(buildings, members, pairs, p)
    return (sums
            .join(yards.drop("pk_usr"), KEY, "left")
            .join(block_main_dir(buildings, members, p).drop("pk_usr"), KEY, "left")
            .withColumns({c: or_zero(F.col(c)) for c in ("holes_area", "holes_percent")})
            .select(*BLOCK_COLUMNS))
