"""Distances from every building to all others of its urban unit.

The statistics need every pair, but pairs never become rows. A unit is cut into tiles of
bounded size; each pair of tiles is one row of outlines, from which an Arrow kernel returns,
per building, count, sum, sum of squares, least and greatest distance. A unit of any size
becomes many small rows, spread over tasks by their tile numbers.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from townform.functions.kernels import list_sizes, polygon_gaps, segments, sliced, spread, starts
from townform.functions.scalar import or_zero
from townform.params import Params

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PARTIAL = ("array<struct<pk: bigint, n: bigint, total: double, squares: double, least: double, "
           "greatest: double>>")
PAIRS = 1 << 16  # building pairs held in memory at once
UNITS = 64  # pairs of tiles worked on at once, more where they have few buildings
MEMBERS = 1 << 12


def _tiles(buildings: DataFrame, p: Params) -> DataFrame:
    """Each building once per pair of tiles it takes part in."""
    unit = ["id_zone", "pk_usr"]
    sizes = buildings.groupBy(*unit).agg(F.count("*").alias("members"))
    tiles = F.ceil(F.col("members") / p.tile)
    placed = (buildings.select(*unit, "pk", F.col("the_geom.rings").alias("rings"))
              .join(sizes, unit)
              .withColumn("tiles", tiles)
              .withColumn("tile", F.pmod(F.xxhash64("pk"), F.col("tiles"))))
    return (placed
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
            .select(*unit, "pk", "rings", "tile",
                    F.least("tile", "other").alias("lo"), F.greatest("tile", "other").alias("hi")))


def tile_pairs(size, tile):
    """Pairs of members to be measured: across both tiles, or each once within a single one.

    ``size`` counts the members of each tile pair, ``tile`` is 0 for the lower and 1 for the
    upper tile, -1 where both are the same.
    """
    base = starts(size)
    group, rank = spread(size)
    members, other = spread(size[group])
    i, j = members, base[group[members]] + other
    keep = np.where(tile[i] < 0, i < j, tile[i] < tile[j])
    return i[keep], j[keep]


def pair_statistics(seg, offs, size, tile):
    """Partial statistics of every member, over the pairs of its row; squares are of deviations from their mean."""
    n = len(tile)
    count, total, squares = np.zeros(n, dtype=np.int64), np.zeros(n), np.zeros(n)
    least, greatest = np.full(n, np.inf), np.full(n, -np.inf)
    load = np.cumsum(size * size) // PAIRS
    for rows in np.split(np.arange(len(size)), np.flatnonzero(np.diff(load)) + 1):
        if not len(rows):
            continue
        first = int(size[:rows[0]].sum())
        i, j = tile_pairs(size[rows], tile[first:first + int(size[rows].sum())])
        i, j = i + first, j + first
        dist, _ = polygon_gaps(seg, offs, i, seg, offs, j)
        for ends in (i, j):
            count += np.bincount(ends, minlength=n)
            total += np.bincount(ends, dist, n)
            np.minimum.at(least, ends, dist)
            np.maximum.at(greatest, ends, dist)
        # all pairs of these members are in this piece: deviations from their means are final
        mean = total / np.maximum(count, 1)
        for ends in (i, j):
            squares += np.bincount(ends, (dist - mean[ends]) ** 2, n)
    return count, total, squares, least, greatest


def _partials(members: Column) -> Column:
    def measure(members: pa.Array) -> pa.Array:
        size = list_sizes(members)
        member = members.flatten()
        seg, offs = segments(member.field("rings"))
        tile = member.field("tile").to_numpy(zero_copy_only=False)
        values = pair_statistics(seg, offs, size, tile)
        rows = pa.StructArray.from_arrays(
            [member.field("pk").cast(pa.int64()), *[pa.array(v) for v in values]],
            ["pk", "n", "total", "squares", "least", "greatest"])
        return pa.ListArray.from_arrays(pa.array(starts(size).astype(np.int32)), rows)

    @F.arrow_udf(PARTIAL)
    def run(members: pa.Array) -> pa.Array:
        return sliced(measure, UNITS, MEMBERS)(members)

    return run(members)


def building_distances(buildings: DataFrame, p: Params = Params()) -> DataFrame:
    """min_dist, mean_dist, max_dist, std_dist of buildings that share their unit."""
    side = F.when(F.col("lo") == F.col("hi"), F.lit(-1)).when(F.col("tile") == F.col("lo"), F.lit(0)).otherwise(F.lit(1))
    rows = (_tiles(buildings, p).groupBy("id_zone", "pk_usr", "lo", "hi")
            .agg(F.collect_list(F.struct("pk", side.alias("tile"), "rings")).alias("members")))
    partial = (rows.select("id_zone", _partials(F.col("members")).alias("parts"))
               .select("id_zone", F.inline("parts")).where("n > 0"))
    # squares of deviations are merged around the mean of all, never as a difference of large sums;
    # the window leaves rows dealt as the grouping needs them
    own = Window.partitionBy("id_zone", "pk")
    away = F.col("total") / F.col("n") - F.sum("total").over(own) / F.sum("n").over(own)
    partial = partial.withColumn("squares", F.col("squares") + F.col("n") * away * away)
    n, total = F.sum("n"), F.sum("total")
    spread = F.sum("squares") / n
    return partial.groupBy("id_zone", "pk").agg(
        F.min("least").alias("min_dist"), (total / n).alias("mean_dist"),
        F.max("greatest").alias("max_dist"), F.sqrt(spread).alias("std_dist"))


def with_lone_buildings(buildings: DataFrame, distances: DataFrame) -> DataFrame:
    """Distances for all buildings: 0 for those alone in their unit."""
    names = ("min_dist", "mean_dist", "max_dist", "std_dist")
    return (buildings.select("id_zone", "pk", "pk_usr").join(distances, ["id_zone", "pk"], "left")
            .withColumns({c: or_zero(F.col(c)) for c in names}))
