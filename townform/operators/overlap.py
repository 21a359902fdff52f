"""For every row of one table, the row of another that overlaps it most."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from townform.functions import geometry as G
from townform.functions.shapes import overlap_area
from townform.operators.grid import grid_join


def max_overlap(left: DataFrame, left_key: str, right: DataFrame, right_key: str,
                keys: Sequence[str] = ("id_zone",), size: float = 500.0,
                grow: float = 0.0) -> DataFrame:
    """``keys``, ``left_key`` and the best ``right_key``; NULL without any candidate.

    Candidates are rows whose boxes meet. Areas, of outlines in either direction and grown by ``grow`` along
    common borders, are only computed where there is a choice; a single candidate wins with any overlap.
    Ties go to the lowest key.
    """
    keys = list(keys)

    def side(df, key, name):
        return df.select(*keys, F.col(key).alias(f"key_{name}"),
                         G.bbox(F.col("the_geom")).alias(f"box_{name}"))

    candidates = (grid_join(side(left, left_key, "l"), side(right, right_key, "r"),
                            "box_l", "box_r", size, keys).select(*keys, "key_l", "key_r"))
    lone = F.count("*").over(Window.partitionBy(*keys, "key_l")) == 1
    candidates = candidates.withColumn("lone", lone)
    contested = (candidates.where(~F.col("lone"))
                 .join(left.select(*keys, F.col(left_key).alias("key_l"),
                                   G.normalize(F.col("the_geom")).alias("geom_l")), [*keys, "key_l"])
                 .join(right.select(*keys, F.col(right_key).alias("key_r"),
                                    G.normalize(F.col("the_geom")).alias("geom_r")), [*keys, "key_r"])
                 .withColumn("shared", overlap_area(F.col("geom_l"), F.col("geom_r"), grow))
                 # max_by of (area, key) needs the lowest key first: take the least (-area, key)
                 .groupBy(*keys, "key_l")
                 .agg(F.min(F.struct((-F.col("shared")).alias("rank"), "key_r"))["key_r"].alias("key_r")))
    best = candidates.where("lone").select(*keys, "key_l", "key_r").union(
        contested.select(*keys, "key_l", "key_r"))
    return (left.select(*keys, F.col(left_key).alias("key_l"))
            .join(best, [*keys, "key_l"], "left")
            .select(*keys, F.col("key_l").alias(left_key), F.col("key_r").alias(right_key)))
