"""Urban unit indicators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from townform.functions import geometry as G
from townform.functions.scalar import or_zero, ratio, weighted_mean
from townform.operators.overlap import max_overlap
from townform.params import Params
from townform.schemas import USR_COLUMNS

UNIT = ["id_zone", "pk_usr"]


def _rounded(digits: int, **columns) -> list:
    return [F.round(value, digits).alias(name) for name, value in columns.items()]


def _building_stats() -> list:
    area, count = F.col("area"), F.count("*")
    return _rounded(
        2,
        compac_mean_nw=F.avg("compacity_n"),
        compac_mean_w=weighted_mean(F.col("compacity_n"), area),
        contig_mean=weighted_mean(F.col("contiguity"), area),
        contig_std=F.stddev_pop("contiguity"),
        main_dir_std=F.stddev_pop("main_dir_deg"),
        h_mean=weighted_mean(F.col("hauteur"), area),
        h_std=F.stddev_pop("hauteur"),
        p_vol_ratio_mean=weighted_mean(F.col("p_vol_ratio"), area),
        b_area=F.sum("area"),
        b_vol=F.sum("vol"),
        b_vol_m=F.sum("vol") / count,
        min_m_dist=F.avg("min_dist"),
        mean_m_dist=F.avg("mean_dist"),
        mean_std_dist=F.stddev_pop("mean_dist"),
        ext_env_area=F.sum(F.col("b_wall_area") - F.col("p_wall_area")),
    ) + [count.cast("int").alias("build_numb")]


def usr_building_stats(indicators: DataFrame) -> DataFrame:
    """Sixteen statistics over the buildings of a unit."""
    return indicators.groupBy(*UNIT).agg(*_building_stats())


def usr_floor_density(usr: DataFrame, indicators: DataFrame) -> DataFrame:
    """Floor sum, floor ratio and built density. Sums come first, the unit's area joins later."""
    sums = indicators.groupBy(*UNIT).agg(F.sum("floor_area").alias("floors"),
                                         F.sum("area").alias("built"))
    return _densities_of_sums(usr.withColumnRenamed("pk", "pk_usr").join(sums, UNIT)).select(
        *UNIT, "floor", "floor_ratio", "build_dens")


def _densities_of_sums(rows: DataFrame) -> DataFrame:
    return rows.withColumns({
        "floor": F.round("floors", 2),
        "floor_ratio": F.round(ratio(F.col("floors"), F.col("usr_area")), 2),
        "build_dens": F.round(ratio(F.col("built"), F.col("usr_area")), 4)})


def _own_densities(usr: DataFrame) -> DataFrame:
    surfaces = {"hydro_dens": "hydro_surface", "veget_dens": "vegetation_surface",
                "road_dens": "route_surface"}
    return usr.withColumns({name: F.round(ratio(F.col(c), F.col("usr_area")), 4)
                            for name, c in surfaces.items()})


def usr_densities(usr: DataFrame, indicators: DataFrame) -> DataFrame:
    built = indicators.groupBy(*UNIT).agg(F.sum("floor_area").alias("floors"),
                                          F.sum("area").alias("built"))
    rows = usr.withColumnRenamed("pk", "pk_usr").join(built, UNIT, "left")
    return _own_densities(_densities_of_sums(rows)).select(
        *UNIT, "build_dens", "hydro_dens", "veget_dens", "road_dens")


def usr_block_stats(blocks: DataFrame) -> DataFrame:
    """Five statistics over the blocks of a unit. The plain mean counts blocks without value."""
    area = F.col("area")
    return blocks.groupBy(*UNIT).agg(*_rounded(
        2,
        b_holes_area_mean=weighted_mean(F.col("holes_area"), area),
        b_std_h_mean=weighted_mean(F.col("h_std"), area),
        b_m_nw_compacity=F.sum("compacity") / F.count("*"),
        b_m_w_compacity=weighted_mean(F.col("compacity"), area),
        b_std_compacity=F.stddev_pop("compacity")))


def usr_dist_to_center(usr: DataFrame, communes: DataFrame) -> DataFrame:
    """Distance from the centre of each unit to the centre of its commune, which goes by its code."""
    centers = communes.select("code_insee", G.centroid(F.col("the_geom")).alias("center"))
    return (usr.select("id_zone", "code_insee", F.col("pk").alias("pk_usr"),
                       G.centroid(F.col("the_geom")).alias("middle"))
            .join(centers, "code_insee")
            .select(*UNIT, G.point_distance(F.col("middle"), F.col("center")).alias("dist_to_center")))


def usr_iris(usr: DataFrame, iris: DataFrame, p: Params = Params()) -> DataFrame:
    """Census district with the greatest overlap."""
    return max_overlap(usr.withColumnRenamed("pk", "pk_usr"), "pk_usr", iris, "dcomiris",
                       size=p.unit_cell, grow=p.iris_grow)


def usr_indicators(usr: DataFrame, indicators: DataFrame, blocks: DataFrame, communes: DataFrame,
                   iris: DataFrame, p: Params = Params()) -> DataFrame:
    """The unit table. Buildings are aggregated once, for statistics and densities alike."""
    stats = indicators.groupBy(*UNIT).agg(
        *_building_stats(), F.sum("floor_area").alias("floors"), F.sum("area").alias("built"))
    rows = (usr.withColumnRenamed("pk", "pk_usr")
            .join(stats, UNIT, "left")
            .join(usr_block_stats(blocks), UNIT, "left")
            .join(usr_dist_to_center(usr, communes), UNIT, "left")
            .join(usr_iris(usr, iris, p), UNIT, "left"))
    rows = _own_densities(_densities_of_sums(rows)).withColumnRenamed("pk_usr", "pk")
    numbers = [c for c in USR_COLUMNS if c not in ("pk", "id_zone", "the_geom", "dcomiris")]
    return rows.select(*USR_COLUMNS).fillna(0, subset=numbers)
