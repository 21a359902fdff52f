"""Typology of buildings by random forest, and its summary per urban unit."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import IndexToString, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from townform.functions.scalar import ratio
from townform.params import Params
from townform.schemas import TYPO_BUILDING_COLUMNS, TYPO_USR_COLUMNS, TYPOLOGIES
from townform.session import cut_lineage

# Predictor names a trained model expects, by source column.
BUILDING_FEATURES = {
    "hauteur_origin": "i_h_origin", "insee_individus": "i_inhab", "hauteur": "i_h",
    "nb_niv": "i_levels", "area": "i_area", "floor_area": "i_floor", "vol": "i_vol",
    "compacity_r": "i_comp_b", "compacity_n": "i_comp_n", "compactness": "i_comp",
    "form_factor": "i_form", "concavity": "i_conc", "main_dir_deg": "i_dir",
    "b_floor_long": "i_peri", "b_wall_area": "i_wall_a", "p_wall_long": "i_pwall_l",
    "p_wall_area": "i_pwall_a", "nb_neighbor": "i_nb_nei", "free_p_wall_long": "i_fwall_l",
    "free_ext_area": "i_free_ext_area", "contiguity": "i_contig", "p_vol_ratio": "i_passiv_vol",
    "fractal_dim": "i_fractal", "min_dist": "i_dist_min", "mean_dist": "i_dist_mean",
    "max_dist": "i_dist_max", "std_dist": "i_dist_std", "num_points": "i_nb_points",
    "l_tot": "i_l_tot", "l_cvx": "i_l_cvx", "l_3m": "i_l_3m",
}
BLOCK_FEATURES = {
    "area": "b_area", "floor_area": "b_floor", "vol": "b_vol", "h_mean": "b_h_mean",
    "h_std": "b_h_std", "compacity": "b_comp_n", "holes_percent": "b_holes_p",
    "main_dir_deg": "b_dir",
}
USR_FEATURES = {
    "vegetation_surface": "u_veg_a", "route_surface": "u_road_a", "route_longueur": "u_road_l",
    "trottoir_longueur": "u_sidewalk_l", "insee_individus": "u_inhab", "insee_menages": "u_house",
    "insee_men_coll": "u_col_house", "insee_men_surf": "u_house_a",
    "insee_surface_collectif": "u_col_house_a", "floor": "u_floor", "floor_ratio": "u_cos",
    "compac_mean_nw": "u_comp_nwmean", "compac_mean_w": "u_comp_wmean",
    "contig_mean": "u_contig_mean", "contig_std": "u_contig_std", "main_dir_std": "u_dir_std",
    "h_mean": "u_h_mean", "h_std": "u_h_std", "p_vol_ratio_mean": "u_passiv_vol_mean",
    "b_area": "u_area", "b_vol": "u_vol", "b_vol_m": "u_vol_mean", "build_numb": "u_nb_build",
    "min_m_dist": "u_dist_min_mean", "mean_m_dist": "u_dist_mean_mean",
    "mean_std_dist": "u_dist_mean_std", "b_std_h_mean": "u_bh_std_mean",
    "b_m_nw_compacity": "u_bcomp_nwmean", "b_m_w_compacity": "u_bcomp_wmean",
    "b_std_compacity": "u_bcomp_std", "dist_to_center": "u_dist_center",
    "build_dens": "u_build_dens", "veget_dens": "u_veg_dens", "road_dens": "u_road_dens",
    "ext_env_area": "u_fwall_a",
}
FEATURES = (*BUILDING_FEATURES.values(), *BLOCK_FEATURES.values(), *USR_FEATURES.values())


def _renamed(names: Mapping[str, str]) -> list:
    return [F.col(source).alias(name) for source, name in names.items()]


def typology_features(indicators: DataFrame, blocks: DataFrame, usr: DataFrame) -> DataFrame:
    """Predictors of each building: its own, its block's and its unit's indicators.

    Buildings without a matching unit and block drop out. The unit joins the blocks first:
    the large building table is then shuffled once.
    """
    u = usr.select("id_zone", F.col("pk").alias("pk_usr"), *_renamed(USR_FEATURES))
    b = blocks.select("id_zone", "pk_usr", "pk_block", *_renamed(BLOCK_FEATURES))
    i = indicators.select("id_zone", "pk_usr", "pk_block", F.col("pk").alias("pk_building"),
                          *_renamed(BUILDING_FEATURES))
    around = b.join(u, ["id_zone", "pk_usr"])
    return (i.join(around, ["id_zone", "pk_usr", "pk_block"])
            .select("pk_building", "pk_usr", "id_zone", *FEATURES))


def _complete(features: DataFrame) -> DataFrame:
    # one opaque test: seventy null checks would be propagated as constraints through the plan
    values = F.array(*[F.col(c).cast("double") for c in FEATURES])
    return features.where(~F.exists(values, lambda v: v.isNull()))


def train_typology(labelled: DataFrame, p: Params = Params(), trees: int = 100,
                   depth: int = 10) -> PipelineModel:
    """Fit a forest on features with a ``typo`` label."""
    pipeline = Pipeline(stages=[
        StringIndexer(inputCol="typo", outputCol="typo_index", stringOrderType="alphabetAsc"),
        VectorAssembler(inputCols=list(FEATURES), outputCol="predictors"),
        RandomForestClassifier(labelCol="typo_index", featuresCol="predictors", numTrees=trees,
                               maxDepth=depth, seed=p.forest_seed),
    ])
    # fitting passes over its rows several times
    model = pipeline.fit(cut_lineage(_complete(labelled).select("typo", *FEATURES)))
    names = IndexToString(inputCol="prediction", outputCol="typo", labels=model.stages[0].labels)
    return PipelineModel(stages=[*model.stages[1:], names])


def classify_buildings(model: PipelineModel, features: DataFrame) -> DataFrame:
    """Typology of every building; NULL where a predictor is missing."""
    values = [F.col(c).cast("double") for c in FEATURES]
    # one pass: gaps are filled for the forest only, and their rows get no typology
    rows = features.select(F.struct("*").alias("row"), F.exists(F.array(*values), lambda v: v.isNull()).alias("gap"),
                           *[F.coalesce(v, F.lit(0.0)).alias(c) for c, v in zip(FEATURES, values)])
    return model.transform(rows).select("row.*", F.when(~F.col("gap"), F.col("typo")).alias("typo"))


def typo_buildings(buildings: DataFrame, typed: DataFrame) -> DataFrame:
    """Typology of buildings with their outline."""
    rows = typed.select("id_zone", F.col("pk_building").alias("pk"), "typo")
    return (buildings.select("the_geom", "pk", "pk_usr", "id_zone").join(rows, ["id_zone", "pk"])
            .withColumnRenamed("pk", "pk_building").select(*TYPO_BUILDING_COLUMNS))


def floor_share(typed: DataFrame) -> DataFrame:
    """Share of its unit's floor area in each building, in percent."""
    share = F.when(F.col("u_floor") != 0, ratio(F.col("i_floor"), F.col("u_floor")) * 100).otherwise(0.0)
    return typed.withColumn("share", share)


def usr_typology(typed: DataFrame) -> DataFrame:
    """Percent of floor area by typology, with the first and second typology of each unit.

    Buildings without a typology are left out. The second is the last but one in a stable
    ascending order, so a tie at the top may name the same class twice; "na" where it is 0.
    A class with a building whose floor area is unknown counts 0.
    """
    rows = floor_share(typed.where(F.col("typo").isNotNull()))
    known = F.count("*") == F.count("share")
    cells = rows.groupBy("id_zone", "pk_usr", "typo").agg(F.when(known, F.sum("share")).alias("share"))
    shares = [F.coalesce(F.bround(F.max(F.when(F.col("typo") == t, F.col("share"))), 2),
                         F.lit(0.0)).alias(t) for t in TYPOLOGIES]
    table = cells.groupBy("id_zone", "pk_usr").agg(*shares)
    values = F.array(*TYPOLOGIES)
    names = F.array(*[F.lit(t) for t in TYPOLOGIES])
    ranked = F.array_sort(F.array(*[F.struct(F.col(t).alias("share"), F.lit(k + 1).alias("place"))
                                    for k, t in enumerate(TYPOLOGIES)]))
    second = F.element_at(ranked, len(TYPOLOGIES) - 1)
    return table.select(
        "id_zone", "pk_usr", *TYPOLOGIES,
        F.element_at(names, F.array_position(values, F.array_max(values)).cast("int")).alias("typo_maj"),
        F.when(second["share"] == 0, "na").otherwise(F.element_at(names, second["place"]))
        .alias("typo_second"))


def typo_usr(usr: DataFrame, typed: DataFrame) -> DataFrame:
    """Typology of units with their outline."""
    shape = usr.select("the_geom", F.col("pk").alias("pk_usr"), "id_zone")
    return shape.join(usr_typology(typed), ["id_zone", "pk_usr"]).select(*TYPO_USR_COLUMNS)


def with_labels(typed: DataFrame, labels: DataFrame) -> DataFrame:
    return typed.join(labels, "typo", "left")
