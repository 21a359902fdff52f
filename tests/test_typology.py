import pytest
from pyspark.sql import functions as F
from shapes_in_town import by_pk

from testbed.city import city
from townform.plans import chain
from townform.plans import typology as Y
from townform.schemas import TYPOLOGIES
from townform.session import cut_lineage
from townform.sources import results as S


def typed(spark, rows):
    return spark.createDataFrame(rows, "id_zone int, pk_usr int, pk_building int, i_floor double, u_floor double, typo string")


def test_shares_first_and_second(spark):
    rows = [(0, 1, 1, 50.0, 200.0, "pd"), (0, 1, 2, 120.0, 200.0, "ba"), (0, 1, 3, 30.0, 200.0, "pd")]
    got = Y.usr_typology(typed(spark, rows)).first()
    assert (got["ba"], got["pd"], got["id"]) == (60.0, 40.0, 0.0)
    assert (got["typo_maj"], got["typo_second"]) == ("ba", "pd")


def test_tie_at_the_top_names_first_class_twice(spark):
    rows = [(0, 1, 1, 100.0, 200.0, "icif"), (0, 1, 2, 100.0, 200.0, "psc")]
    got = Y.usr_typology(typed(spark, rows)).first()
    assert (got["typo_maj"], got["typo_second"]) == ("icif", "icif")


def test_single_class_has_no_second_and_empty_floor_counts_zero(spark):
    rows = [(0, 1, 1, 10.0, 10.0, "id"), (0, 2, 2, 5.0, 0.0, "local")]
    got = by_pk(Y.usr_typology(typed(spark, rows)), "typo_maj", "typo_second", "local", key="pk_usr")
    assert got == {1: ("id", "na", 0.0), 2: ("ba", "na", 0.0)}


def test_buildings_without_typology_are_left_out(spark):
    rows = [(0, 1, 1, 50.0, 100.0, "pd"), (0, 1, 2, 50.0, 100.0, None), (0, 2, 3, 1.0, 1.0, None)]
    got = by_pk(Y.usr_typology(typed(spark, rows)), "pd", key="pk_usr")
    assert got == {1: 50.0}


def test_rounds_half_to_even(spark):
    rows = [(0, 1, 1, 0.125, 100.0, "pd"), (0, 1, 2, 0.375, 100.0, "ba")]
    got = Y.usr_typology(typed(spark, rows)).first()
    assert (got["pd"], got["ba"]) == (0.12, 0.38)


def test_forest_learns_and_leaves_unknown_rows_open(spark):
    base = cut_lineage(spark.range(400).select(
        F.lit(0).alias("id_zone"), (F.col("id") % 7).cast("int").alias("pk_usr"), F.col("id").cast("int").alias("pk_building"),
        *[((F.col("id") * (k + 3)) % 11).cast("double").alias(c) for k, c in enumerate(Y.FEATURES)]))
    rows = base.withColumn("typo", F.when(F.col("i_area") > 5, "ba").otherwise("pd"))
    model = Y.train_typology(rows, trees=20, depth=5)
    holes = base.withColumn("i_h", F.when(F.col("pk_building") == 3, F.lit(None)).otherwise(F.col("i_h")))
    got = Y.classify_buildings(model, holes)
    assert got.count() == 400
    right = got.join(rows.select("pk_building", F.col("typo").alias("truth")), "pk_building").where("typo = truth").count()
    assert right > 390
    assert [r["pk_building"] for r in got.where("typo is null").collect()] == [3]


def test_model_round_trip(spark, tmp_path):
    from pyspark.ml import PipelineModel
    rows = cut_lineage(spark.range(60).select(
        F.lit(0).alias("id_zone"), F.lit(1).alias("pk_usr"), F.col("id").cast("int").alias("pk_building"),
        *[(F.col("id") % (k + 2)).cast("double").alias(c) for k, c in enumerate(Y.FEATURES)],
        F.when(F.col("id") % 2 == 0, "id").otherwise("psc").alias("typo")))
    model = Y.train_typology(rows, trees=5, depth=3)
    model.write().overwrite().save(str(tmp_path / "forest"))
    again = PipelineModel.load(str(tmp_path / "forest"))
    a, b = (by_pk(Y.classify_buildings(m, rows.drop("typo")), "typo", key="pk_building") for m in (model, again))
    assert a == b


def test_chain_with_a_model_writes_typologies(spark, tmp_path):
    inputs = city(spark, "/root/testdata/sf0.001")
    r = chain.compute(inputs)
    features = cut_lineage(Y.typology_features(r.building_indicators, r.block_indicators, r.usr_indicators))
    middle = features.agg(F.expr("percentile(i_area, 0.5)")).first()[0]
    labelled = features.withColumn("typo", F.when(F.col("i_area") > middle, "ba").otherwise("pd"))
    model = Y.train_typology(labelled, trees=1, depth=3)
    rows = Y.classify_buildings(model, features).collect()
    assert {x["typo"] for x in rows} == {"ba", "pd"}
    chain.run_chain(inputs, str(tmp_path), model)
    written = by_pk(S.read_final(spark, str(tmp_path), "final_building_typo"), "typo", key="pk_building")
    assert written == {x["pk_building"]: x["typo"] for x in rows}
    shares: dict[int, dict[str, float]] = {}
    for x in rows:
        unit = shares.setdefault(x["pk_usr"], dict.fromkeys(TYPOLOGIES, 0.0))
        unit[x["typo"]] += x["i_floor"] / x["u_floor"] * 100
    units = {x["pk_usr"]: x for x in S.read_final(spark, str(tmp_path), "final_usr_typo").collect()}
    assert set(units) == set(shares)
    for pk, unit in shares.items():
        assert [units[pk][t] for t in TYPOLOGIES] == pytest.approx([unit[t] for t in TYPOLOGIES], abs=0.0051)
        assert units[pk]["typo_maj"] == max(TYPOLOGIES, key=lambda t: unit[t])


def test_feature_names_are_complete():
    assert len(Y.FEATURES) == len(set(Y.FEATURES)) == 31 + 8 + 35
    assert len(TYPOLOGIES) == 10
