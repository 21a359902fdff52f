"""Result tables: types, reference systems, publishing at once, and what a broken run leaves."""

import pytest
from pyspark.sql import functions as F
from shapes_in_town import box, polygon

from townform.functions.geometry import GEOMETRY
from townform.schemas import FINAL_TABLES, TYPES, final_schema
from townform.sources import results as S

BLOCK = "final_block_indicators"
COMMUNE = "final_communes"


def blocks(spark, zones, area=1.0):
    rows = spark.createDataFrame([(z,) for z in zones], "id_zone int")
    return rows.select(*[(F.col("id_zone") if c == "id_zone" else F.lit(area)).cast(
        "int" if c in TYPES else "double").alias(c) for c in FINAL_TABLES[BLOCK]])


def communes(spark, zones, srid=2154):
    return spark.createDataFrame([(str(z), "u", (srid, polygon(box(0, 0, 1, 1))[1]), z) for z in zones],
                                 f"code_insee string, unite_urbaine string, the_geom {GEOMETRY.simpleString()}, id_zone long")


def zones_of(spark, path, table):
    return sorted(r["id_zone"] for r in S.read_final(spark, path, table).collect())


def test_types_are_declared_and_read_back(spark, tmp_path):
    path = str(tmp_path)
    S.write_final(blocks(spark, [1, 2]), path, BLOCK)
    back = S.read_final(spark, path, BLOCK)
    assert back.schema.simpleString() == final_schema(BLOCK).simpleString() and back.schema["pk_block"].dataType.simpleString() == "bigint"
    assert back.schema["vol"].metadata["comment"] and zones_of(spark, path, BLOCK) == [1, 2]
    assert {t for t in FINAL_TABLES if final_schema(t).names != list(FINAL_TABLES[t])} == set()


@pytest.mark.parametrize("column, value", [("area", "large"), ("pk_block", 1.5), ("vol", True)])
def test_wrong_types_are_refused(spark, tmp_path, column, value):
    with pytest.raises(ValueError, match=column):
        S.write_final(blocks(spark, [1]).withColumn(column, F.lit(value)), str(tmp_path), BLOCK)
    assert S.read_final(spark, str(tmp_path), BLOCK).count() == 0


def test_reference_systems(spark, tmp_path):
    path = str(tmp_path)
    S.write_final(communes(spark, [1]).unionByName(communes(spark, [2], srid=0)), path, COMMUNE)
    assert {r.the_geom.srid for r in S.read_final(spark, path, COMMUNE).collect()} == {2154}
    with pytest.raises(Exception, match="reference system 27572"):
        S.write_final(communes(spark, [1]).unionByName(communes(spark, [3], srid=27572)), path, COMMUNE)
    assert zones_of(spark, path, COMMUNE) == [1, 2]


def test_a_run_that_ends_between_tables_changes_nothing(spark, tmp_path):
    path = str(tmp_path)
    S.write_tables({BLOCK: blocks(spark, [1, 2]), COMMUNE: communes(spark, [1, 2])}, path)
    broken = communes(spark, [1]).withColumn("unite_urbaine", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        S.write_tables({BLOCK: blocks(spark, [1], area=7.0), COMMUNE: broken}, path)
    assert S.read_final(spark, path, BLOCK).where("area <> 1").count() == 0
    assert zones_of(spark, path, BLOCK) == zones_of(spark, path, COMMUNE) == [1, 2]
    # its files go on request, published ones stay
    assert S.drop_unpublished(spark, path) == 1
    S.write_tables({BLOCK: blocks(spark, [1], area=7.0), COMMUNE: communes(spark, [1])}, path)
    assert S.read_final(spark, path, BLOCK).where("area = 7").count() == 1 and zones_of(spark, path, BLOCK) == [1, 2]
    assert S.drop_unpublished(spark, path) == 2 and zones_of(spark, path, COMMUNE) == [1, 2]
    with pytest.raises(ValueError, match="mode"):
        S.write_tables({BLOCK: blocks(spark, [1])}, path, "other")


def test_tables_of_a_run_can_be_empty(spark, tmp_path):
    path = str(tmp_path)
    S.write_tables({BLOCK: blocks(spark, [1]).where("id_zone > 5"), COMMUNE: communes(spark, [1])}, path)
    assert zones_of(spark, path, BLOCK) == [] and zones_of(spark, path, COMMUNE) == [1]
    S.write_tables({BLOCK: blocks(spark, [4])}, path, "append")
    S.write_tables({BLOCK: blocks(spark, [4, 5])}, path, "append")
    assert zones_of(spark, path, BLOCK) == [4, 4, 5] and zones_of(spark, path, COMMUNE) == [1]


def test_zones_share_files_and_are_replaced_one_by_one(spark, tmp_path):
    path, many = str(tmp_path), 4 * S.PARTS
    S.write_final(blocks(spark, range(many)), path, BLOCK)
    assert len(list((tmp_path / BLOCK).rglob("*.parquet"))) <= S.PARTS
    S.write_final(blocks(spark, [1, S.PARTS + 1, many], area=7.0), path, BLOCK)  # two of one folder, and a new zone
    assert zones_of(spark, path, BLOCK) == list(range(many + 1))
    assert sorted(r.id_zone for r in S.read_final(spark, path, BLOCK).where("area = 7").collect()) == [1, S.PARTS + 1, many]
    assert S.drop_unpublished(spark, path) == 0  # other zones of these folders count
    S.write_final(blocks(spark, range(1, many, S.PARTS), area=3.0), path, BLOCK)
    # the first run's folder 1 and the second's
    assert S.drop_unpublished(spark, path) == 2 and zones_of(spark, path, BLOCK) == list(range(many + 1))
