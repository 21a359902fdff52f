import pytest
from pyspark.sql import functions as F
from shapes_in_town import box, by_pk, polygon

from townform.functions.geometry import GEOMETRY
from townform.operators.overlap import max_overlap
from townform.plans import chain
from townform.schemas import BLOCK_COLUMNS, BUILDING_COLUMNS, FINAL_TABLES, MEANING, USR_COLUMNS, column_dictionary
from townform.sources import inputs as I
from townform.sources import results as S
from testbed.city import city

SF = "/root/testdata/sf0.01"


def _bati(spark, rows):
    return spark.createDataFrame(
        [(idzone, polygon(box(0, 0, 4, 5)), 1.0, idilot, pk, niv, h, None, "t", None, None)
         for pk, (idzone, idilot, niv, h) in enumerate(rows)],
        f"idzone int, the_geom {GEOMETRY.simpleString()}, hauteur double, idilot int, pk int, nb_niv int, "
        "hauteur_corrigee double, insee_individus double, theme string, pai_bdtopo string, pai_nature string")


def _zones(spark):
    return spark.createDataFrame([(1, "10001", "A"), (2, "10002", "B")],
                                 "ogc_fid int, code_insee string, unite_urbaine string").withColumn(
        "the_geom", F.lit(None).cast(GEOMETRY))


def test_fixes_of_height_and_levels(spark):
    df = I.prepare_buildings(_bati(spark, [(1, 1, 0, None), (1, 1, None, 0.0), (1, 1, 3, 7.0)]), _zones(spark))
    assert by_pk(df, "hauteur", "nb_niv", "hauteur_origin") == {0: (3.0, 1, 1.0), 1: (3.0, None, 1.0), 2: (7.0, 3, 1.0)}


def test_unit_required_unless_told_otherwise(spark):
    bati, zones = _bati(spark, [(1, None, 1, 1.0), (1, 4, 1, 1.0), (9, 4, 1, 1.0)]), _zones(spark)
    assert set(by_pk(I.prepare_buildings(bati, zones), "area")) == {1}
    assert set(by_pk(I.prepare_buildings(bati, zones, require_usr=False), "area")) == {0, 1}


def test_codes_as_list_or_table(spark):
    bati, zones = _bati(spark, [(1, 1, 1, 1.0), (2, 1, 1, 1.0)]), _zones(spark)
    named = I.resolve_areas(I.scan_communes(zones), " UNITE_urbaine", ["B"])
    assert set(by_pk(I.prepare_buildings(bati, zones, [" 10002"]), "area")) == {1}
    assert set(by_pk(I.prepare_buildings(bati, zones, named), "area")) == {1}
    both = I.resolve_areas(I.scan_communes(zones), "code_insee", ["10001", "10002"], key="id_zone")
    assert sorted(r[0] for r in both.collect()) == [1, 2]


def test_filters_reach_the_scan(spark, tmp_path):
    city(spark, SF).usr.write.parquet(str(tmp_path / "usr"))
    stored = spark.read.parquet(str(tmp_path / "usr"))
    plan = I.prepare_usr(stored, ["10003"]).select("pk", "vegetation_surface")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(code_insee), EqualTo(code_insee,10003)]" in plan
    assert "ReadSchema: struct<pk:int,code_insee:string,vegetation_surface:double>" in plan


def test_no_nested_loops_and_no_cross_joins(spark):
    inputs = city(spark, SF)
    b = I.prepare_buildings(inputs.bati, inputs.zones)
    from townform.operators import neighbours as N, roads as R
    from townform.plans import usr as U
    for df in (N.close_pairs(b), R.walls_near_roads(b, I.prepare_roads(inputs.roads, inputs.zones)),
               U.usr_iris(I.prepare_usr(inputs.usr), I.prepare_iris(inputs.iris)),
               U.usr_dist_to_center(I.prepare_usr(inputs.usr), I.commune_outline(inputs.zones))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_lower_names(spark):
    assert I.lower_names(spark.createDataFrame([(1, 2)], "PK int, ID_ZONE int")).columns == ["pk", "id_zone"]


def _polygons(spark, key, rows):
    return spark.createDataFrame([(0, k, polygon(o)) for k, o in rows],
                                 f"id_zone int, {key} string, the_geom {GEOMETRY.simpleString()}")


def test_greatest_overlap_ties_and_touching_boxes(spark):
    left = _polygons(spark, "l", [("a", box(0, 0, 10, 10)), ("b", box(20, 0, 30, 10)), ("c", box(100, 0, 110, 10)),
                                  ("d", box(12, 0, 14, 10))])
    right = _polygons(spark, "r", [("y", box(5, 0, 25, 10)), ("x", box(-15, 0, 5, 10)), ("z", box(25, 0, 45, 10)),
                                   ("t", [(90, -20), (90, 20), (101, 20)])])
    got = by_pk(max_overlap(left, "l", right, "r"), "r", key="l")
    # a is split evenly by x and y, b by y and z: the lower key wins; the box of t meets c
    assert got == {"a": "x", "b": "y", "c": "t", "d": "y"}
    assert by_pk(max_overlap(left, "l", right.where("r = 'z'"), "r"), "r", key="l")["c"] is None


@pytest.fixture(scope="module")
def computed(spark):
    return chain.compute(city(spark, SF))


def test_final_tables_replace_append_recreate(spark, computed, tmp_path):
    path, table = str(tmp_path), "final_block_indicators"
    rows = computed.block_indicators
    n = rows.count()
    S.write_final(rows, path, table)
    S.write_final(rows.where("id_zone = 3"), path, table)
    assert S.read_final(spark, path, table).count() == n
    S.write_final(rows.where("id_zone = 3"), path, table, mode="append")
    three = rows.where("id_zone = 3").count()
    assert S.read_final(spark, path, table).count() == n + three
    S.write_final(rows.where("id_zone = 3"), path, table, mode="recreate")
    assert S.read_final(spark, path, table).count() == three
    with pytest.raises(ValueError):
        S.write_final(rows, path, table, mode="other")


def test_final_tables_keep_names_order_and_comments(spark, computed, tmp_path):
    df = S.as_final(computed.building_indicators, "final_building_indicators")
    assert tuple(df.columns) == FINAL_TABLES["final_building_indicators"]
    assert df.schema["l_3m"].metadata["comment"] == MEANING["final_building_indicators"]["l_3m"]
    S.write_final(computed.usr_indicators, str(tmp_path), "final_usr_indicators")
    assert tuple(S.read_final(spark, str(tmp_path), "final_usr_indicators").columns) == FINAL_TABLES["final_usr_indicators"]


def test_dictionary_covers_every_result_column(spark):
    for table, columns in (("final_building_indicators", BUILDING_COLUMNS), ("final_block_indicators", BLOCK_COLUMNS),
                           ("final_usr_indicators", USR_COLUMNS)):
        assert set(MEANING[table]) == set(FINAL_TABLES[table])
        assert len(FINAL_TABLES[table]) == len(columns)
    assert column_dictionary(spark).count() == sum(len(v) for v in MEANING.values())


def test_one_job_equals_single_commune_runs(spark, computed):
    one = chain.compute(city(spark, SF), ["10004"])
    for name in ("building_indicators", "block_indicators", "usr_indicators"):
        part = getattr(computed, name).where("id_zone = 4").drop("the_geom")
        alone = getattr(one, name).drop("the_geom")
        floats = [f.name for f in alone.schema.fields if f.dataType.typeName() == "double"]
        part, alone = (d.withColumns({c: F.round(c, 6) for c in floats}) for d in (part, alone))
        assert alone.count() == part.count() > 0
        assert alone.exceptAll(part).count() == 0


def test_indicator_ranges(computed):
    b = computed.building_indicators
    assert b.where("not (concavity > 0 and concavity <= 1 + 1e-9)").count() == 0
    assert b.where("min_dist > mean_dist + 1e-9 or mean_dist > max_dist + 1e-9").count() == 0
    assert b.where("p_vol_ratio < 0 or p_vol_ratio > 1 or main_dir_deg < 0 or main_dir_deg >= 180").count() == 0
    sums = computed.block_indicators.agg(F.sum("area")).first()[0]
    assert sums == pytest.approx(b.agg(F.sum("area")).first()[0])
    filled = [c for c in USR_COLUMNS if c not in ("dcomiris", "the_geom")]
    assert computed.usr_indicators.where(" or ".join(f"{c} is null" for c in filled)).count() == 0
