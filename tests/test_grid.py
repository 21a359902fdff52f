"""Grids of several sizes: all pairs once, few rows for wide boxes; and zones that reach scans."""

import random

import pytest
from pyspark.sql import functions as F

from testbed.city import city
from townform.operators.grid import by_cell, grid_join, grid_levels
from townform.sources import computed as M
from townform.sources import inputs as I

SF = "/root/testdata/sf0.001"


def boxes(spark, rows, name):
    return spark.createDataFrame([(0, k, b) for k, b in rows],
                                 f"id_zone int, {name} int, box_{name} struct<xmin: double, ymin: double, xmax: double, ymax: double>")


def wanted(a, b):
    return {(i, j) for i, p in a for j, q in b if p[0] <= q[2] and q[0] <= p[2] and p[1] <= q[3] and q[1] <= p[3]}


@pytest.mark.parametrize("levels", [None, ([0], [0])])
def test_boxes_of_all_sizes_meet_once(spark, levels):
    rng = random.Random(2)

    def some(n):
        out = []
        for k in range(n):
            x, y, w = rng.uniform(-300, 300), rng.uniform(-300, 300), rng.choice([0, 1, 10, 25, 25.0001, 60, 400])
            out.append((k, (x, y, x + w, y + w * rng.random())))
        return out
    a, b = some(150), some(150)
    got = grid_join(boxes(spark, a, "a"), boxes(spark, b, "b"), "box_a", "box_b", 25.0, levels=levels).select("a", "b").collect()
    assert len(got) == len(set(got)) and {(r.a, r.b) for r in got} == wanted(a, b)


def test_a_wide_site_among_houses_costs_few_rows(spark):
    houses = [(k, (x := (k % 40) * 50.0, y := (k // 40) * 50.0, x + 10, y + 10)) for k in range(1000)]
    rows = [*houses, (5000, (0.0, 0.0, 2000.0, 2000.0))]
    df = boxes(spark, rows, "a")
    levels = grid_levels(df, "box_a", 25.0)
    assert levels == [0, 7]
    listed = by_cell(df, "box_a", 25.0, levels, levels).groupBy("a").count()
    assert listed.where("a = 5000").first()["count"] <= 4 and listed.agg(F.sum("count")).first()[0] <= 8 * len(rows)
    got = grid_join(df, boxes(spark, rows, "b"), "box_a", "box_b", 25.0, condition=F.col("a") < F.col("b"), levels=(levels, levels))
    assert {(r.a, r.b) for r in got.select("a", "b").collect()} == {p for p in wanted(rows, rows) if p[0] < p[1]}


def test_a_box_is_not_listed_where_no_other_meets_it(spark):
    houses = boxes(spark, [(k, (30.0 * k + 1, 1.0, 30.0 * k + 11, 11.0)) for k in range(40)], "a")
    assert by_cell(houses, "box_a", 25.0, [0], [2]).where("cell_level <> 2").isEmpty()
    wide = boxes(spark, [(1, (5.0, 5.0, 95.0, 9.0))], "b")
    assert sorted(r.a for r in grid_join(houses, wide, "box_a", "box_b", 25.0).collect()) == [0, 1, 2, 3]


def test_boxes_of_one_level_are_listed_as_before(spark):
    df = boxes(spark, [(1, (0.0, 0.0, 30.0, 10.0))], "a")
    assert by_cell(df, "box_a", 25.0).count() == 2
    assert grid_levels(df.where("a > 5"), "box_a", 25.0) == [0]


def test_zones_reach_the_scans_of_outlines(spark, tmp_path):
    c = city(spark, "/root/testdata/sf0.01")
    c.bati.write.parquet(str(tmp_path / "bati"))
    bati = spark.read.parquet(str(tmp_path / "bati"))
    computed = I.prepare_buildings(bati, c.zones).select(F.col("pk").alias("pk_building"), "id_zone", "area")
    zones = I.resolve_areas(I.scan_communes(c.zones), "unite_urbaine", ["UU_0", "UU_2"], key="id_zone")
    scans = lambda df: [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "PushedFilters" in line and "the_geom" in line]
    for asked in (zones, [0, 2, 5, 7]):
        found = scans(M.import_building_indicators(computed, bati, asked))
        assert found and all("In(idzone, [0,2,5,7])" in line for line in found if "ReadSchema" in line)
    coded = I.prepare_buildings(bati, c.zones, I.resolve_areas(I.scan_communes(c.zones), "unite_urbaine", ["UU_0"]))
    assert any("In(idzone, [0,5])" in line for line in scans(coded))
    # more zones than may be listed are joined, with the same rows
    assert M.listed(zones, most=3) is zones and M.listed(zones) == [0, 2, 5, 7]
    whole, joined = (M._with_outline(computed, "pk_building", bati, z) for z in (zones, [0, 2, 5, 7]))
    assert whole.select("pk_building").exceptAll(joined.select("pk_building")).count() == 0
