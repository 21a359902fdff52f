import math
import time

import numpy as np
import pytest
from pyspark.sql import functions as F
from shapes_in_town import box, by_pk, polygon, town, turned

from townform.functions import kernels as K
from townform.functions.geometry import GEOMETRY
from townform.operators import courtyards as C
from townform.operators import neighbours as N
from townform.operators.distances import building_distances
from townform.operators.overlap import max_overlap
from townform.plans import blocks as B
from townform.sources import inputs as I
from townform.sources.results import as_final

FAR = dict(dx=652_000.0, dy=6_862_000.0)


def _polygons(spark, key, rows):
    return spark.createDataFrame([(0, k, polygon(o, move=lambda pts: turned(pts, 30, **FAR))) for k, o in rows],
                                 f"id_zone int, {key} string, the_geom {GEOMETRY.simpleString()}")


def _outlines(*shapes):
    """Segments of corner lists, and their offsets."""
    parts = [np.array([(*p, *q) for p, q in zip(s, s[1:] + s[:1])], float).T for s in shapes]
    return np.concatenate(parts, axis=1), K.starts([p.shape[1] for p in parts])


@pytest.mark.parametrize("left_turn, right_turn", [(1, 1), (1, -1), (-1, 1), (-1, -1)])
def test_direction_of_outlines_does_not_matter(spark, left_turn, right_turn):
    left = _polygons(spark, "l", [("a", box(0, 0, 10, 10)[::left_turn])])
    right = _polygons(spark, "r", [("a_small", box(-9, 0, 1, 10)[::right_turn]), ("b_big", box(1, 0, 20, 10)[::right_turn])])
    assert by_pk(max_overlap(left, "l", right, "r"), "r", key="l") == {"a": "b_big"}


def test_longer_common_border_wins_where_nothing_overlaps(spark):
    left = _polygons(spark, "l", [("a", box(0, 0, 10, 10))])
    right = _polygons(spark, "r", [("p", box(-20, -5, 3, 0)), ("q", box(3, -5, 30, 0)), ("s", box(10, 10, 20, 20))])
    assert by_pk(max_overlap(left, "l", right, "r", grow=0.0001), "r", key="l") == {"a": "q"}


def test_areas_and_borders_in_closed_form():
    a = _outlines(*[box(0, 0, 10, 10)] * 6)
    b = _outlines(box(10, 2, 20, 7), box(3, -5, 30, 0), box(10, 10, 20, 20), box(2, 2, 5, 5), box(0, 0, 10, 10), box(5, 5, 15, 30))
    assert K.common_borders(*a, *b, 1e-6) == pytest.approx([5, 7, 0, 0, 40, 0])
    assert K.common_areas(*a, *b) == pytest.approx([0, 0, 0, 9, 100, 25])


def test_outlines_of_many_corners_are_swept():
    turn = -np.arange(5000) * 2 * np.pi / 5000
    a, b = (_outlines([(float(x), float(y)) for x, y in zip(np.cos(turn) + dx, np.sin(turn))]) for dx in (0, 0.5))
    begin = time.perf_counter()
    area, border = K.common_areas(*a, *b), K.common_borders(*a, *b, 1e-6)
    assert time.perf_counter() - begin < 0.5
    assert area[0] == pytest.approx(2 * math.acos(0.25) - 0.25 * math.sqrt(3.75), rel=1e-5)
    assert border[0] == 0


def test_blocks_of_buildings_without_unit(spark):
    frame = [box(0, 0, 30, 10), box(0, 20, 30, 30), box(0, 10, 10, 20), box(20, 10, 30, 20)]
    df = town(spark, frame).withColumn("pk_usr", F.lit(None).cast("int"))
    pairs = N.close_pairs(df)
    members = B.block_members(df, pairs)
    assert B.block_main_dir(df, members).count() == 1
    assert [r["pk_usr"] for r in C.courtyards(df, members, pairs).collect()] == [None]
    sums = df.withColumns({"floor_area": F.lit(1.0), "vol": F.lit(1.0), "free_ext_area": F.lit(1.0)}).join(
        members.select("id_zone", "pk", "pk_block"), ["id_zone", "pk"])
    row = B.block_indicators(sums, df, members, pairs).collect()
    assert len(row) == 1 and row[0]["main_dir_deg"] is not None
    assert row[0]["holes_area"] == pytest.approx(9.98 ** 2, abs=1e-5)


def test_equal_distances_do_not_spread(spark):
    # three points of an equilateral triangle, each the corner of a tiny building that points outwards
    side, outer = 1234.567, []
    for k in range(3):
        outer.append(turned([(side / math.sqrt(3), 0), (side / math.sqrt(3) + 3, 1), (side / math.sqrt(3) + 3, -1)], 120 * k, **FAR))
    rows = building_distances(town(spark, outer)).collect()
    assert len(rows) == 3 and all(r["std_dist"] < 1e-8 and r["mean_dist"] == pytest.approx(side) for r in rows)


def test_final_tables_lack_no_column(spark):
    with pytest.raises(ValueError, match="lacks unite_urbaine, the_geom"):
        as_final(spark.createDataFrame([(1, "x")], "id_zone int, code_insee string"), "final_communes")


def test_keys_beyond_32_bits(spark):
    df = town(spark, [box(0, 0, 10, 10), box(12, 0, 20, 10)]).withColumn("pk", F.col("pk") + F.lit(5 << 32))
    assert set(by_pk(building_distances(df), "min_dist")) == {5 << 32, (5 << 32) + 1}
    zones = spark.createDataFrame([(5 << 32, "10001", "A")], "ogc_fid long, code_insee string, unite_urbaine string")
    assert I.scan_communes(zones).first()["id_zone"] == 5 << 32


def test_codes_of_roads_reach_the_scan(spark, tmp_path):
    rows = [(1, "10001", "10002", 3.0), (2, "10003", "10004", 3.0)]
    roads = spark.createDataFrame(rows, "pk long, inseecom_g string, inseecom_d string, largeur double")
    roads.withColumn("the_geom", F.lit(None).cast(GEOMETRY)).write.parquet(str(tmp_path / "roads"))
    zones = spark.createDataFrame([(k, str(10000 + k), "A") for k in range(1, 5)], "ogc_fid int, code_insee string, unite_urbaine string")
    got = I.prepare_roads(spark.read.parquet(str(tmp_path / "roads")), zones, ["10002"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(EqualTo(inseecom_g,10002),EqualTo(inseecom_d,10002))]" in plan
    assert [(r["pk"], r["id_zone"]) for r in got.collect()] == [(1, 2)]
