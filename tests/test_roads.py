import math

import pytest
from pyspark.sql import functions as F
from shapes_in_town import box, by_pk, line, town, turned

from townform.functions.geometry import GEOMETRY
from townform.operators import roads as R
from townform.params import Params
from townform.plans import buildings as BB

FAR = dict(dx=652_000.0, dy=6_862_000.0)


def roads(spark, *rows):
    return spark.createDataFrame([(k, 0, w, g) for k, (w, g) in enumerate(rows)],
                                 f"pk int, id_zone int, largeur double, the_geom {GEOMETRY.simpleString()}")


@pytest.mark.parametrize("degrees", [0, 30, 145])
def test_length_near_roads_is_invariant_under_rotation(spark, degrees):
    move = lambda pts: turned(pts, degrees, **FAR)
    df = town(spark, [box(0, 2, 20, 12), box(0, 30, 20, 40), box(100, 100, 110, 110)], move=move)
    # reach 5 below the first building: its long wall and 3 m of both sides
    road = roads(spark, (2.0, line((-50, 0), (300, 0), move=move)))
    got = by_pk(R.walls_near_roads(df, road), "l_3m")
    assert got == {0: pytest.approx(26.0, abs=1e-3)}


def test_round_end_and_bend_count_once(spark):
    df = town(spark, [box(0, 0, 20, 10)])
    # the road ends 3 m from the wall: within 5 m of the end lie 8 m of wall
    end = roads(spark, (2.0, line((10, -30), (10, -3))))
    assert by_pk(R.walls_near_roads(df, end), "l_3m")[0] == pytest.approx(8.0, abs=1e-3)
    # both arms of a bend reach the same wall, the second time over
    bend = roads(spark, (2.0, line((-20, -4), (10, -4), (40, -4))), (2.0, line((-20, -4), (40, -4))))
    assert by_pk(R.walls_near_roads(df, bend), "l_3m")[0] == pytest.approx(20 + 2 * 1, abs=1e-3)


@pytest.mark.parametrize("cell", [2.0, 25.0, 1000.0])
def test_cutting_roads_changes_nothing(spark, cell):
    df = town(spark, [turned(box(0, 0, 12, 8), 17 * k, 25 * k, 3 * k) for k in range(6)])
    road = roads(spark, (4.0, line((-30, -8), (60, 2), (160, 30))))
    got = by_pk(R.walls_near_roads(df, road, Params(road_cell=cell)), "l_3m")
    # every wall sampled against the road
    def dist(p, a, b):
        t = max(0, min(1, ((p[0] - a[0]) * (b[0] - a[0]) + (p[1] - a[1]) * (b[1] - a[1]))
                       / ((b[0] - a[0]) ** 2 + (b[1] - a[1]) ** 2)))
        return math.dist(p, (a[0] + t * (b[0] - a[0]), a[1] + t * (b[1] - a[1])))

    for k in range(6):
        corners = turned(box(0, 0, 12, 8), 17 * k, 25 * k, 3 * k)
        total = 0.0
        for a, b in zip(corners, corners[1:] + corners[:1]):
            near = sum(min(dist(q, (-30, -8), (60, 2)), dist(q, (60, 2), (160, 30))) <= 7
                       for q in ((a[0] + (b[0] - a[0]) * (i + .5) / 2000, a[1] + (b[1] - a[1]) * (i + .5) / 2000)
                                 for i in range(2000)))
            total += math.dist(a, b) * near / 2000
        assert got.get(k, 0.0) == pytest.approx(total, abs=0.05)


def test_ratios_and_far_buildings(spark):
    df = town(spark, [box(0, 2, 20, 12), box(0, 300, 20, 310)]).withColumn("l_cvx", F.col("perimeter"))
    rows = BB.road_columns(df, R.walls_near_roads(df, roads(spark, (2.0, line((-50, 0), (70, 0))))))
    assert by_pk(rows, "l_3m", "l_tot", "l_ratio", "l_ratio_cvx") == {
        0: (26.0, 60.0, 43.3, 43.3), 1: (0.0, 60.0, 0.0, 0.0)}


def test_inner_walls_do_not_count(spark):
    df = town(spark, [[box(0, 0, 30, 30), box(10, 10, 20, 20)]])
    assert by_pk(R.walls_near_roads(df, roads(spark, (2.0, line((15, 11), (15, 19))))), "l_3m") == {}


def test_pieces_with_their_reach_fit_into_four_cells(spark):
    """So that long roads are of one level, and walls are listed for that one."""
    p = Params()
    pieces = R.road_segments(roads(spark, (2.0, line((0, 0), (640, 0))), (5.0, line((0, 0), (0, 90))), (40.0, line((0, 0), (300, 0)))), p)
    size = F.greatest(F.col("road_box.xmax") - F.col("road_box.xmin"), F.col("road_box.ymax") - F.col("road_box.ymin"))
    assert pieces.where("radius < 10").where(size > 4 * p.road_cell).isEmpty()
    assert pieces.where("radius > 40").count() == 300 / 25 and pieces.agg(F.sum(F.hypot("ex", "ey"))).first()[0] == pytest.approx(1030)
