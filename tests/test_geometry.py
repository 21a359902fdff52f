import math

import pytest
from pyspark.sql import functions as F
from shapes_in_town import box, by_pk, polygon, town, turned

from townform.functions import geometry as G
from townform.functions.shapes import hull, overlap_area
from townform.plans import buildings as BB

L_SHAPE = [(0, 0), (0, 20), (10, 20), (10, 10), (30, 10), (30, 0)]
U_SHAPE = [(0, 0), (0, 20), (10, 20), (10, 10), (20, 10), (20, 20), (30, 20), (30, 0)]
TRIANGLE = [(0, 0), (0, 3), (4, 0)]
RING = [box(0, 0, 30, 30), box(10, 10, 20, 20)]
FAR = dict(dx=652_000.0, dy=6_862_000.0)


@pytest.mark.parametrize("degrees,shift", [(0, {}), (30, {}), (0, FAR), (77, FAR)])
def test_measures_do_not_depend_on_place(spark, degrees, shift):
    df = BB.shape_columns(town(spark, [L_SHAPE, U_SHAPE, TRIANGLE, RING],
                               move=lambda pts: turned(pts, degrees, **shift)))
    got = by_pk(df, "area", "perimeter", "concavity", "num_points", "form_factor", "compactness")
    expected = {
        0: (400.0, 100.0, 400 / 500, 6), 1: (500.0, 120.0, 500 / 600, 8), 2: (6.0, 12.0, 1.0, 3),
        3: (800.0, 120.0, 800 / 900, 8)}
    for pk, (area, perimeter, concavity, points) in expected.items():
        assert got[pk][:3] == pytest.approx((area, perimeter, concavity), rel=1e-7)
        assert got[pk][3] == points
        assert got[pk][4] == pytest.approx(area / perimeter ** 2, rel=1e-7)
        assert got[pk][5] == pytest.approx(perimeter / (2 * math.sqrt(math.pi * area)), rel=1e-7)


@pytest.mark.parametrize("degrees", [0, 10, 45, 90, 135, 170])
def test_main_direction_turns_with_the_shape(spark, degrees):
    # turning counter-clockwise lowers the azimuth; the long side starts at 90
    df = BB.main_direction(town(spark, [box(0, 0, 30, 24)], move=lambda pts: turned(pts, degrees)))
    got = df.first()["main_dir_deg"]
    assert math.isclose((got - (90 - degrees)) % 180, 0, abs_tol=1e-6) or math.isclose(
        (got - (90 - degrees)) % 180, 180, abs_tol=1e-6)
    assert 0 <= got < 180


def test_square_takes_smallest_azimuth_and_sliver_has_none(spark):
    df = BB.main_direction(town(spark, [box(0, 0, 5, 5), box(0, 0, 20, 0.05)]))
    assert by_pk(df, "main_dir_deg") == {0: 0.0, 1: None}


def test_whole_degrees_on_request(spark):
    from townform.params import Params
    df = BB.main_direction(town(spark, [turned(box(0, 0, 30, 24), 12.4)]), Params(integer_degrees=True))
    assert df.first()["main_dir_deg"] == 77.0


def test_normalize_orients_and_starts_at_least_vertex(spark):
    wrong = polygon([(5, 0), (5, 5), (0, 5), (0, 0)], [(1, 1), (1, 2), (2, 2), (2, 1)])
    df = spark.createDataFrame([(wrong,)], f"the_geom {G.GEOMETRY.simpleString()}")
    shell, hole = df.select(G.normalize(F.col("the_geom")).alias("g")).first()["g"]["rings"]
    assert [tuple(p) for p in shell["pts"]] == [(0, 0), (0, 5), (5, 5), (5, 0), (0, 0)]
    assert [tuple(p) for p in hole["pts"]] == [(1, 1), (2, 1), (2, 2), (1, 2), (1, 1)]


def test_counts_parts_and_points(spark):
    two = (0, [(0, False, [(0.0, 0.0), (0.0, 1.0), (1.0, 0.0), (0.0, 0.0)]),
               (1, False, [(5.0, 0.0), (5.0, 1.0), (6.0, 0.0), (5.0, 0.0)])])
    df = spark.createDataFrame([(0, two), (1, (0, [])), (2, polygon(*RING))],
                               f"pk int, g {G.GEOMETRY.simpleString()}")
    g = F.col("g")
    got = by_pk(df.select("pk", G.num_geometries(g).alias("n"), G.is_empty(g).alias("e"),
                          G.num_points(g).alias("p"), G.num_interior_rings(g).alias("h"),
                          G.set_srid(g, 2154)["srid"].alias("s")), "n", "e", "p", "h", "s")
    assert got == {0: (2, False, 8, 0, 2154), 1: (0, True, 0, 0, 2154), 2: (1, False, 10, 1, 2154)}


def test_centroid_and_holes(spark):
    df = town(spark, [L_SHAPE, RING], move=lambda pts: turned(pts, **FAR))
    got = by_pk(df.select("pk", G.centroid(F.col("the_geom")).alias("c"),
                          G.area(G.holes(F.col("the_geom"))).alias("h")), "c", "h")
    # the L is a 30 x 10 bar plus a 10 x 10 block on its left end
    assert got[0][0]["x"] - FAR["dx"] == pytest.approx((300 * 15 + 100 * 5) / 400, abs=1e-6)
    assert got[0][0]["y"] - FAR["dy"] == pytest.approx((300 * 5 + 100 * 15) / 400, abs=1e-6)
    assert (got[1][0]["x"] - FAR["dx"], got[1][1]) == pytest.approx((15, 100), abs=1e-6)


def test_azimuth_and_line_ends(spark):
    row = spark.range(1).select(
        F.degrees(G.azimuth(F.lit(0), F.lit(0), F.lit(1), F.lit(0))).alias("east"),
        F.degrees(G.azimuth(F.lit(0), F.lit(0), F.lit(-1), F.lit(0))).alias("west")).first()
    assert (row["east"], row["west"]) == pytest.approx((90, 270))


@pytest.mark.parametrize("a,b,shared", [
    ([box(0, 0, 10, 10)], [box(5, 5, 15, 15)], 25.0),
    ([box(0, 0, 10, 10)], [box(10, 0, 20, 10)], 0.0),
    (RING, [box(5, 5, 25, 25)], 300.0),
    ([L_SHAPE], [box(5, 5, 15, 15)], 75.0),
    ([box(0, 0, 10, 10)], [turned(box(-5, -5, 5, 5), 45, 5, 5)], 82.842712),
])
@pytest.mark.parametrize("degrees", [0, 33])
def test_overlap_area(spark, a, b, shared, degrees):
    move = lambda pts: turned(pts, degrees, **FAR)
    both = [(G_ := polygon(*a, move=move)), polygon(*b, move=move)]
    df = spark.createDataFrame([(0, *both)], f"pk int, a {G.GEOMETRY.simpleString()}, b {G.GEOMETRY.simpleString()}")
    df = df.select(F.explode(F.array(G.normalize(F.col("a")))).alias("a"), "b").select(
        "a", F.explode(F.array(G.normalize(F.col("b")))).alias("b"))
    assert df.select(overlap_area(F.col("a"), F.col("b")).alias("s")).first()["s"] == pytest.approx(shared, abs=1e-5)


def test_hull_of_many_points(spark):
    import numpy as np
    rng = np.random.default_rng(3)
    circle = [(math.cos(t) * 50, math.sin(t) * 50) for t in np.sort(rng.uniform(0, 2 * math.pi, 300))[::-1]]
    row = town(spark, [circle, TRIANGLE]).select("pk", hull(F.col("the_geom")).alias("h"), "area", "perimeter")
    got = by_pk(row, "h", "area", "perimeter")
    assert got[0][0]["area"] == pytest.approx(got[0][1])
    assert got[0][0]["perimeter"] == pytest.approx(got[0][2])
    assert got[1][0]["width"] == pytest.approx(2.4)  # height over the longest side
