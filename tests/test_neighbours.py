import math

import pytest
from pyspark.sql import functions as F
from shapes_in_town import box, by_pk, town, turned

from townform.operators import distances as D
from townform.operators import neighbours as N
from townform.params import Params
from townform.plans import buildings as BB

L_SHAPE = [(0, 0), (0, 20), (10, 20), (10, 10), (30, 10), (30, 0)]
FAR = dict(dx=652_000.0, dy=6_862_000.0)
ROW = [box(0, 0, 10, 10), box(10, 0, 18, 6), box(18, 6, 25, 12), box(40, 0, 45, 5)]


@pytest.mark.parametrize("degrees", [0, 30, 90, 211])
def test_contiguity_is_invariant_under_rotation(spark, degrees):
    df = town(spark, ROW, move=lambda pts: turned(pts, degrees, **FAR), heights=[9, 3, 6, 6])
    got = by_pk(N.contiguity(N.close_pairs(df)), "p_wall_long", "p_wall_area", "nb_neighbor")
    # 0 and 1 share 6 m; 1 and 2 meet in a corner only; 3 stands alone
    assert got[0] == pytest.approx((6.0, 18.0, 1), abs=1e-5)
    assert got[1] == pytest.approx((6.0, 18.0, 2), abs=1e-5)
    assert got[2] == pytest.approx((0.0, 0.0, 1), abs=1e-5)
    assert 3 not in got


def test_overlap_and_containment_count_without_length(spark):
    df = town(spark, [box(0, 0, 10, 10), box(5, 5, 15, 15), box(2, 2, 4, 4)])
    got = by_pk(N.contiguity(N.close_pairs(df)), "p_wall_long", "nb_neighbor")
    assert got == {0: (0.0, 2), 1: (0.0, 1), 2: (0.0, 1)}


def test_same_direction_walls_are_not_shared(spark):
    df = town(spark, [box(0, 0, 10, 10), box(0, 0, 5, 5)])
    assert by_pk(N.contiguity(N.close_pairs(df)), "p_wall_long") == {0: 0.0, 1: 0.0}


def test_l_shape_wraps_its_neighbour(spark):
    df = town(spark, [L_SHAPE, box(10, 10, 30, 20)])
    assert by_pk(N.contiguity(N.close_pairs(df)), "p_wall_long", "nb_neighbor") == {0: (30.0, 1), 1: (30.0, 1)}


def test_no_pairs_across_communes(spark):
    df = town(spark, [box(0, 0, 10, 10), box(10, 0, 20, 10)], zone=[1, 2])
    assert N.close_pairs(df).count() == 0


@pytest.mark.parametrize("cell", [3.0, 7.0, 23.0, 500.0])
def test_cell_size_does_not_change_pairs(spark, cell):
    outlines = [box(x * 9, y * 9, x * 9 + 9 + (x % 2), y * 9 + 9) for x in range(6) for y in range(6)]
    rows = N.close_pairs(town(spark, outlines), Params(building_cell=cell))
    got = {(r["pk_a"], r["pk_b"], round(r["dist"], 6), round(r["shared"], 6)) for r in rows.collect()}
    same = N.close_pairs(town(spark, outlines))
    assert got == {(r["pk_a"], r["pk_b"], round(r["dist"], 6), round(r["shared"], 6)) for r in same.collect()}
    assert len(got) == rows.count()


def test_contiguity_properties(spark):
    outlines = [box(x * 9, y * 7, x * 9 + 9, y * 7 + (7 if x % 2 else 5)) for x in range(5) for y in range(5)]
    df = town(spark, outlines)
    pairs = N.close_pairs(df)
    walls = N.party_walls(pairs).select("pk", "neighbour", "p_wall_long")
    back = walls.select(F.col("neighbour").alias("pk"), F.col("pk").alias("neighbour"), F.col("p_wall_long").alias("l"))
    assert walls.join(back, ["pk", "neighbour"]).where("abs(p_wall_long - l) > 1e-9").count() == 0
    rows = BB.with_contiguity(df, N.contiguity(pairs))
    assert rows.where("p_wall_long > perimeter or free_p_wall_long < 0 or contiguity > 1").count() == 0


def _brute(outlines):
    """Least distances between outlines, sampled densely."""
    import numpy as np
    points = []
    for o in outlines:
        ring = [*o, o[0]]
        points.append(np.array([(x1 + (x2 - x1) * t, y1 + (y2 - y1) * t)
                                for (x1, y1), (x2, y2) in zip(ring, ring[1:]) for t in np.linspace(0, 1, 400)]))
    return lambda i, j: float(np.sqrt(((points[i][:, None] - points[j][None]) ** 2).sum(-1).min()))


@pytest.mark.parametrize("tile", [2, 3, 128])
def test_distances_do_not_depend_on_tiles(spark, tile):
    outlines = [turned(box(0, 0, 5 + k, 4), 25 * k, 30 * (k % 3), 25 * (k // 3)) for k in range(8)]
    got = by_pk(D.building_distances(town(spark, outlines), Params(tile=tile)),
                "min_dist", "mean_dist", "max_dist", "std_dist")
    brute = _brute(outlines)
    for i in range(8):
        d = [brute(i, j) for j in range(8) if j != i]
        mean = sum(d) / 7
        std = math.sqrt(sum((x - mean) ** 2 for x in d) / 7)
        assert got[i] == pytest.approx((min(d), mean, max(d), std), abs=2e-2)


def test_distance_zero_for_overlap_and_lone_buildings(spark):
    df = town(spark, [box(0, 0, 10, 10), box(5, 5, 15, 15), box(2, 2, 4, 4), box(50, 50, 60, 60)], usr=[0, 0, 0, 1])
    found = D.building_distances(df)
    got = by_pk(D.with_lone_buildings(df, found), "min_dist", "max_dist", "mean_dist")
    assert found.count() == 3
    assert got[0] == (0, 0, 0) and got[3] == (0, 0, 0)
    assert got[1] == pytest.approx((0, math.sqrt(2), math.sqrt(2) / 2))


@pytest.mark.parametrize("degrees", [0, 30])
def test_passive_share_of_a_lone_rectangle(spark, degrees):
    df = town(spark, [box(0, 0, 30, 24)], move=lambda pts: turned(pts, degrees, **FAR))
    rows = BB.passive_volume(df, N.hidden_spans(N.close_pairs(df)))
    assert rows.first()["p_vol_ratio"] == 0.70  # 1 - 17.99 * 11.99 / 720


def test_passive_share_with_hidden_walls(spark):
    # three in a row: the middle one is lit from above and below only; one wholly enclosed
    row = [box(0, 0, 30, 30), box(30, 0, 60, 30), box(60, 0, 90, 30)]
    df = town(spark, row)
    got = by_pk(BB.passive_volume(df, N.hidden_spans(N.close_pairs(df))), "p_vol_ratio")
    assert got[1] == round(2 * 6.005 / 30, 2)
    assert got[0] == got[2] == round(1 - (30 - 6.005) * (30 - 12.01) / 900, 2)
    frame = [box(0, 0, 30, 10), box(0, 20, 30, 30), box(0, 10, 10, 20), box(20, 10, 30, 20), box(10, 10, 20, 20)]
    df = town(spark, frame)
    assert by_pk(BB.passive_volume(df, N.hidden_spans(N.close_pairs(df))), "p_vol_ratio")[4] == 0.0


def test_courtyard_walls_are_free(spark):
    df = town(spark, [[box(0, 0, 40, 40), box(15, 15, 25, 25)]])
    got = BB.passive_volume(df, N.hidden_spans(N.close_pairs(df))).first()["p_vol_ratio"]
    outer = 1600 - (40 - 12.01) ** 2
    # 15 m wings: strips of 6.005 from both sides do not meet; corners of the yard stay dark
    assert got == pytest.approx(round((outer + 4 * 10 * 6.005) / 1500, 2))
