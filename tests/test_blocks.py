import math
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from shapes_in_town import box, by_pk, town, turned

from townform.operators import components as K
from townform.operators import courtyards as C
from townform.operators import neighbours as N
from townform.plans import blocks as B
from townform.session import cut_lineage

FAR = dict(dx=652_000.0, dy=6_862_000.0)
FRAME = [box(0, 0, 30, 10), box(0, 20, 30, 30), box(0, 10, 10, 20), box(20, 10, 30, 20)]
PINWHEEL = [box(0, 0, 10, 10), box(10, 10, 20, 20), box(20, 0, 30, 10), box(10, -10, 20, 0)]


def setup(spark, outlines, **options):
    df = town(spark, outlines, **options)
    pairs = N.close_pairs(df)
    members = B.block_members(df, pairs)
    return df, pairs, members


def test_blocks_stay_within_units(spark):
    outlines = [box(0, 0, 10, 10), box(10, 0, 20, 10), box(20, 0, 30, 10), box(30.015, 0, 40, 10), box(40.03, 0, 50, 10)]
    _, _, members = setup(spark, outlines, usr=[0, 0, 1, 1, 1])
    # 0.015 m apart dissolves, 0.03 m does not
    assert by_pk(members, "pk_block") == {0: 0, 1: 0, 2: 2, 3: 2, 4: 4}


@pytest.mark.parametrize("degrees", [0, 30])
def test_frame_encloses_a_courtyard(spark, degrees):
    df, pairs, members = setup(spark, FRAME, move=lambda pts: turned(pts, degrees, **FAR))
    row = C.courtyards(df, members, pairs).collect()
    assert len(row) == 1
    # the yard shrinks by 0.01 all round; the outline grows with round corners
    outer = 900 + 0.01 * 120 + math.pi * 0.01 ** 2
    assert row[0]["holes_area"] == pytest.approx(9.98 ** 2, abs=1e-5)
    assert row[0]["holes_percent"] == pytest.approx(9.98 ** 2 / outer * 100, abs=1e-5)


@pytest.mark.parametrize("degrees", [0, 45, 120])
def test_corner_contacts_close_a_courtyard(spark, degrees):
    df, pairs, members = setup(spark, PINWHEEL, move=lambda pts: turned(pts, degrees, **FAR))
    row = C.courtyards(df, members, pairs).first()
    assert row["holes_area"] == pytest.approx(9.98 ** 2, abs=1e-5)


def test_narrow_gap_closes_wide_gap_opens(spark):
    for gap, yards in ((0.015, 1), (0.2, 0)):
        outlines = [*FRAME[:3], box(20, 10, 30, 20 - gap)]
        df, pairs, members = setup(spark, outlines)
        assert C.courtyards(df, members, pairs).count() == yards


def test_open_u_has_none_and_own_hole_counts(spark):
    u = [(0, 0), (0, 20), (10, 20), (10, 10), (20, 10), (20, 20), (30, 20), (30, 0)]
    df, pairs, members = setup(spark, [u])
    assert C.courtyards(df, members, pairs).count() == 0
    df, pairs, members = setup(spark, [u, box(0, 20, 30, 25)])
    assert C.courtyards(df, members, pairs).first()["holes_area"] == pytest.approx(9.98 ** 2, abs=1e-5)
    df, pairs, members = setup(spark, [[box(0, 0, 30, 30), box(10, 10, 20, 20)]])
    assert C.courtyards(df, members, pairs).first()["holes_area"] == pytest.approx(9.98 ** 2, abs=1e-5)


def test_two_courtyards_and_a_filled_one(spark):
    double = [*FRAME, box(30, 0, 60, 10), box(30, 20, 60, 30), box(50, 10, 60, 20)]
    df, pairs, members = setup(spark, double)
    assert C.courtyards(df, members, pairs).first()["holes_area"] == pytest.approx(
        9.98 ** 2 + 19.98 * 9.98, abs=1e-5)
    df, pairs, members = setup(spark, [*FRAME, box(10, 10, 20, 20)])
    assert C.courtyards(df, members, pairs).count() == 0


def test_overlapping_buildings_union_once(spark):
    df, pairs, members = setup(spark, [box(0, 0, 30, 12), box(0, 18, 30, 30), box(0, 8, 10, 22), box(20, 8, 30, 22)])
    row = C.courtyards(df, members, pairs).first()
    assert row["holes_area"] == pytest.approx(9.98 * 5.98, abs=1e-5)


@pytest.mark.parametrize("share", [1, 2, 1024])
def test_block_direction_in_shares(spark, monkeypatch, share):
    monkeypatch.setattr(B, "HULL_SHARE", share)
    chain = [turned(box(k * 10, 0, k * 10 + 10, 5), 25) for k in range(6)]
    df, _, members = setup(spark, chain)
    rows = B.block_main_dir(df, members).collect()
    assert len(rows) == 1 and rows[0]["main_dir_deg"] == pytest.approx(65.0, abs=1e-6)


def _labels(df):
    rows = df.select("node", "root").collect()
    assert len({r["node"] for r in rows}) == len(rows)
    return dict(map(tuple, rows))


@pytest.mark.parametrize("most", [K.MOST, 10])
@pytest.mark.parametrize("spread", ["a", "b", None])
def test_components_split_over_partitions(spark, spread, most):
    # a long path, a ring and a star, edges scattered so that no partition sees a whole group
    path = [(k, k + 1) for k in range(0, 60)]
    ring = [(100 + k, 100 + (k + 1) % 17) for k in range(17)]
    star = [(200, 200 + k) for k in range(1, 40)]
    edges = spark.createDataFrame([(1, a, b) for a, b in path + ring + star], "g int, a int, b int")
    edges = edges.repartition(8, spread) if spread else edges.repartition(8)
    stars = K.contract(edges, ["g"], "a", "b", most)
    got = _labels(K.merge_stars(stars, ["g"]))
    assert got == {**{k: 0 for k in range(61)}, **{100 + k: 100 for k in range(17)},
                   **{200 + k: 200 for k in range(40)}}


def test_vertex_of_two_partitions_comes_once(spark):
    # both partitions name the same root: nothing is left to link
    edges = spark.createDataFrame([(1, 0, 2), (1, 0, 3)], "g int, a int, b int").repartitionByRange(2, "b")
    assert _labels(K.merge_stars(K.contract(edges, ["g"], "a", "b"), ["g"])) == {0: 0, 2: 0, 3: 0}


def _batches(a, b, size=10_000):
    for k in range(0, len(a), size):
        yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(a[k:k + size]), np.int64)), pa.array(a[k:k + size]), pa.array(b[k:k + size])], ["g", "x", "y"])


def _peak(a, b, most):
    """Most bytes of numpy arrays at once, and the stars."""
    tracemalloc.start()
    try:
        stars = [t.num_rows for t in K.contracted(_batches(a, b), ["g"], most)]
        return tracemalloc.get_traced_memory()[1], stars
    finally:
        tracemalloc.stop()


@pytest.mark.parametrize("vertices", [5_000, 1_000_000])
def test_million_edges_of_one_unit_in_bounded_memory(vertices):
    """Few vertices are contracted in place, many are given out; memory hangs on the bound alone."""
    rng, most = np.random.default_rng(3), 1 << 16
    a, b = rng.integers(0, vertices, (2, 1_000_000))
    base = _peak(a[:most], b[:most], most)[0]
    peak, stars = _peak(a, b, most)
    assert peak < 2 * base
    assert len(stars) == 1 if vertices < most // 2 else len(stars) > 10


def test_path_longer_than_a_task_holds(spark):
    """A path of 100,000 edges in mixed order, all of one unit; a task holds 4,096 of its 25,000."""
    n = 100_000
    path = spark.range(n).select(F.lit(1).alias("g"), F.col("id").alias("a"), (F.col("id") + 1).alias("b")).repartition(4, F.xxhash64("a") % 1000)
    found = K.merge_stars(cut_lineage(K.contract(path, ["g"], "a", "b", 1 << 12)), ["g"])
    assert found.agg(F.count("*"), F.count_distinct("node"), F.max("root")).first() == (n + 1, n + 1, 0)


def test_components_keep_groups_apart(spark):
    edges = spark.createDataFrame([(1, 5, 6), (2, 6, 7), (1, 6, 9)], "g int, a int, b int")
    got = {(r["g"], r["node"]): r["root"] for r in K.components(edges, ["g"], "a", "b").collect()}
    assert got == {(1, 5): 5, (1, 6): 5, (1, 9): 5, (2, 6): 6, (2, 7): 6}


def test_block_sums_equal_building_sums(spark):
    outlines = [box(x * 9, y * 7, x * 9 + 9, y * 7 + (7 if (x + y) % 3 else 5)) for x in range(5) for y in range(5)]
    df, pairs, members = setup(spark, outlines)
    assert B.blocks(members).agg(F.sum("members")).first()[0] == 25
    assert members.where("pk_block > pk").count() == 0
