"""Outlines of blocks: chains against a walk, list ranking against a loop, rings of hand-made blocks."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from shapes_in_town import box, town, turned

from townform.functions.outlines import ranked
from townform.operators import neighbours as N
from townform.operators import outlines as L
from townform.operators.courtyards import chain_links
from townform.plans import blocks as B
from townform.sources.computed import import_block_outlines

FAR = dict(dx=652_000.0, dy=6_862_000.0)
FRAME = [box(0, 0, 30, 10), box(0, 20, 30, 30), box(0, 10, 10, 20), box(20, 10, 30, 20)]
PINWHEEL = [box(0, 0, 10, 10), box(10, 10, 20, 20), box(20, 0, 30, 10), box(10, -10, 20, 0)]


def outlines(spark, buildings, **options):
    df = town(spark, buildings, **options)
    pairs = N.close_pairs(df)
    return L.block_outlines(df, B.block_members(df, pairs), pairs)


def rings(table):
    assert L.ring_breaks(table).count() == 0
    return sorted((r.hole, round(r.signed_area, 6), round(r.length, 6)) for r in L.ring_measures(table).collect())


def test_ranking_of_chains_and_circles():
    rng = np.random.default_rng(1)
    for _ in range(60):
        n = int(rng.integers(0, 40))
        after, item, at = np.full(n, -1), rng.permutation(n), 0
        want = {}
        while at < n:
            part = item[at:at + int(rng.integers(1, 9))]
            at += len(part)
            after[part[:-1]] = part[1:]
            circle = rng.random() < 0.4
            if circle:
                after[part[-1]] = part[0]
                part = np.roll(part, -int(part.argmin()))
            want.update({int(k): (int(part[0]), p, circle) for p, k in enumerate(part)})
        first, place, circle = ranked(after)
        assert {k: (int(first[k]), int(place[k]), bool(circle[k])) for k in range(n)} == want


@pytest.mark.parametrize("degrees", [0, 30])
def test_frame_lone_house_and_house_with_a_yard(spark, degrees):
    buildings = [*FRAME, box(100, 0, 110, 5), [box(200, 0, 230, 30), box(210, 10, 220, 20)]]
    table = outlines(spark, buildings, move=lambda pts: turned(pts, degrees, **FAR))
    assert rings(table) == [(False, -900.0, 120.0), (False, -900.0, 120.0), (False, -50.0, 30.0), (True, 100.0, 40.0), (True, 100.0, 40.0)]
    assert table.columns == ["id_zone", "pk_usr", "pk_block", "ring_id", "hole", "seq", "x1", "y1", "x2", "y2", "srid"]


def test_corner_contacts_and_bridged_gaps(spark):
    # through a corner the ring goes on in the next building
    assert rings(outlines(spark, PINWHEEL)) == [(False, -500.0, 120.0), (True, 100.0, 40.0)]
    # a gap of 0.015 m is bridged by walls of its width
    got = rings(outlines(spark, [box(0, 0, 10, 10), box(10.015, 0, 20, 10)]))
    assert len(got) == 1 and got[0][1] == pytest.approx(-200.0, abs=1e-6) and got[0][2] == pytest.approx(60.0, abs=1e-6)


def test_own_walls_and_points_are_kept(spark):
    table = outlines(spark, [box(0, 0, 10, 10), box(10, 2, 20, 8)])
    points = {(r.x1, r.y1) for r in table.collect()}
    assert points == {(0, 0), (0, 10), (10, 10), (10, 8), (20, 8), (20, 2), (10, 2), (10, 0)}
    order = [(r.x1, r.y1) for r in table.orderBy("seq").collect()]
    at = order.index((0, 0))
    assert order[at:] + order[:at] == [(0, 0), (0, 10), (10, 10), (10, 8), (20, 8), (20, 2), (10, 2), (10, 0)]


def test_places_in_long_rings_of_many_partitions(spark):
    rng = random.Random(4)
    rows, want = [], {}
    for ring, size in ((0, 1), (1, 2), (2, 700), (3, 33)):
        chains = rng.sample(range(ring * 10_000, ring * 10_000 + 9_999), size)
        first = chains.index(min(chains))
        chains = chains[first:] + chains[:first]
        begin = 0
        for k, c in enumerate(chains):
            walls = rng.randint(1, 9)
            rows.append((5, c, chains[(k + 1) % size], walls))
            want[c] = (chains[0], begin)
            begin += walls
    rng.shuffle(rows)
    links = spark.createDataFrame(rows, "id_zone long, chain_id long, next_id long, walls int").repartition(8)
    assert {r.chain_id: (r.ring_id, r.begin) for r in L.ring_places(links).collect()} == want


def test_chains_beside_a_circle_get_their_own_places(spark):
    # 1 leads into the circle 3 -> 7 -> 9, where 7 and 1 both go on in 9
    links = spark.createDataFrame([(0, 1, 9, 2), (0, 3, 7, 4), (0, 7, 9, 1), (0, 9, 3, 5)], "id_zone long, chain_id long, next_id long, walls int")
    got = {r.chain_id: r.begin for r in L.ring_places(links).collect()}
    assert got == {3: 0, 1: 4, 7: 6, 9: 7}


def test_import_of_zones(spark):
    table = outlines(spark, [box(0, 0, 10, 10), box(50, 0, 60, 10)], zone=[1, 2])
    assert [r.id_zone for r in import_block_outlines(table, [2]).select("id_zone").distinct().collect()] == [2]


def test_chains_are_linked_once_across_cells(spark):
    """Corners on and near borders of the cells: each end is listed once, and finds the same begins as by comparing all."""
    spots = [(x + dx, y + dy) for x in (0.0, 1.0) for y in (0.0, 0.5) for dx in (0.0, -0.014, 0.014) for dy in (0.0, 0.016)]
    rows = [(0, 1, 1, k, *spots[k], *spots[(k * 5 + 3) % len(spots)], 1.0, 0.0, 0.0, 1.0) for k in range(len(spots))]
    chains = spark.createDataFrame(rows, "id_zone long, pk_usr long, pk_block long, chain_id long, sx double, sy double, ex double, ey double, "
                                         "sdx double, sdy double, edx double, edy double")
    links = chain_links(chains)
    assert links._jdf.queryExecution().optimizedPlan().toString().count("Generate explode") == 2
    near = {r[3]: min((math.hypot(r[6] - s[4], r[7] - s[5]), s[3]) for s in rows if abs(r[6] - s[4]) <= 0.03 and abs(r[7] - s[5]) <= 0.03)[1] for r in rows}
    got = links.collect()
    assert len(got) == len(rows) and {r.chain_id: r.next_id for r in got} == near
