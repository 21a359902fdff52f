"""Forests as node tables: walks against a loop, refusals, ties, and a forest that Spark trained and saved."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from townform.plans import forest as T
from townform.plans import typology as Y
from townform.session import cut_lineage

NODES = ", ".join(f"{c} {t}" for c, t in T.NODE_COLUMNS.items())


def features(spark, n, of=lambda k: (F.col("id") * (k + 3)) % 11):
    return cut_lineage(spark.range(n).select(
        F.lit(0).alias("id_zone"), (F.col("id") % 7).cast("int").alias("pk_usr"), F.col("id").cast("int").alias("pk_building"),
        *[of(k).cast("double").alias(c) for k, c in enumerate(Y.FEATURES)]))


def grown(rng, trees, depth):
    """Trees of uneven depth, their nodes numbered at random."""
    rows = []
    for tree in range(trees):
        number = iter([3, *rng.sample(range(4, 100_000), 4 ** depth)])

        def grow(left):
            node = next(number)
            if not left or rng.random() < 0.15:
                rows.append((tree, node, None, None, None, None, rng.choice(["ba", "id", "pd", "psc"])))
            else:
                at = len(rows)
                rows.append(None)
                rows[at] = (tree, node, rng.choice(Y.FEATURES), rng.choice([0.5, 3.0, 5.0, 8.5]), grow(left - 1), grow(left - 1), None)
            return node
        grow(depth)
    return rows


@pytest.mark.parametrize("broadcast", [T.BROADCAST, 0])
def test_walks_and_votes(spark, broadcast):
    rng = random.Random(6)
    rows = grown(rng, 9, 5)
    nodes = spark.createDataFrame(rng.sample(rows, len(rows)), NODES)
    table = features(spark, 60).withColumn("i_h", F.when(F.col("pk_building") == 3, F.lit(None)).otherwise(F.col("i_h")))
    got = {r.pk_building: r.typo for r in T.classify_from_nodes(table, nodes, broadcast).collect()}
    by = {(r[0], r[1]): r for r in rows}
    for r in table.collect():
        if r.pk_building == 3:
            assert got[3] is None
            continue
        votes = Counter()
        for tree in range(9):
            node = by[tree, 3]
            while node[2]:
                node = by[tree, node[4] if r[node[2]] <= node[3] else node[5]]
            votes[node[6]] += 1
        assert got[r.pk_building] == min(votes, key=lambda c: (-votes[c], c))
    assert len(got) == 60


@pytest.mark.parametrize("most, block", [(T.NODES, T.ROWS), (200, 7), (40, T.ROWS), (0, T.ROWS)])
def test_shares_of_trees_and_blocks_of_rows(spark, most, block):
    """Whatever the shares and blocks, and by levels for trees that no share takes; repeated keys add up, as one row's votes."""
    rng = random.Random(8)
    rows = grown(rng, 40, 4)
    nodes = spark.createDataFrame(rng.sample(rows, len(rows)), NODES)
    table = features(spark, 150).withColumn("i_area", F.when(F.col("pk_building") == 5, F.lit(float("nan"))).otherwise(F.col("i_area")))
    twice = table.unionByName(table.where("pk_building < 20"))
    by = {(r[0], r[1]): r for r in rows}
    wanted = Counter()
    for r in twice.collect():
        for tree in range(40):
            node = by[tree, 3]
            while node[2]:
                node = by[tree, node[4] if r[node[2]] <= node[3] else node[5]]
            wanted[r.pk_building, node[6]] += 1
    got = {(r.pk_building, r["class"]): r.votes for r in T.votes(twice, nodes, most=most, block=block).collect()}
    assert got == dict(wanted)


def test_row_and_tree_pairs_never_become_rows(spark):
    nodes = spark.createDataFrame(grown(random.Random(3), 60, 3), NODES)
    plan = T.votes(features(spark, 50), nodes)._jdf.queryExecution().optimizedPlan().toString()
    assert "CoGroup" in plan and plan.count("Generate explode") == 2  # rows by shares, shares by blocks


@pytest.mark.parametrize("share, together", [(60, 2), (60, 1000)])
def test_shares_are_taken_together(spark, monkeypatch, share, together):
    """Rows are copied for every turn of shares, not for every share."""
    monkeypatch.setattr(T, "SHARE", share)
    monkeypatch.setattr(T, "TOGETHER", together)
    rows = grown(random.Random(5), 30, 4)
    table, nodes = features(spark, 80), spark.createDataFrame(rows, NODES)
    found = T.votes(table, nodes)
    turns = math.ceil(math.ceil(len(rows) / share) / together)
    assert f"cast({turns - 1} as bigint)" in found._jdf.queryExecution().logical().toString()
    by, wanted = {(r[0], r[1]): r for r in rows}, Counter()
    for r in table.collect():
        for tree in range(30):
            node = by[tree, 3]
            while node[2]:
                node = by[tree, node[4] if r[node[2]] <= node[3] else node[5]]
            wanted[r.pk_building, node[6]] += 1
    assert {(r.pk_building, r["class"]): r.votes for r in found.collect()} == dict(wanted)


def test_ties_go_by_name_and_equal_values_go_left(spark):
    nodes = spark.createDataFrame([(0, 1, "i_h", 5.0, 2, 3, None), (0, 2, None, None, None, None, "pd"), (0, 3, None, None, None, None, "ba"),
                                   (1, 1, None, None, None, None, "id")], NODES)
    table = features(spark, 3, lambda k: F.col("id") + 4)
    assert [r.typo for r in T.classify_from_nodes(table, nodes).orderBy("pk_building").collect()] == ["id", "id", "ba"]


@pytest.mark.parametrize("rows, why", [
    ([(0, 1, "i_h", 5.0, 2, 3, None), (0, 2, None, None, None, None, "pd")], "no node"),
    ([(0, 1, "i_h", 5.0, 2, 1, None), (0, 2, None, None, None, None, "pd")], "leads back"),
    ([(0, 1, "no such", 5.0, 2, 3, None)], "variable"),
    ([(0, 1, None, None, None, None, None)], "without class"),
    ([(0, 1, None, None, None, None, "pd"), (0, 1, None, None, None, None, "pd")], "twice"),
    ([], "empty")])
def test_tables_that_are_no_trees_are_refused(spark, rows, why):
    with pytest.raises(ValueError, match=why):
        T.classify_from_nodes(features(spark, 2), spark.createDataFrame(rows, NODES))


def test_missing_column_is_refused(spark):
    with pytest.raises(ValueError, match="split"):
        T.as_nodes(spark.createDataFrame([(0, 1)], "tree int, node long"))


def test_forest_saved_by_spark(spark, tmp_path):
    rows = features(spark, 400).withColumn("typo", F.when(F.col("i_area") > 5, "ba").otherwise("pd"))
    model = Y.train_typology(rows, trees=15, depth=5)
    model.stages[1].write().save(str(tmp_path / "forest"))
    nodes = T.nodes_of_saved(str(tmp_path / "forest"), rows)
    assert nodes.select("tree").distinct().count() == 15
    named = nodes.withColumn("class", F.when(F.col("class") == "0", "ba").when(F.col("class") == "1", "pd"))
    both = T.classify_from_nodes(rows.drop("typo"), named).withColumnRenamed("typo", "voted").join(
        Y.classify_buildings(model, rows.drop("typo")).select("pk_building", "typo"), "pk_building")
    assert both.where("voted = typo").count() > 390
