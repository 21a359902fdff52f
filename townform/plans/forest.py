"""A random forest as a table of nodes, so that one trained elsewhere can be loaded and applied.

``nodes``: tree, node, variable, split, left, right, class. A tree begins at its least node. An inner node
sends a row to ``left`` where the variable is at most ``split``, otherwise to ``right``; a node without
variable is a leaf and names a class. This is the table that the usual packages list for a tree.

Every row meets every tree, but no such pair becomes a row. Trees are dealt into shares of about ``SHARE``
nodes, rows into blocks of at most about ``ROWS``; a task takes one block and up to ``TOGETHER`` shares, one
after the other, and returns one row of counts for each row of the block. So rows are copied once for every
``SHARE * TOGETHER`` nodes, not for every share, and shares travel compressed. The counts are then added up.
A tree of more than ``NODES`` nodes is walked level by level: the rows of a level are joined with its nodes
by (tree, node). A level is broadcast while it has at most ``BROADCAST`` nodes; wider ones join by an
exchange, where their many nodes spread the rows.
Every tree votes for a class; the most votes win, of equal ones the first class in order of names.
"""

from __future__ import annotations

import sys
import zlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from townform.functions.ballots import NODE, ballots, packed
from townform.plans.typology import FEATURES
from townform.session import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

NODE_COLUMNS = {"tree": "int", "node": "long", "variable": "string", "split": "double", "left": "long", "right": "long", "class": "string"}
BROADCAST = 200_000
ROWS = 1 << 18   # of a block
NODES = 1 << 20  # of the largest tree that a share takes
SHARE = 1 << 17  # nodes of a share, if no tree has more
TOGETHER = 32    # shares that a task takes
KEY = ["id_zone", "pk_building"]


def as_nodes(table: DataFrame) -> DataFrame:
    """A stored node table with the declared columns and types."""
    missing = [c for c in NODE_COLUMNS if c not in table.columns]
    if missing:
        raise ValueError(f"the node table lacks {', '.join(missing)}")
    return table.select(*[F.col(c).cast(t).alias(c) for c, t in NODE_COLUMNS.items()])


def _refuse(found: DataFrame, why: str) -> None:
    row = found.first()
    if row is not None:
        raise ValueError(f"{why}: tree {row['tree']}, node {row['node']}")


def levels(nodes: DataFrame) -> list[tuple[DataFrame, int]]:
    """Nodes by their depth, with their number. Refuses tables that are no trees over the known variables."""
    place = F.array_position(F.array(*map(F.lit, FEATURES)), F.col("variable")).cast("int")
    nodes = cut_lineage(as_nodes(nodes).withColumn("place", place))
    inner = F.col("variable").isNotNull()
    _refuse(nodes.groupBy("tree", "node").count().where("count > 1"), "a node is listed twice")
    _refuse(nodes.where(inner & ((F.col("place") == 0) | F.col("split").isNull())), "no known variable or no split")
    _refuse(nodes.where(~inner & F.col("class").isNull()), "a leaf without class")
    left = nodes.count()
    here = nodes.groupBy("tree").agg(F.min("node").alias("node"))
    out = []
    while left > 0:
        level = cut_lineage(nodes.join(here, ["tree", "node"]))
        n, wanted = level.count(), here.count()
        if n < wanted:
            _refuse(here.join(nodes, ["tree", "node"], "left_anti"), "a branch leads to no node")
        if not n:
            break  # nodes that no root leads to do not matter
        out.append((level, n))
        left -= n
        here = cut_lineage(level.where("variable is not null").select("tree", F.explode(F.array("left", "right")).alias("node")))
        if left <= 0 and not here.isEmpty():
            _refuse(here, "a branch leads back")
    return out


def _walked(rows: DataFrame, table: list[tuple[DataFrame, int]], broadcast: int) -> DataFrame:
    """key, class, votes by a join for every level of the trees."""
    trees = table[0][0].agg(F.sort_array(F.collect_list(F.struct("tree", "node")))).first()[0]  # one root for each tree
    state = rows.select(*KEY, "x", F.explode(F.array(*[F.struct(F.lit(t["tree"]).cast("int").alias("tree"), F.lit(t["node"]).cast("long").alias("node"))
                                                       for t in trees])).alias("at")).select(*KEY, "x", "at.*", F.lit(None).cast("string").alias("class"))
    for level, n in table:
        step = level.select("tree", "node", "place", "split", "left", "right", F.col("class").alias("leaf"))
        goes: Column = F.when(F.element_at("x", F.col("place")) <= F.col("split"), F.col("left")).otherwise(F.col("right"))
        state = (state.join(F.broadcast(step) if n <= broadcast else step, ["tree", "node"], "left")
                 .select(*KEY, "x", "tree", F.when(F.col("place").isNotNull(), goes).alias("node"), F.coalesce("class", "leaf").alias("class")))
    return state.groupBy(*KEY, "class").agg(F.count("*").alias("votes"))


def _polled(rows: DataFrame, nodes: DataFrame, size: int, most: int, block: int) -> DataFrame:
    """key, class, votes by blocks of rows and shares of trees. ``size``: number of the nodes."""
    met = nodes.agg(F.sort_array(F.collect_set("class")), F.sort_array(F.collect_set("place"))).first()
    classes, places = list(met[0]), list(met[1])
    # predictors that no tree asks for stay behind
    rows = cut_lineage(rows.select(*KEY, *[F.element_at("x", F.lit(k)).alias(f"x{k}") for k in places]))
    shares = -(-size // min(most, SHARE))
    turns = -(-shares // TOGETHER)
    blocks = max(1, -(-rows.count() // block), -(-2 * rows.sparkSession.sparkContext.defaultParallelism // turns))
    unit = (F.col("turn") * blocks + F.col("block")).alias("unit")
    asked = nodes.withColumn("place", sum((F.when(F.col("place") == k, at).otherwise(0) for at, k in enumerate(places)), F.lit(0))
                             + F.when(F.col("place").isNull(), -1).otherwise(0))

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        return pa.table({"share": pa.array([key[0].as_py()], pa.int64()), "trees": pa.array([zlib.compress(packed(table, classes))], pa.binary())})

    # trees are packed once; their bytes go to every block, the rows of a block to every turn of shares
    held = (asked.withColumn("share", F.pmod(F.xxhash64("tree"), F.lit(shares))).groupBy("share")
            .applyInArrow(pack, "share long, trees binary").withColumn("turn", F.col("share") % turns)
            .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))).select(unit, "trees"))
    dealt = (rows.withColumn("block", F.monotonically_increasing_id() % blocks)
             .withColumn("turn", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(turns - 1).cast("long"))))
             .select(unit, *rows.columns))
    names = [f"v{k}" for k in range(len(classes))]
    schema = T.StructType([rows.schema[c] for c in KEY] + [T.StructField(v, T.IntegerType()) for v in names])

    def poll(table: pa.Table, trees: pa.Table) -> pa.Table:
        keys = table.select(KEY)
        if not table.num_rows or not trees.num_rows:
            return pa.table([*(c.slice(0, 0) for c in keys.columns), *(pa.array([], pa.int32()) for _ in names)], [*KEY, *names])
        x = np.stack([table[f"x{k}"].to_numpy() for k in places]) if places else np.empty((0, table.num_rows))
        counts = sum(ballots(np.frombuffer(zlib.decompress(share.as_buffer()), dtype=NODE), x, len(classes)) for share in trees["trees"])
        return pa.table([*keys.columns, *(pa.array(c) for c in counts)], [*KEY, *names])

    counts = dealt.groupBy("unit").cogroup(held.groupBy("unit")).applyInArrow(poll, schema)
    sums = counts.groupBy(*KEY).agg(*[F.sum(v).alias(v) for v in names])
    return sums.select(*KEY, F.inline(F.array(*[F.struct(F.lit(c).alias("class"), F.col(v).alias("votes"))
                                               for c, v in zip(classes, names)]))).where("votes > 0")


def votes(features: DataFrame, nodes: DataFrame, broadcast: int = BROADCAST, most: int = NODES, block: int = ROWS) -> DataFrame:
    """key, class, votes for the rows of which all predictors are known."""
    values = F.array(*[F.col(c).cast("double") for c in FEATURES])
    table = levels(nodes)
    if not table:
        raise ValueError("the node table is empty")
    rows = features.select(*KEY, values.alias("x")).where(~F.exists("x", lambda v: v.isNull()))
    every = reduce(DataFrame.unionByName, [level for level, _ in table])
    sizes = cut_lineage(every.groupBy("tree").agg(F.count("*").alias("size")))
    large = sizes.where(F.col("size") > most).select("tree")
    size = sizes.where(F.col("size") <= most).agg(F.sum("size")).first()[0]
    parts = []
    if size:
        parts.append(_polled(rows, every.join(large, "tree", "left_anti"), size, most, block))
    if not large.isEmpty():
        kept = [cut_lineage(level.join(large, "tree", "left_semi").select(level.columns)) for level, _ in table]
        parts.append(_walked(rows, [(level, n) for level in kept if (n := level.count())], broadcast))
    if len(parts) == 1:
        return parts[0]
    return parts[0].unionByName(parts[1]).groupBy(*KEY, "class").agg(F.sum("votes").alias("votes"))


def classify_from_nodes(features: DataFrame, nodes: DataFrame, broadcast: int = BROADCAST, most: int = NODES, block: int = ROWS) -> DataFrame:
    """``features`` with the typology that most trees vote for; NULL where a predictor is missing."""
    best = (votes(features, nodes, broadcast, most, block).groupBy(*KEY)
            .agg(F.min(F.struct((-F.col("votes")).alias("less"), "class")).alias("best")))
    return features.join(best.select(*KEY, F.col("best.class").alias("typo")), KEY, "left").select(*features.columns, "typo")


def nodes_of_saved(path: str, features: DataFrame) -> DataFrame:
    """Nodes of a forest that Spark saved at ``path`` (the folder of the forest's stage), with leaf numbers as classes.

    ``features`` gives the session. The forest must have been trained on ``FEATURES`` in their order. Spark's own
    forests add up shares of classes, so their predictions can differ from a vote where trees are undecided.
    """
    data = features.sparkSession.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    inner = F.col("leftChild") >= 0
    name = F.element_at(F.array(*map(F.lit, FEATURES)), F.col("split.featureIndex") + 1)
    return as_nodes(data.select(
        F.col("treeID").alias("tree"), F.col("id").alias("node"), F.when(inner, name).alias("variable"),
        F.when(inner, F.col("split.leftCategoriesOrThreshold")[0]).alias("split"), F.when(inner, F.col("leftChild")).alias("left"),
        F.when(inner, F.col("rightChild")).alias("right"), F.when(~inner, F.col("prediction").cast("int").cast("string")).alias("class")))
