"""Connected components of link tables of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from townform.llm.tables import staged


def components(edges: DataFrame) -> DataFrame:
    """node, root for every node of ``edges`` (a, b): the root is one node of the component.

    Rounds of contraction: every node hooks to its least neighbour, roots of roots are taken, edges
    go on between roots. Stars vanish in one round; each round is a written table. Groupings are
    pre-aggregated and joins are plain, so a node with very many edges is split by Spark.
    """
    rest = staged(edges.where("a <> b").select("a", "b").distinct(), "edges")
    roots = None
    while True:
        both = rest.unionByName(rest.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = staged(both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("node"), F.least("a", "low").alias("root")), "hooks")
        up = hook.select(F.col("node").alias("root"), F.col("root").alias("top"))
        hook = hook.join(up, "root").select("node", F.col("top").alias("root"))
        if roots is not None:
            up = hook.select(F.col("node").alias("root"), F.col("root").alias("top"))
            roots = roots.join(up, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
        else:
            roots = hook
        roots = staged(roots, "roots")
        if rest.isEmpty():
            return roots
        rest = (rest.join(hook.select(F.col("node").alias("a"), F.col("root").alias("a_root")), "a")
                .join(hook.select(F.col("node").alias("b"), F.col("root").alias("b_root")), "b")
                .where("a_root <> b_root").select(F.least("a_root", "b_root").alias("a"), F.greatest("a_root", "b_root").alias("b")).distinct())
        rest = staged(rest, "edges")
        if rest.isEmpty():
            return roots
