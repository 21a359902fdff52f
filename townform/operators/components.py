"""Connected components of an edge table, without ever gathering a group in one task.

1. Each partition contracts its own edges to stars, batch by batch: a bounded number of edges is
   held, and stars that outgrow it are given out. Edges are rebalanced by group and sorted by it, so small
   groups are finished by this step, all but those in which a batch ends, while AQE splits the partitions
   of a group that outgrows them.
2. Vertices that received different roots in different stars link those roots. The links
   are few; alternating star rounds on them run until nothing changes, each round cut by a
   checkpoint.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from townform.functions.kernels import least_labels
from townform.session import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MOST = 1 << 17  # edges that a task holds at once


def _schema(edges: DataFrame, keys: Sequence[str], a: str) -> T.StructType:
    fields = {f.name: f.dataType for f in edges.schema.fields}
    return T.StructType([T.StructField(k, fields[k]) for k in keys]
                        + [T.StructField("node", fields[a]), T.StructField("root", fields[a])])


def _stars(table: pa.Table, keys: list[str]) -> pa.Table:
    """Every vertex of the edges (``a``, ``b``) with the least vertex it is linked to by them."""
    ends = [table.select([*keys, end]).rename_columns([*keys, "node"]) for end in ("a", "b")]
    both = pa.concat_tables(ends).combine_chunks()
    # number vertices in (keys, node) order, so the least number is the least node
    columns = [both[c].to_numpy() for c in [*keys, "node"]]
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), dtype=bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[order][1:] != c[order][:-1]
    number = np.empty(len(order), dtype=np.int64)
    number[order] = np.cumsum(new) - 1
    vertex = order[new]
    n = table.num_rows
    root = least_labels(number[:n], number[n:], len(vertex))
    found = both.take(pa.array(vertex))
    return found.append_column("root", found["node"].take(pa.array(root)))


def contracted(batches: Iterable[pa.RecordBatch], keys: list[str], most: int = MOST) -> Iterator[pa.Table]:
    """Stars of a stream of edges, with at most ``most`` edges (and one batch) in memory.

    Whenever that many have gathered they are contracted. Stars of at most half as many rows take the place
    of their edges; more are given out, and later edges begin anew. A vertex may then be given out again,
    with another root: ``merge_stars`` links these, as it does those of different partitions.
    """
    held, rows = [], 0
    for batch in batches:
        held.append(pa.Table.from_batches([batch]).rename_columns([*keys, "a", "b"]))
        rows += batch.num_rows
        if rows < most:
            continue
        stars = _stars(pa.concat_tables(held), keys)
        if 2 * stars.num_rows <= most:
            held, rows = [stars.rename_columns([*keys, "a", "b"])], stars.num_rows
        else:
            held, rows = [], 0
            yield stars
    if rows:
        yield _stars(pa.concat_tables(held), keys)


def contract(edges: DataFrame, keys: Sequence[str], a: str, b: str, most: int = MOST) -> DataFrame:
    """Per partition: every vertex with the least vertex it is linked to among the edges held at once."""
    keys = list(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for stars in contracted(batches, keys, most):
            yield from stars.to_batches(max_chunksize=1 << 16)

    return edges.select(*keys, a, b).mapInArrow(run, _schema(edges, keys, a))


def _star_round(edges: DataFrame, keys: list[str]) -> DataFrame:
    """One large-star and one small-star step on (node > root) edges."""
    both = edges.select(*keys, F.col("node").alias("u"), F.col("root").alias("v")).union(
        edges.select(*keys, F.col("root").alias("u"), F.col("node").alias("v")))
    least = both.groupBy(*keys, "u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    large = (both.join(least, [*keys, "u"]).where("v > u")
             .select(*keys, F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
             .distinct())
    least = large.groupBy(*keys, "u").agg(F.min("v").alias("m"))
    small = large.join(least, [*keys, "u"])
    return (small.select(*keys, F.col("u").alias("node"), F.col("m").alias("root"))
            .union(small.select(*keys, F.col("v"), F.col("m")))
            .where("node <> root").distinct())


def _fingerprint(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64(*edges.columns).cast("decimal(38,0)"))).first()


def merge_stars(stars: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join up stars of different partitions that share a vertex."""
    keys = list(keys)
    roots = stars.groupBy(*keys, "node").agg(F.min("root").alias("first"),
                                             F.max("root").alias("last"))
    split = roots.where("first <> last").select(*keys, "node", "first")
    if split.isEmpty():  # a vertex may still be met in several partitions
        return roots.select(*keys, "node", F.col("first").alias("root"))
    links = (stars.join(split, [*keys, "node"]).where("root <> first")
             .select(*keys, F.col("root").alias("node"), F.col("first").alias("root")).distinct())
    links, seen = cut_lineage(links), None
    while (now := _fingerprint(links)) != seen:
        links, seen = cut_lineage(_star_round(links, keys)), now
    final = links.select(*keys, F.col("node").alias("first"), F.col("root").alias("least"))
    return (roots.join(final, [*keys, "first"], "left")
            .select(*keys, "node", F.coalesce("least", "first").alias("root")))


def components(edges: DataFrame, keys: Sequence[str], a: str, b: str) -> DataFrame:
    """``keys``, ``node``, ``root``: the least vertex of the component of every vertex met.

    Components never leave a group of equal ``keys``.
    """
    stars = cut_lineage(contract(edges.hint("rebalance", *keys).sortWithinPartitions(*keys), keys, a, b))
    return merge_stars(stars, keys)
