"""Outlines of blocks as a table of walls in order, without ever gathering a block.

The free chains of a block's buildings are linked to rings, as for the courtyards. A ring's walls get their
numbers by list ranking: every chain points to the one that continues it and knows how many walls lie
between the two; pointers are doubled, each round a join of the chains that are linked, until all point to
the ring's first chain. The number of walls behind a chain then gives its place. Rounds grow with the
logarithm of the most chains of a ring.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from townform.functions.scalar import or_zero
from townform.operators.components import components
from townform.operators.courtyards import BLOCK, KEY, chain_links, free_chains
from townform.params import Params
from townform.schemas import OUTLINE_COLUMNS
from townform.session import cut_lineage

CHAIN = ["id_zone", "chain_id"]


def rounds_for(n: int) -> int:
    """Doublings that reach ``n`` steps."""
    return max(n - 1, 0).bit_length()


def _doubled(links: DataFrame, rounds: int) -> DataFrame:
    """For every chain where ``2 ** rounds`` steps lead, at most to the chain ``first``, and the walls on the way."""
    stays = F.col("chain_id") == F.col("first")
    state = links.select(*CHAIN, "first", F.when(stays, F.col("first")).otherwise(F.col("next_id")).alias("to"),
                         F.when(stays, 0).otherwise(F.col("walls")).cast("long").alias("behind"))
    for _ in range(rounds):
        ahead = state.select("id_zone", F.col("chain_id").alias("to"), F.col("to").alias("further"), F.col("behind").alias("more"))
        state = cut_lineage(state.join(ahead, ["id_zone", "to"]).select(
            *CHAIN, "first", F.col("further").alias("to"), (F.col("behind") + F.col("more")).alias("behind")))
    return state


def ring_places(links: DataFrame) -> DataFrame:
    """id_zone, chain_id, ring_id and begin, the number of walls ahead of the chain in its ring.

    ``links``: id_zone, chain_id, next_id, walls; every ``next_id`` is a chain of the table. A ring is named
    by its least chain and begins there. Where several chains lead into one, chains lie beside the circle:
    the ring then begins at the least chain of the circle, and all chains are numbered by their distance.
    """
    ring = components(links, ["id_zone"], "chain_id", "next_id").select("id_zone", F.col("node").alias("chain_id"), F.col("root").alias("ring_id"))
    rows = cut_lineage(links.join(ring, CHAIN).withColumn("first", F.col("ring_id")))
    totals = rows.groupBy("id_zone", "ring_id").agg(F.count("*").alias("n"), F.sum("walls").alias("total"),
                                                    F.count_distinct("next_id").alias("met"))
    rounds = rounds_for(totals.agg(F.max("n")).first()[0] or 0)
    ranked = _doubled(rows, rounds)
    lost = ranked.where("to <> first")
    if not lost.isEmpty():  # the least chain lies beside the circle: nothing leads back to it
        again = lost.groupBy("id_zone", F.col("first").alias("ring_id")).agg(F.min("to").alias("found"))
        moved = rows.join(again, ["id_zone", "ring_id"]).withColumn("first", F.col("found"))
        rest = ranked.join(again.select("id_zone", F.col("ring_id").alias("first")), ["id_zone", "first"], "left_anti")
        ranked = rest.unionByName(_doubled(moved, rounds))
    sized = ranked.join(rows.select(*CHAIN, "ring_id", "walls"), CHAIN).join(totals, ["id_zone", "ring_id"])
    at_first = F.col("chain_id") == F.col("first")
    begin = F.when(at_first, 0).otherwise(F.col("total") - F.col("behind"))
    simple = sized.where("n = met").select(*CHAIN, "ring_id", begin.alias("begin"))
    by_place = Window.partitionBy("id_zone", "ring_id").orderBy(at_first.desc(), F.desc("behind"), "chain_id")
    others = sized.where("n > met").select(*CHAIN, "ring_id", or_zero(
        F.sum("walls").over(by_place.rowsBetween(Window.unboundedPreceding, -1))).alias("begin"))
    return simple.unionByName(others)


def _wall(*ends: Column) -> Column:
    return F.struct(*[e.cast("double").alias(c) for e, c in zip(ends, ("x1", "y1", "x2", "y2"))])


def block_outlines(buildings: DataFrame, members: DataFrame, pairs: DataFrame, p: Params = Params()) -> DataFrame:
    """One row per wall of the outline of every block: key, ring_id, hole, seq, x1, y1, x2, y2, srid.

    ``seq`` counts the walls of a ring from 0 in the order in which they follow each other; shells run
    clockwise, holes the other way. The outline is that of the buildings themselves, without the buffer that
    joins them; gaps that the buffer bridges are walls too, so a ring closes.
    """
    rows = cut_lineage(free_chains(buildings, members, pairs, lone=True, walls=True))
    links = cut_lineage(chain_links(rows.where(~F.col("closed")), p).withColumnsRenamed({"moment": "link_moment", "sx": "nx", "sy": "ny"})
                        .drop("turning"))
    gap = (F.col("ex") != F.col("nx")) | (F.col("ey") != F.col("ny"))
    bridge = F.when(gap, F.array(_wall(F.col("ex"), F.col("ey"), F.col("nx"), F.col("ny")))).otherwise(F.array())
    # what follows carries no walls but their number
    sizes = rows.where(~F.col("closed")).select(*CHAIN, "ex", "ey", F.size("walls").alias("own")).join(
        links.select(*CHAIN, "next_id", "nx", "ny"), CHAIN)
    places = ring_places(sizes.select(*CHAIN, "next_id", (F.col("own") + gap.cast("int")).alias("walls")))
    whole = (rows.join(links.select(*CHAIN, "nx", "ny", "link_moment"), CHAIN, "left").join(places, CHAIN, "left")
             .select(*BLOCK, F.coalesce("ring_id", "chain_id").alias("ring_id"), or_zero(F.col("begin")).alias("begin"),
                     (F.col("moment") + or_zero(F.col("link_moment"))).alias("moment"),
                     F.when(F.col("nx").isNull(), F.col("walls")).otherwise(F.concat("walls", bridge)).alias("walls")))
    whole = cut_lineage(whole)
    area = whole.groupBy(*KEY, "ring_id").agg((F.sum("moment") / 2).alias("signed_area"))
    return (whole.join(area, [*KEY, "ring_id"])
            .select(*BLOCK, "ring_id", (F.col("signed_area") > 0).alias("hole"), "begin", F.posexplode("walls").alias("no", "wall"), F.lit(p.srid).alias("srid"))
            .select(*BLOCK, "ring_id", "hole", (F.col("begin") + F.col("no")).cast("long").alias("seq"), "wall.*", "srid")
            .select(*OUTLINE_COLUMNS))


def ring_measures(outlines: DataFrame) -> DataFrame:
    """signed area (holes positive), length and number of walls of every ring of a table of outlines.

    Coordinates are taken relative to the ring's least corner: far from the origin products lose digits.
    """
    low = outlines.groupBy(*KEY, "ring_id").agg(F.min("x1").alias("ox"), F.min("y1").alias("oy"))
    x1, y1, x2, y2 = (F.col(c) - F.col(o) for c, o in (("x1", "ox"), ("y1", "oy"), ("x2", "ox"), ("y2", "oy")))
    return (outlines.join(low, [*KEY, "ring_id"]).groupBy(*BLOCK, "ring_id", "hole")
            .agg((F.sum(x1 * y2 - x2 * y1) / 2).alias("signed_area"), F.sum(F.hypot(x2 - x1, y2 - y1)).alias("length"), F.count("*").alias("walls")))


def ring_breaks(outlines: DataFrame) -> DataFrame:
    """Walls that do not begin where the one ahead of them in their ring ends, the first one behind the last."""
    order = Window.partitionBy(*KEY, "ring_id")
    ahead = outlines.select(*KEY, "ring_id", F.pmod(F.col("seq") + 1, F.count("*").over(order)).alias("seq"), F.col("x2").alias("px"), F.col("y2").alias("py"))
    return (outlines.join(ahead, [*KEY, "ring_id", "seq"], "left")
            .where(~(F.col("x1").eqNullSafe(F.col("px")) & F.col("y1").eqNullSafe(F.col("py")))).select(*outlines.columns))
