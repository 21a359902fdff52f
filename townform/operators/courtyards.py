"""Courtyards of blocks, from the free outlines of their buildings.

The union of a block is never built. Each building gives the chains of outline that no other
member covers. A chain ends where another begins; linked chains form the rings of the block,
and ring areas are sums over chains. Rings that run counter-clockwise enclose courtyards.
The block buffer is applied by the offset formula: outline length times distance, plus a term
per corner.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from townform.functions import geometry as G
from townform.functions.scalar import ratio
from townform.functions.outlines import chains
from townform.operators.components import components
from townform.operators.grid import by_cell
from townform.operators.neighbours import SPAN, both_ways
from townform.params import Params
from townform.session import cut_lineage

BLOCK = ["id_zone", "pk_usr", "pk_block"]
KEY = ["id_zone", "pk_block"]  # unique, and never NULL where buildings have no unit
CHAINS_PER_BUILDING = 1 << 24
NODE_CELL = 1.0


def block_cover(pairs: DataFrame) -> DataFrame:
    """Per building that meets another of its block, its wall parts covered by members."""
    same = pairs.where(F.col("pk_usr_a").eqNullSafe(F.col("pk_usr_b")))
    return (both_ways(same, spans=("cover_a", "cover_b"))
            .select("id_zone", "pk", F.explode("spans").alias("span"))
            .groupBy("id_zone", "pk").agg(F.collect_set("span").alias("spans")))


def free_chains(buildings: DataFrame, members: DataFrame, pairs: DataFrame, lone: bool = False, walls: bool = False) -> DataFrame:
    """Chains of all buildings that meet another or have a hole of their own, with their ``walls`` on request.

    A building without either has no courtyard and needs no chain, unless ``lone`` asks for it.
    """
    spans = F.coalesce("spans", F.array().cast(SPAN))
    rows = (buildings.select("id_zone", "pk", "the_geom")
            .join(members, ["id_zone", "pk"])
            .join(block_cover(pairs), ["id_zone", "pk"], "left"))
    if not lone:
        rows = rows.where(F.col("spans").isNotNull() | (G.num_interior_rings(F.col("the_geom")) > 0))
    return (rows
            .select(*BLOCK, "pk", F.posexplode(chains(F.col("the_geom"), spans, walls)).alias("no", "chain"))
            .select(*BLOCK, (F.col("pk").cast("long") * CHAINS_PER_BUILDING + F.col("no")).alias("chain_id"),
                    "chain.*"))


def _turning(ax: str, ay: str, bx: str, by: str) -> Column:
    a, b = (F.col(ax), F.col(ay)), (F.col(bx), F.col(by))
    return F.atan2(a[0] * b[1] - a[1] * b[0], a[0] * b[0] + a[1] * b[1])


def _spot(x: str, y: str, reach: float) -> Column:
    return F.struct((F.col(x) - reach).alias("xmin"), (F.col(y) - reach).alias("ymin"),
                    (F.col(x) + reach).alias("xmax"), (F.col(y) + reach).alias("ymax"))


def chain_links(open_chains: DataFrame, p: Params = Params()) -> DataFrame:
    """For each chain the one that continues the block's outline at its end.

    Several chains may begin there (corner contacts). Looking back along the arriving chain,
    the outside lies clockwise; the first chain met that way bounds the same outside.
    """
    reach = 3 * p.block_buffer
    # an end lies in one cell, a begin is listed in all that its reach covers, so a pair meets once
    ends = open_chains.select(*BLOCK, "chain_id", "ex", "ey", "edx", "edy",
                              *[F.floor(F.col(v) / NODE_CELL).alias(c) for v, c in (("ex", "cell_x"), ("ey", "cell_y"))])
    begins = by_cell(open_chains.select(*KEY, F.col("chain_id").alias("next_id"), "sx", "sy", "sdx", "sdy",
                                        _spot("sx", "sy", reach + p.snap).alias("spot")), "spot", NODE_CELL).drop("spot", "cell_level")
    met = ends.join(begins, [*KEY, "cell_x", "cell_y"]).where(
        G.boxes_meet(_spot("ex", "ey", reach / 2), _spot("sx", "sy", reach / 2)))
    turning = _turning("edx", "edy", "sdx", "sdy")
    # clockwise angle from the reversed arrival; turning straight back comes last
    opening = F.pmod(F.lit(math.pi) - turning, F.lit(2 * math.pi))
    opening = F.when(opening < 1e-9, F.lit(2 * math.pi)).otherwise(opening)
    gap = F.hypot(F.col("ex") - F.col("sx"), F.col("ey") - F.col("sy"))
    found = F.struct(
        F.round(opening, 6).alias("opening"), gap.alias("gap"), "next_id", "sx", "sy", turning.alias("turning"),
        (F.col("ex") * (F.col("sy") - F.col("ey")) - F.col("ey") * (F.col("sx") - F.col("ex"))).alias("moment"))
    return (met.groupBy(*BLOCK, "chain_id").agg(F.min(found).alias("link"))
            .select(*BLOCK, "chain_id", "link.next_id", "link.turning", "link.moment", "link.sx", "link.sy"))


def block_rings(buildings: DataFrame, members: DataFrame, pairs: DataFrame,
                p: Params = Params()) -> DataFrame:
    """Rings of the outlines of blocks: signed area (holes positive), length, corner terms."""
    rows = cut_lineage(free_chains(buildings, members, pairs))
    links = cut_lineage(chain_links(rows.where(~F.col("closed")), p))
    ring = (components(links, KEY, "chain_id", "next_id")
            .select("id_zone", F.col("node").alias("chain_id"), F.col("root").alias("ring_id")))
    corner = F.when(F.col("turning") > 0, F.tan(F.col("turning") / 2)).otherwise(F.col("turning") / 2)
    parts = (rows.select(*BLOCK, "chain_id", "moment", "length", "corner")
             .union(links.select(*BLOCK, "chain_id", "moment", F.lit(0.0), corner)))
    return (parts.join(ring, ["id_zone", "chain_id"], "left")
            .groupBy(*BLOCK, F.coalesce("ring_id", "chain_id").alias("ring_id"))
            .agg((F.sum("moment") / 2).alias("signed_area"), F.sum("length").alias("length"),
                 F.sum("corner").alias("corner")))


def courtyards(buildings: DataFrame, members: DataFrame, pairs: DataFrame,
               p: Params = Params()) -> DataFrame:
    """holes_area and holes_percent of the blocks that have a courtyard."""
    r = p.block_buffer
    rings = block_rings(buildings, members, pairs, p)
    size = F.abs("signed_area")
    offset = r * F.col("length") - r * r * F.col("corner")
    yard = F.when(F.col("signed_area") > 0, F.greatest(size - offset, F.lit(0.0))).otherwise(0.0)
    outer = F.when(F.col("signed_area") < 0, size + offset).otherwise(0.0)
    sums = rings.groupBy(*BLOCK).agg(F.sum(yard).alias("holes_area"), F.sum(outer).alias("outer_area"))
    return (sums.where("holes_area > 0")
            .select(*BLOCK, "holes_area",
                    (ratio(F.col("holes_area"), F.col("outer_area")) * 100).alias("holes_percent")))
