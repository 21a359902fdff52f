"""Which buildings touch or nearly touch, and what they share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from townform.functions import geometry as G
from townform.functions.shapes import covered_spans, polygon_gap
from townform.operators.grid import grid_join, grid_levels
from townform.params import Params

SPAN = "array<struct<wall: int, t0: double, t1: double>>"


def _side(buildings: DataFrame, side: str, reach: float) -> DataFrame:
    geom = F.col("the_geom")
    return buildings.select(
        "id_zone", F.col("pk").alias(f"pk_{side}"), F.col("pk_usr").alias(f"pk_usr_{side}"),
        F.col("hauteur").alias(f"h_{side}"), geom.alias(f"geom_{side}"),
        G.expand(G.bbox(geom), F.lit(reach / 2)).alias(f"box_{side}"))


def close_pairs(buildings: DataFrame, p: Params = Params()) -> DataFrame:
    """Each pair of buildings of a commune at most two block buffers (or ``epsilon``) apart, once (a < b).

    The outlines travel with the grid join, which costs less than two joins back to the
    buildings. ``spans_a`` are the wall intervals of a hidden by b within ``epsilon`` (and the
    reverse for ``spans_b``), ``cover_a`` / ``cover_b`` the same at the
    reach of a block, for pairs of one unit.
    """
    block_reach = 2 * p.block_buffer
    reach = max(block_reach, p.epsilon, p.snap)
    levels = grid_levels(_side(buildings, "a", reach), "box_a", p.building_cell)
    pairs = grid_join(_side(buildings, "a", reach), _side(buildings, "b", reach), "box_a", "box_b",
                      p.building_cell, condition=F.col("pk_a") < F.col("pk_b"), levels=(levels, levels))
    a, b = F.col("geom_a"), F.col("geom_b")
    near = F.col("gap.dist") <= p.epsilon
    unit = F.col("pk_usr_a").eqNullSafe(F.col("pk_usr_b")) & (F.col("gap.dist") <= block_reach)
    # behind a generator: a filter on a plain column would be pushed down with its kernel, and
    # the kernel would run twice
    return (pairs
            .select("*", F.explode(F.array(polygon_gap(a, b, p.snap))).alias("gap"))
            .where(F.col("gap.dist") <= reach)
            .withColumns({
                "spans_a": covered_spans(F.when(near, a), F.when(near, b), p.epsilon),
                "spans_b": covered_spans(F.when(near, b), F.when(near, a), p.epsilon),
                "cover_a": covered_spans(F.when(unit, a), F.when(unit, b), block_reach, contacts=True),
                "cover_b": covered_spans(F.when(unit, b), F.when(unit, a), block_reach, contacts=True)})
            .select("id_zone", "pk_a", "pk_b", "pk_usr_a", "pk_usr_b", "h_a", "h_b",
                    F.col("gap.dist").alias("dist"), F.col("gap.shared").alias("shared"),
                    "spans_a", "spans_b", "cover_a", "cover_b"))


def touching(pairs: DataFrame, p: Params = Params()) -> DataFrame:
    return pairs.where(F.col("dist") <= p.snap)


def near(pairs: DataFrame, p: Params = Params()) -> DataFrame:
    return pairs.where(F.col("dist") <= p.epsilon)


def both_ways(pairs: DataFrame, **columns: tuple[str, str]) -> DataFrame:
    """Ordered pairs: ``pk`` and its ``neighbour``, plus the named (a side, b side) columns."""
    def view(own, other, pick):
        return F.struct(F.col(f"pk_{own}").alias("pk"), F.col(f"pk_{other}").alias("neighbour"),
                        *[F.col(c[pick]).alias(name) for name, c in columns.items()])

    return pairs.select("id_zone", F.inline(F.array(view("a", "b", 0), view("b", "a", 1))))


def party_walls(pairs: DataFrame, p: Params = Params()) -> DataFrame:
    """Ordered touching pairs with shared wall length and area (lower height of the two)."""
    low = F.least("h_a", "h_b")
    pairs = touching(pairs, p).withColumns({"len": F.col("shared"), "surface": low * F.col("shared")})
    return both_ways(pairs, p_wall_long=("len", "len"), p_wall_area=("surface", "surface"))


def contiguity(pairs: DataFrame, p: Params = Params()) -> DataFrame:
    """Shared wall length, area and number of neighbours of buildings that touch another.

    Point contacts and overlaps count as neighbours, with length 0.
    """
    return party_walls(pairs, p).groupBy("id_zone", "pk").agg(
        F.sum("p_wall_long").alias("p_wall_long"), F.sum("p_wall_area").alias("p_wall_area"),
        F.count("*").cast("int").alias("nb_neighbor"))


def hidden_spans(pairs: DataFrame, p: Params = Params()) -> DataFrame:
    """Per building the set of wall intervals hidden by near neighbours."""
    return (both_ways(near(pairs, p), spans=("spans_a", "spans_b"))
            .select("id_zone", "pk", F.explode("spans").alias("span"))
            .groupBy("id_zone", "pk").agg(F.collect_set("span").alias("spans")))
