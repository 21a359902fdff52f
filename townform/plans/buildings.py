"""Building indicators: shape, height, contiguity, light, distances, roads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from townform.functions import geometry as G
from townform.functions.scalar import TWO_THIRDS, or_zero, ratio
from townform.functions.shapes import lit_floor_area
from townform.operators.distances import building_distances
from townform.operators.neighbours import SPAN, contiguity, hidden_spans
from townform.operators.roads import walls_near_roads
from townform.params import Params
from townform.schemas import BUILDING_COLUMNS

KEY = ["id_zone", "pk"]


def floor_area_and_volume(buildings: DataFrame) -> DataFrame:
    return buildings.withColumns({"floor_area": F.col("area") * F.col("nb_niv"),
                                  "vol": F.col("area") * F.col("hauteur")})


def form_factor(buildings: DataFrame) -> DataFrame:
    return buildings.withColumn("form_factor", ratio(F.col("area"), F.pow("perimeter", F.lit(2))))


def concavity(buildings: DataFrame) -> DataFrame:
    return buildings.withColumn("concavity", ratio(F.col("area"), F.col("hull.area")))


def raw_compacity(buildings: DataFrame) -> DataFrame:
    """Envelope (walls and roof) over volume to the power 2/3."""
    area, height = F.col("area"), F.col("hauteur")
    envelope = F.col("perimeter") * height + area
    return buildings.withColumn("compacity_r", F.when(
        (area != 0) & (height != 0), envelope / F.pow(area * height, F.lit(TWO_THIRDS))))


def compactness(buildings: DataFrame) -> DataFrame:
    return buildings.withColumn("compactness",
                                ratio(F.col("perimeter"), 2 * F.sqrt(F.pi() * F.col("area"))))


def main_direction(buildings: DataFrame, p: Params = Params()) -> DataFrame:
    """Direction of the long side of the narrowest enclosing rectangle, clockwise from north."""
    degrees = F.pmod(F.col("hull.azimuth"), F.lit(180.0))
    if p.integer_degrees:
        degrees = F.pmod(F.floor(degrees).cast("double"), F.lit(180.0))
    return buildings.withColumn("main_dir_deg",
                                F.when(F.col("hull.width") >= p.min_width, degrees))


def fractal_dimension(buildings: DataFrame) -> DataFrame:
    return buildings.withColumn("fractal_dim", F.when(
        F.col("area") != 1, ratio(2 * F.ln("perimeter"), F.ln("area"))))


def distinct_points(buildings: DataFrame) -> DataFrame:
    geom = F.col("the_geom")
    return buildings.withColumn("num_points",
                                G.num_points(geom) - (1 + G.num_interior_rings(geom)))


def shape_columns(buildings: DataFrame, p: Params = Params()) -> DataFrame:
    """All indicators that need the building alone: one projection, no shuffle."""
    for step in (floor_area_and_volume, form_factor, concavity, raw_compacity, compactness,
                 fractal_dimension, distinct_points):
        buildings = step(buildings)
    return main_direction(buildings, p)


def with_contiguity(buildings: DataFrame, neighbours: DataFrame) -> DataFrame:
    """Party walls and what follows from them; a building without neighbours shares nothing.

    Fills come in two steps, since the later ones read the earlier.
    """
    wall_area = F.col("perimeter") * F.col("hauteur")
    rows = buildings.join(neighbours, KEY, "left").withColumns({
        "nb_neighbor": F.coalesce("nb_neighbor", F.lit(0)),
        "b_floor_long": F.col("perimeter"),
        "b_wall_area": wall_area,
        "p_wall_long": or_zero(F.col("p_wall_long")),
        "p_wall_area": or_zero(F.col("p_wall_area"))})
    return rows.withColumns({
        "free_p_wall_long": F.col("b_floor_long") - F.col("p_wall_long"),
        "free_ext_area": F.col("b_wall_area") - F.col("p_wall_area") + F.col("area"),
        "contiguity": F.when(F.col("b_wall_area") > 0,
                             F.col("p_wall_area") / F.col("b_wall_area")).otherwise(0.0)})


def net_compacity(buildings: DataFrame) -> DataFrame:
    """Free envelope over volume to the power 2/3; the raw value without neighbours."""
    return buildings.withColumn("compacity_n", F.when(
        F.col("nb_neighbor") > 0,
        ratio(F.col("free_ext_area"), F.pow(F.col("area") * F.col("hauteur"), F.lit(TWO_THIRDS))))
        .otherwise(F.col("compacity_r")))


def passive_share(rows: DataFrame, p: Params = Params()) -> DataFrame:
    """Turn the hidden wall parts of each building (``spans``) into its lit share."""
    hidden = F.coalesce("spans", F.array().cast(SPAN))
    lit = lit_floor_area(F.col("the_geom"), hidden, p.passive_depth)
    return rows.withColumn(
        "p_vol_ratio", F.round(F.least(ratio(lit, F.col("area")), F.lit(1.0)), 2)).drop("spans")


def passive_volume(buildings: DataFrame, spans: DataFrame, p: Params = Params()) -> DataFrame:
    """Share of the footprint lit from free walls. ``spans``: hidden wall parts by building."""
    return passive_share(buildings.join(spans, KEY, "left"), p)


def road_columns(buildings: DataFrame, near: DataFrame) -> DataFrame:
    def percent(of):
        return F.round(or_zero(ratio(F.col("l_3m") * 100, F.col(of))), 1)

    return (buildings.join(near, KEY, "left")
            .withColumns({"l_tot": F.round("perimeter", 3), "l_3m": or_zero(F.col("l_3m"))})
            .withColumns({"l_ratio": percent("l_tot"), "l_ratio_cvx": percent("l_cvx")}))


def building_indicators(buildings: DataFrame, roads: DataFrame, pairs: DataFrame,
                        members: DataFrame, p: Params = Params()) -> DataFrame:
    """The building table. All joined parts are aggregates by building, so each side is
    already partitioned by its key when it meets the buildings. The kernel comes after the
    joins, since its output no longer counts as partitioned."""
    rows = shape_columns(buildings, p)
    rows = with_contiguity(rows, contiguity(pairs, p))
    rows = net_compacity(rows)
    rows = rows.join(hidden_spans(pairs, p), KEY, "left")
    rows = rows.join(building_distances(buildings, p), KEY, "left")
    rows = road_columns(rows, walls_near_roads(buildings, roads, p))
    rows = rows.join(members.select(*KEY, "pk_block"), KEY, "left")
    rows = passive_share(rows, p)
    filled = ("min_dist", "mean_dist", "max_dist", "std_dist", "insee_individus")
    return rows.withColumns({c: or_zero(F.col(c)) for c in filled}).select(*BUILDING_COLUMNS)
