"""Import of indicators that are already computed, for some zones.

``zones`` is a DataFrame with an ``id_zone`` column, as ``resolve_areas(..., key="id_zone")``
gives it, or a list of zone numbers. Outlines are joined from the source tables and come last. Up to
``PUSHED`` zones go into the scans of both tables as a list, also into that of the outlines, which is by
far the wider one; more zones become semi joins. A row's zone is the same in both tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from townform.schemas import OUTLINE_COLUMNS

Zones = DataFrame | Sequence[int]
PUSHED = 10_000


def listed(zones: Zones, most: int = PUSHED) -> Zones:
    """The zones as a list, if they are ``most`` at the most."""
    if not isinstance(zones, DataFrame):
        return list(zones)
    rows = zones.select("id_zone").distinct().limit(most + 1).collect()
    return zones if len(rows) > most else sorted(r["id_zone"] for r in rows if r["id_zone"] is not None)


def of_zones(df: DataFrame, zones: Zones, column: str = "id_zone") -> DataFrame:
    if isinstance(zones, DataFrame):
        return df.join(zones.select(F.col("id_zone").alias(column)), column, "left_semi")
    return df.where(F.col(column).isin(list(zones)))


def _with_outline(computed: DataFrame, key: str, shapes: DataFrame, zones: Zones) -> DataFrame:
    """Rows of the zones with their outlines; only outlines of the zones are read."""
    zones = listed(zones)
    outline = of_zones(shapes, zones, "idzone").select(F.col("pk").alias(key), "the_geom")
    plain = of_zones(computed, zones).drop("the_geom")
    return plain.join(outline, key).select(*plain.columns, "the_geom")


def import_building_indicators(computed: DataFrame, bati: DataFrame, zones: Zones) -> DataFrame:
    return _with_outline(computed, "pk_building", bati, zones)


def import_usr_indicators(computed: DataFrame, usr: DataFrame, zones: Zones) -> DataFrame:
    return _with_outline(computed, "pk_usr", usr, zones)


def import_blocks(computed: DataFrame, usr_computed: DataFrame, zones: Zones) -> DataFrame:
    """Blocks of the units that belong to the zones."""
    units = of_zones(usr_computed, listed(zones)).select("pk_usr")
    return computed.join(units, "pk_usr", "left_semi").select(*computed.columns)


def import_block_outlines(computed: DataFrame, zones: Zones) -> DataFrame:
    """Walls of the blocks of the zones; a list of zones reaches the scan of the stored table, whose files are sorted by zone."""
    return of_zones(computed, listed(zones)).select(*OUTLINE_COLUMNS)


def import_typo_buildings(computed: DataFrame, bati: DataFrame, zones: Zones) -> DataFrame:
    return _with_outline(computed, "pk_building", bati, zones)


def import_typo_usr(computed: DataFrame, usr: DataFrame, zones: Zones) -> DataFrame:
    return _with_outline(computed, "pk_usr", usr, zones)


def import_communes(source: DataFrame, zones: Zones) -> DataFrame:
    return of_zones(source, listed(zones), "ogc_fid").select("the_geom", "code_insee", "unite_urbaine")


def import_iris(source: DataFrame, zones: Zones) -> DataFrame:
    return of_zones(source, listed(zones))
