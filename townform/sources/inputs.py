"""Preparation of the source tables.

Every function takes DataFrames from any Spark source (``spark.read.parquet``, ``read_jdbc``,
...) and keeps filters and column lists declarative, so they reach the scan. ``codes`` limits
a run to some communes: a list of codes is pushed into the scan, a DataFrame with a
``code_insee`` column becomes a semi join, None takes all communes at once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from townform.functions import geometry as G
from townform.functions.shapes import hull
from townform.params import Params
from townform.sources.computed import listed, of_zones

Codes = DataFrame | Sequence[str] | None

USR_FIGURES = ("insee_individus", "insee_menages", "insee_men_coll", "insee_men_surf",
               "insee_surface_collectif", "route_longueur", "trottoir_longueur")


def read_jdbc(spark: SparkSession, url: str, table: str, columns: Sequence[str] = ("*",),
              partition_column: str | None = None, bounds: tuple[int, int] | None = None,
              partitions: int = 64, **options: str) -> DataFrame:
    """A remote table. With ``partition_column`` it is read in parallel key ranges."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if partition_column:
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", bounds[0]).option("upperBound", bounds[1])
                  .option("numPartitions", partitions))
    return reader.load().select(*columns)


def in_codes(df: DataFrame, column: str, codes: Codes) -> DataFrame:
    if codes is None:
        return df
    if isinstance(codes, DataFrame):
        wanted = codes.select(F.col("code_insee").alias(column))
        return df.join(wanted, column, "left_semi")
    return df.where(F.col(column).isin([c.strip() for c in codes]))


def lower_names(df: DataFrame) -> DataFrame:
    """Column names in lower case."""
    return df.toDF(*[c.lower() for c in df.columns])


def scan_communes(zones: DataFrame) -> DataFrame:
    """Catalogue of the communes that have data."""
    return zones.select("code_insee", "unite_urbaine",
                        F.col("ogc_fid").cast("long").alias("id_zone"))


def resolve_areas(communes: DataFrame, field: str, values: Sequence[str],
                  key: str = "code_insee") -> DataFrame:
    """Communes (``code_insee``) or zones (``id_zone``) of the named areas.

    ``field`` is ``unite_urbaine`` or ``code_insee``, in any case.
    """
    name = "unite_urbaine" if field.strip().lower() == "unite_urbaine" else "code_insee"
    return communes.where(F.col(name).isin([v.strip() for v in values])).select(key)


def prepare_usr(usr: DataFrame, codes: Codes = None) -> DataFrame:
    """Urban units with their area."""
    usr = in_codes(usr, "code_insee", codes)
    return usr.select(
        F.col("pk").cast("long").alias("pk"), "the_geom", F.col("idzone").cast("long").alias("id_zone"), "code_insee",
        *[F.col(c).cast("double").alias(c)
          for c in ("vegetation_surface", "route_surface", "hydro_surface")],
        G.area(F.col("the_geom")).alias("usr_area"),
        *[F.col(c).cast("double").alias(c) for c in USR_FIGURES])


def fixed_height(height: Column, p: Params = Params()) -> Column:
    return F.when(height.isNull() | (height == 0), F.lit(p.default_height)).otherwise(height)


def fixed_levels(levels: Column, p: Params = Params()) -> Column:
    """0 becomes the default; an unknown number stays unknown."""
    return F.when(levels == 0, F.lit(p.default_levels)).otherwise(levels)


def prepare_buildings(bati: DataFrame, zones: DataFrame, codes: Codes = None, p: Params = Params(),
                      require_usr: bool = True) -> DataFrame:
    """Single-part, non-empty buildings of known communes, normalised, with basic measures.

    ``hull`` keeps the convex hull measures, so later steps need no second pass over shapes.
    """
    known = in_codes(zones.select(F.col("ogc_fid").alias("idzone"), "code_insee"), "code_insee", codes)
    geom = F.col("the_geom")
    if codes is not None:  # a bounded list of zones reaches the scan of the outlines
        wanted = listed(known.select(F.col("idzone").alias("id_zone")))
        bati = bati if isinstance(wanted, DataFrame) else of_zones(bati, wanted, "idzone")
    rows = bati.where((G.num_geometries(geom) == 1) & ~G.is_empty(geom))
    if require_usr:
        rows = rows.where(F.col("idilot").isNotNull())
    rows = rows.join(known.select("idzone"), "idzone")
    hull_of = F.col("hull")
    # the generator keeps the lambda functions of normalize out of the kernels' arguments,
    # where the optimizer would inline them but cannot evaluate them
    plain = [c for c in rows.columns if c != "the_geom"]
    return (rows
            .select(*plain, F.explode(F.array(G.normalize(geom))).alias("the_geom"))
            .withColumn("hull", hull(F.col("the_geom")))
            .select(
                "the_geom",
                F.col("hauteur").cast("double").alias("hauteur_origin"),
                F.col("idzone").cast("long").alias("id_zone"),
                F.col("idilot").cast("long").alias("pk_usr"),
                F.col("pk").cast("long").alias("pk"),
                fixed_levels(F.col("nb_niv").cast("int"), p).alias("nb_niv"),
                fixed_height(F.col("hauteur_corrigee").cast("double"), p).alias("hauteur"),
                G.area(geom).alias("area"),
                G.perimeter(geom).alias("perimeter"),
                F.round(hull_of["perimeter"], 3).alias("l_cvx"),
                F.col("insee_individus").cast("double").alias("insee_individus"),
                "theme", "pai_bdtopo", "pai_nature", "hull"))


def prepare_roads(roads: DataFrame, zones: DataFrame, codes: Codes = None) -> DataFrame:
    """Roads once per commune they run in; a border road belongs to both sides."""
    communes = in_codes(zones.select("code_insee", F.col("ogc_fid").cast("long").alias("id_zone")),
                        "code_insee", codes)
    if codes is not None and not isinstance(codes, DataFrame):
        wanted = [c.strip() for c in codes]
        roads = roads.where(F.col("inseecom_g").isin(wanted) | F.col("inseecom_d").isin(wanted))
    sides = F.array_distinct(F.array("inseecom_g", "inseecom_d"))
    return (roads
            .select(F.col("pk").cast("long").alias("pk"), "the_geom",
                    F.col("largeur").cast("double").alias("largeur"), "inseecom_g", "inseecom_d",
                    F.explode(sides).alias("code_insee"))
            .join(communes, "code_insee")
            .drop("code_insee"))


def commune_outline(zones: DataFrame, codes: Codes = None) -> DataFrame:
    """One outline per commune code: that of the lowest zone number."""
    zones = in_codes(zones, "code_insee", codes)
    row = F.struct("unite_urbaine", "the_geom", F.col("ogc_fid").cast("long").alias("id_zone"))
    return (zones.groupBy("code_insee").agg(F.min_by(row, "ogc_fid").alias("row"))
            .select("code_insee", "row.*"))


def prepare_iris(iris: DataFrame, codes: Codes = None) -> DataFrame:
    return in_codes(iris, "depcom", codes)


def processable_communes(communes: DataFrame, buildings: DataFrame) -> DataFrame:
    """Communes with at least one prepared building. Zones are reduced before the shuffle."""
    return communes.join(buildings.select("id_zone").distinct(), "id_zone", "left_semi")


def skipped_communes(communes: DataFrame, buildings: DataFrame) -> DataFrame:
    """Communes left out of a run, since they have no prepared building."""
    return communes.join(buildings.select("id_zone").distinct(), "id_zone", "left_anti")
