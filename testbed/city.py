"""A city of rectangles derived from the ``part`` table.

Twenty building slots form an urban unit, ten units a commune. A footprint fills its slot's
width or height for some sizes and then touches the next one. All coordinates are whole
numbers, so sums are exact. The SQL below runs unchanged in Spark and in the checking engine;
``{part}`` stands for the part table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from townform.functions import geometry as G
from townform.plans.chain import Inputs
from townform.schemas import TYPOLOGIES

BUILDINGS_SQL = """
SELECT pk, pk_usr, id_zone, CAST(10000 + id_zone AS VARCHAR(10)) AS code_insee,
  CAST(x0 AS DOUBLE) AS x0, CAST(y0 AS DOUBLE) AS y0,
  CAST(x0 + w AS DOUBLE) AS x1, CAST(y0 + h AS DOUBLE) AS y1,
  CASE WHEN p_size % 7 = 1 THEN NULL ELSE CAST((p_size % 7) * 3 AS DOUBLE) END AS hauteur_corrigee,
  CAST(p_size % 13 AS DOUBLE) AS hauteur, p_size % 4 AS nb_niv,
  CASE WHEN pk % 9 = 0 THEN NULL ELSE CAST(pk % 30 AS DOUBLE) END AS insee_individus,
  p_type AS theme, CASE WHEN pk % 9 = 0 THEN NULL ELSE CAST(pk % 4 AS VARCHAR(10)) END AS pai_bdtopo,
  CASE WHEN pk % 9 = 0 THEN NULL ELSE CAST(pk % 6 AS VARCHAR(10)) END AS pai_nature,
  p_size, slot_c, slot_r
FROM (SELECT *, CAST(FLOOR(pk_usr / 10.0) AS INT) AS id_zone, (pk_usr % 10) * 60 + 5 + slot_c * 10 AS x0,
        CAST(FLOOR(pk_usr / 10.0) AS INT) * 50 + 5 + slot_r * 10 AS y0,
        CASE WHEN p_size % 3 = 0 THEN 10 ELSE 6 + p_size % 4 END AS w,
        CASE WHEN p_size % 5 = 0 THEN 10 ELSE 5 + p_size % 5 END AS h
      FROM (SELECT CAST(p_partkey AS INT) AS pk, p_size, p_type, CAST(FLOOR(p_partkey / 20.0) AS INT) AS pk_usr,
              CAST(p_partkey % 5 AS INT) AS slot_c, CAST(FLOOR((p_partkey % 20) / 5.0) AS INT) AS slot_r
            FROM {part}) s) t
"""

USR_SQL = """
SELECT pk_usr AS pk, id_zone, code_insee,
  CAST((pk_usr % 10) * 60 AS DOUBLE) AS x0, CAST(id_zone * 50 AS DOUBLE) AS y0,
  CAST((pk_usr % 10) * 60 + 60 AS DOUBLE) AS x1, CAST(id_zone * 50 + 50 AS DOUBLE) AS y1,
  CAST((pk_usr * 37) % 1500 AS DOUBLE) AS vegetation_surface,
  CAST((pk_usr * 7) % 600 AS DOUBLE) AS route_surface,
  CASE WHEN pk_usr % 11 = 0 THEN NULL ELSE CAST((pk_usr * 13) % 400 AS DOUBLE) END AS hydro_surface,
  CASE WHEN pk_usr % 9 = 0 THEN NULL ELSE CAST(pk_usr % 70 AS DOUBLE) END AS insee_individus,
  CASE WHEN pk_usr % 9 = 0 THEN NULL ELSE CAST(pk_usr % 30 AS DOUBLE) END AS insee_menages,
  CASE WHEN pk_usr % 9 = 0 THEN NULL ELSE CAST(pk_usr % 20 AS DOUBLE) END AS insee_men_coll,
  CASE WHEN pk_usr % 9 = 0 THEN NULL ELSE CAST(pk_usr % 900 AS DOUBLE) END AS insee_men_surf,
  CASE WHEN pk_usr % 9 = 0 THEN NULL ELSE CAST(pk_usr % 600 AS DOUBLE) END AS insee_surface_collectif,
  CASE WHEN pk_usr % 9 = 0 THEN NULL ELSE CAST(pk_usr % 220 AS DOUBLE) END AS route_longueur,
  CASE WHEN pk_usr % 9 = 0 THEN NULL ELSE CAST(pk_usr % 180 AS DOUBLE) END AS trottoir_longueur
FROM (SELECT DISTINCT pk_usr, id_zone, code_insee FROM f_buildings) s
"""

COMMUNES_SQL = """
SELECT DISTINCT id_zone, code_insee, CONCAT('UU_', CAST(id_zone % 5 AS VARCHAR(5))) AS unite_urbaine,
  0.0E0 AS x0, CAST(id_zone * 50 AS DOUBLE) AS y0, 600.0E0 AS x1, CAST(id_zone * 50 + 50 AS DOUBLE) AS y1
FROM f_buildings
"""

# Checking engine only; the Spark side builds the same rows with ``explode``.
IRIS_SQL = """
SELECT id_zone, code_insee AS depcom, CONCAT(code_insee, CAST(1000 + j AS VARCHAR(4))) AS dcomiris,
  id_zone * 4 + j AS pk, CAST(j * 155 AS DOUBLE) AS x0, y0, CAST(j * 155 + 155 AS DOUBLE) AS x1, y1
FROM f_communes CROSS JOIN (SELECT 0 AS j UNION ALL SELECT 1 UNION ALL SELECT 2 UNION ALL SELECT 3) k
WHERE id_zone % 10 <> 9
"""

ROADS_SQL = """
SELECT id_zone AS pk, 'H' AS dir, CAST(2 + id_zone % 4 AS DOUBLE) AS largeur, code_insee AS inseecom_g,
  CAST(10000 + id_zone - 1 AS VARCHAR(10)) AS inseecom_d, -20.0E0 AS x1, y0 AS y1, 620.0E0 AS x2, y0 AS y2
FROM f_communes
UNION ALL
SELECT 100000 + id_zone * 11 + g, 'V', CAST(2 + g % 3 AS DOUBLE), code_insee, code_insee,
  CAST(g * 60 AS DOUBLE), y0 - 20, CAST(g * 60 AS DOUBLE), y1 + 20
FROM f_communes CROSS JOIN (SELECT DISTINCT CAST(p_partkey % 11 AS INT) AS g FROM {part}) k
"""

# Forests of the test city: one tree of four levels for every 31 parts. Predictors with a usual value.
SPLITS = {"i_area": 60, "i_h": 9, "i_levels": 2, "i_vol": 500, "i_floor": 90, "i_nb_nei": 1, "u_nb_build": 20, "b_area": 150,
          "i_inhab": 15, "u_floor": 1500}


def _case(of: str, values) -> str:
    return f"CASE {of} " + " ".join(f"WHEN {k} THEN {v}" for k, v in enumerate(values)) + " END"


FOREST_SQL = f"""
SELECT tree, node, CASE WHEN node < 16 THEN {_case('k', [f"'{v}'" for v in SPLITS])} END AS variable,
  CASE WHEN node < 16 THEN CAST({_case('k', SPLITS.values())} AS DOUBLE) * (25 + p_size) / 50.0E0 END AS split,
  CASE WHEN node < 16 THEN 2 * node END AS below, CASE WHEN node < 16 THEN 2 * node + 1 END AS above,
  CASE WHEN node >= 16 THEN {_case('p_size % 10', [f"'{t}'" for t in TYPOLOGIES])} END AS typo
FROM (SELECT CAST(FLOOR(p_partkey / 31.0) AS INT) AS tree, CAST(p_partkey % 31 + 1 AS BIGINT) AS node,
        (p_partkey * 7 + p_size) % 10 AS k, p_size FROM {{part}}) n
WHERE tree < (SELECT FLOOR(COUNT(*) / 31.0) FROM {{part}})
"""

EXTRA_ZONE = 1_000_000  # communes listed a second time, under another number
REJECT = 10_000_000     # source rows that preparation must drop

IRIS_COUNTS = ("m_49_74", "m_75_89", "m_90_04", "a_49_74", "a_75_89", "a_90_04", "m_a1946",
               "a_a1946", "m_46_49", "a_46_49", "m_05_08", "a_05_08", "m_09_11", "a_09_11")


def buildings_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(BUILDINGS_SQL, part=spark.read.parquet(f"{sf_dir}/part.parquet"))


def forest_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A forest as a table of nodes."""
    rows = spark.sql(FOREST_SQL, part=spark.read.parquet(f"{sf_dir}/part.parquet"))
    return rows.withColumnsRenamed({"below": "left", "above": "right", "typo": "class"})


def _box(df: DataFrame, srid: int = 2154) -> DataFrame:
    corners = [F.col(c) for c in ("x0", "y0", "x1", "y1")]
    return df.withColumn("the_geom", G.rectangle(*corners, srid=srid)).drop("x0", "y0", "x1", "y1")


def _bati(rows: DataFrame) -> DataFrame:
    """Source buildings, with some rows that preparation must drop: in two parts, empty, or
    without unit (the last kept on request)."""
    x0, y0, x1, y1 = (F.col(c) for c in ("x0", "y0", "x1", "y1"))
    # counter-clockwise and started elsewhere: preparation has to normalise
    plain = G.geometry(G.ring(F.array(G.point(x1, y0), G.point(x1, y1), G.point(x0, y1),
                                      G.point(x0, y0), G.point(x1, y0))), srid=0)
    two = G.geometry(G.rectangle_ring(x0, y0, x1, y1), G.rectangle_ring(x0 + 1000, y0, x1 + 1000, y1, part=1),
                     srid=0)
    empty = F.struct(F.lit(0).alias("srid"), F.array().cast("array<" + G.RING.simpleString() + ">").alias("rings"))
    kind = F.col("kind")
    kinds = F.when(F.col("pk") % 50 < 3, F.array(F.lit(-1), (F.col("pk") % 50).cast("int"))).otherwise(
        F.array(F.lit(-1)))
    return (rows.withColumn("kind", F.explode(kinds))
            .select(
                F.col("id_zone").alias("idzone"),
                F.when(kind == 0, two).when(kind == 1, empty).otherwise(plain).alias("the_geom"),
                "hauteur", F.when(kind == 2, F.lit(None)).otherwise(F.col("pk_usr")).alias("idilot"),
                F.when(kind < 0, F.col("pk")).otherwise(F.col("pk") + REJECT).alias("pk"),
                "nb_niv", "hauteur_corrigee", "insee_individus", "theme", "pai_bdtopo", "pai_nature"))


def city(spark: SparkSession, sf_dir: str) -> Inputs:
    """Source tables of the test city."""
    rows = buildings_table(spark, sf_dir)
    usr = spark.sql(USR_SQL.replace("f_buildings", "{b}"), b=rows)
    communes = spark.sql(COMMUNES_SQL.replace("f_buildings", "{b}"), b=rows)
    iris = _box(
        communes.where("id_zone % 10 <> 9")
        .withColumn("j", F.explode(F.array(*[F.lit(j) for j in range(4)])))
        .select("id_zone", F.col("code_insee").alias("depcom"),
                F.concat("code_insee", (1000 + F.col("j")).cast("string")).alias("dcomiris"),
                (F.col("id_zone") * 4 + F.col("j")).alias("pk"), F.lit("IRIS").alias("nom_com"),
                *[(F.col("id_zone") % (k + 2)).cast("double" if k < 9 else "int").alias(c)
                  for k, c in enumerate(IRIS_COUNTS)],
                (F.col("j") * 155).cast("double").alias("x0"), "y0",
                (F.col("j") * 155 + 155).cast("double").alias("x1"), "y1"))
    border = communes.select(
        F.col("id_zone").alias("pk"), (2 + F.col("id_zone") % 4).cast("double").alias("largeur"),
        F.col("code_insee").alias("inseecom_g"),
        (9999 + F.col("id_zone")).cast("string").alias("inseecom_d"),
        G.line(F.lit(-20), F.col("y0"), F.lit(620), F.col("y0")).alias("the_geom"))
    across = (communes.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(10))))
              .select((100000 + F.col("id_zone") * 11 + F.col("g")).alias("pk"),
                      (2 + F.col("g") % 3).cast("double").alias("largeur"),
                      F.col("code_insee").alias("inseecom_g"), F.col("code_insee").alias("inseecom_d"),
                      G.line(F.col("g") * 60, F.col("y0") - 20, F.col("g") * 60, F.col("y1") + 20).alias("the_geom")))
    # the part table is one file; a real source has many, read by as many tasks
    spread = rows.repartition(spark.sparkContext.defaultParallelism)
    return Inputs(
        zones=_box(communes).withColumnRenamed("id_zone", "ogc_fid"),
        usr=_box(usr).withColumnRenamed("id_zone", "idzone"),
        bati=_bati(spread),
        roads=border.unionByName(across),
        iris=iris)
