"""One query per operator over the test city, with the SQL that checks it.

A query gives keys as whole numbers, measures rounded to six digits, and texts; geometry
stays inside the jobs. The check selects the same columns from its own tables.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from testbed import oracles as O
from testbed.city import EXTRA_ZONE, IRIS_COUNTS, city, forest_table
from townform.functions import geometry as G
from townform.operators import courtyards as C
from townform.operators import distances as D
from townform.operators import neighbours as N
from townform.operators import outlines as L
from townform.operators import roads as R
from townform.operators.overlap import max_overlap
from townform.params import Params
from townform.plans import blocks as B
from townform.plans import buildings as BB
from townform.plans import chain
from townform.plans import typology as Y
from townform.plans import usr as U
from townform.plans.forest import classify_from_nodes
from townform.schemas import BUILDING_COLUMNS, FINAL_TABLES, MEANING, TYPOLOGIES, USR_COLUMNS, typo_label
from townform.session import Stages, checkpoint_dir, cut_lineage
from townform.sources import computed as M
from townform.sources import inputs as I
from townform.sources.results import final_counts, read_final, write_final, write_tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
P = Params()


def query(name: str, keys: str, numbers: str = "", texts: str = "", oracle: str | None = None,
          needs: str = ""):
    """Register a query. ``oracle`` is the SQL source its columns are selected from."""
    keys, numbers, texts = keys.split(), numbers.split(), texts.split()

    def add(run):
        def emit(spark: SparkSession, sf_dir: str) -> DataFrame:
            return run(spark, sf_dir).select(
                *[F.col(c).cast("bigint").alias(c) for c in keys],
                *[F.round(F.col(c).cast("double"), 6).alias(c) for c in numbers],
                *[F.col(c).cast("string").alias(c) for c in texts])

        emit.__name__ = name
        QUERIES[name] = emit
        if oracle is not None:
            columns = ([f"CAST({c} AS BIGINT) AS {c}" for c in keys]
                       + [f"{O.rnd(c)} AS {c}" for c in numbers] + texts)
            ORACLES[name] = O.check(f"SELECT {', '.join(columns)} FROM {oracle}", *needs.split())
        return run

    return add


# --- inputs shared by the queries ------------------------------------------------------

def buildings(spark, sf_dir):
    c = city(spark, sf_dir)
    return I.prepare_buildings(c.bati, c.zones)


def shapes(spark, sf_dir):
    return BB.shape_columns(buildings(spark, sf_dir))


def pairs(spark, sf_dir):
    return N.close_pairs(buildings(spark, sf_dir))


def with_blocks(spark, sf_dir):
    b = buildings(spark, sf_dir)
    close = cut_lineage(N.close_pairs(b))
    return b, close, B.block_members(b, close)


def walled(spark, sf_dir):
    """Buildings with shape, contiguity and block, as the block aggregates need them."""
    b, close, members = with_blocks(spark, sf_dir)
    rows = BB.net_compacity(BB.with_contiguity(BB.shape_columns(b), N.contiguity(close)))
    return rows.join(members.select("id_zone", "pk", "pk_block"), ["id_zone", "pk"])


def everything(spark, sf_dir):
    return chain.compute(city(spark, sf_dir))


# --- sources ---------------------------------------------------------------------------

@query("scan_communes", "id_zone", "", "code_insee unite_urbaine", "f_communes", "f_communes")
def _(spark, sf_dir):
    return I.scan_communes(city(spark, sf_dir).zones)


@query("resolve_areas", "id_zone", oracle="f_communes WHERE unite_urbaine IN ('UU_1', 'UU_3')", needs="f_communes")
def _(spark, sf_dir):
    communes = I.scan_communes(city(spark, sf_dir).zones)
    return I.resolve_areas(communes, "Unite_Urbaine", ["UU_1 ", "UU_3"], key="id_zone")


@query("prepare_usr", "pk id_zone", "usr_area x0 y0 vegetation_surface route_surface hydro_surface "
       "insee_individus insee_menages insee_men_coll insee_men_surf insee_surface_collectif "
       "route_longueur trottoir_longueur", oracle="(SELECT *, (x1 - x0) * (y1 - y0) AS usr_area FROM f_usr) u",
       needs="f_usr")
def _(spark, sf_dir):
    start = G.start_point(F.col("the_geom"))
    return I.prepare_usr(city(spark, sf_dir).usr).withColumns({"x0": start["x"], "y0": start["y"]})


@query("prepare_buildings", "pk pk_usr id_zone nb_niv", "hauteur_origin hauteur area perimeter l_cvx "
       "insee_individus x0 y0", "theme pai_bdtopo pai_nature",
       "(SELECT *, perimeter AS l_cvx FROM b) p", "b")
def _(spark, sf_dir):
    start = G.start_point(F.col("the_geom"))
    return buildings(spark, sf_dir).withColumns({"x0": start["x"], "y0": start["y"]})


@query("prepare_buildings_of_codes", "pk id_zone", "area", "",
       "b WHERE code_insee IN (SELECT code_insee FROM f_communes WHERE unite_urbaine = 'UU_0')", "b f_communes")
def _(spark, sf_dir):
    c = city(spark, sf_dir)
    codes = I.resolve_areas(I.scan_communes(c.zones), "unite_urbaine", ["UU_0"])
    return I.prepare_buildings(c.bati, c.zones, codes)


@query("prepare_roads", "pk id_zone", "largeur len", "",
       "(SELECT DISTINCT r.pk, c.id_zone, r.largeur, (r.x2 - r.x1) + (r.y2 - r.y1) AS len FROM f_roads r "
       "JOIN f_communes c ON c.code_insee = r.inseecom_g OR c.code_insee = r.inseecom_d) r", "f_roads f_communes")
def _(spark, sf_dir):
    c = city(spark, sf_dir)
    return I.prepare_roads(c.roads, c.zones).withColumn("len", G.length(F.col("the_geom")))


@query("commune_outline", "id_zone", "area", "code_insee unite_urbaine",
       "(SELECT *, (x1 - x0) * (y1 - y0) AS area FROM f_communes) c", "f_communes")
def _(spark, sf_dir):
    zones = city(spark, sf_dir).zones
    again = zones.withColumn("ogc_fid", F.col("ogc_fid") + EXTRA_ZONE).withColumn(
        "the_geom", G.rectangle(F.lit(0), F.lit(0), F.lit(1), F.lit(1)))
    return I.commune_outline(again.unionByName(zones)).withColumn("area", G.area(F.col("the_geom")))


@query("prepare_iris", "pk id_zone", "area", "depcom dcomiris",
       "(SELECT *, (x1 - x0) * (y1 - y0) AS area FROM f_iris) i", "f_iris")
def _(spark, sf_dir):
    c = city(spark, sf_dir)
    codes = I.scan_communes(c.zones).select("code_insee")
    return I.prepare_iris(c.iris, codes).withColumn("area", G.area(F.col("the_geom")))


def _with_empty_communes(spark, sf_dir):
    """Catalogue in which every commune has a second entry that no building names."""
    c = city(spark, sf_dir)
    again = c.zones.withColumn("ogc_fid", F.col("ogc_fid") + EXTRA_ZONE)
    return I.scan_communes(c.zones.unionByName(again)), I.prepare_buildings(c.bati, c.zones)


@query("processable_communes", "id_zone", "", "code_insee", "f_communes", "f_communes")
def _(spark, sf_dir):
    return I.processable_communes(*_with_empty_communes(spark, sf_dir))


@query("skipped_communes", "id_zone", "", "code_insee",
       f"(SELECT id_zone + {EXTRA_ZONE} AS id_zone, code_insee FROM f_communes) c", "f_communes")
def _(spark, sf_dir):
    return I.skipped_communes(*_with_empty_communes(spark, sf_dir))


@query("typo_label", "pk_building id_zone", "", "typo label",
       f"(SELECT r.*, l.label FROM rule_typo r JOIN (VALUES {O.LABEL_VALUES}) l(typo, label) ON r.typo = l.typo) t",
       "rule_typo")
def _(spark, sf_dir):
    return Y.with_labels(rule_typo(spark, sf_dir), typo_label(spark))


# documented tables and the check's tables with the same columns; keys and outlines are never unknown
DOCUMENTED = {"final_building_indicators": "bi", "final_block_indicators": "ki", "final_usr_indicators": "ui"}


def _known(table: str, column: str) -> str:
    return "*" if column == "the_geom" or column == FINAL_TABLES[table][0] else column


@query("column_dictionary", "known", "", "table_name column_name comment",
       "(" + " UNION ALL ".join(
           "SELECT '{}' AS table_name, '{}' AS column_name, '{}' AS comment, COUNT({}) AS known FROM {}".format(
               t, c, MEANING[t][c].replace("'", "''"), _known(t, c), DOCUMENTED[t])
           for t in DOCUMENTED for c in FINAL_TABLES[t]) + ") d", "bi ki ui")
def _(spark, sf_dir):
    """All columns of the three tables of indicators with the comments stored in them, and how many values are known."""
    folder = _result_folder(spark)
    with Stages(spark) as stage:
        r = chain.compute(city(spark, sf_dir), stage=stage)
        write_tables({"final_building_indicators": r.building_indicators, "final_block_indicators": r.block_indicators,
                      "final_usr_indicators": r.usr_indicators}, folder)
    rows = []
    for table in DOCUMENTED:
        notes = {f.name: f.metadata.get("comment") for f in spark.read.parquet(f"{folder}/{table}").schema}
        final = read_final(spark, folder, table)
        notes["id_zone"] = final.schema["id_zone"].metadata["comment"]  # names the folders, so no file has it
        counts = final.agg(*[F.count(c).alias(c) for c in final.columns])
        rows.append(counts.select(F.inline(F.array(*[
            F.struct(F.lit(table).alias("table_name"), F.lit(c).alias("column_name"), F.lit(notes[c]).alias("comment"), F.col(c).alias("known"))
            for c in final.columns]))))
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


# --- building indicators ---------------------------------------------------------------

def _shape_query(name, numbers, step=BB.shape_columns):
    @query(name, "pk id_zone", numbers, oracle="shape", needs="shape")
    def _(spark, sf_dir):
        return step(buildings(spark, sf_dir))


_shape_query("building_area_volume", "floor_area vol", BB.floor_area_and_volume)
_shape_query("building_form_factor", "form_factor", BB.form_factor)
_shape_query("building_concavity", "concavity", BB.concavity)
_shape_query("building_compactness", "compactness", BB.compactness)
_shape_query("building_main_dir", "main_dir_deg", BB.main_direction)
_shape_query("building_fractal", "fractal_dim", BB.fractal_dimension)
_shape_query("building_num_points", "num_points", BB.distinct_points)


@query("building_compacity", "pk id_zone", "compacity_r compacity_n", oracle="walls", needs="walls")
def _(spark, sf_dir):
    b = buildings(spark, sf_dir)
    rows = BB.with_contiguity(BB.raw_compacity(b), N.contiguity(N.close_pairs(b)))
    return BB.net_compacity(rows)


@query("touching_buildings", "id_zone pk neighbour", oracle="touch", needs="touch")
def _(spark, sf_dir):
    return N.both_ways(N.touching(pairs(spark, sf_dir)))


@query("near_neighbours", "id_zone pk neighbour", "dist", oracle="(SELECT *, 0 AS dist FROM touch) t", needs="touch")
def _(spark, sf_dir):
    return N.both_ways(N.near(pairs(spark, sf_dir)), dist=("dist", "dist"))


@query("party_walls", "id_zone pk neighbour", "p_wall_long p_wall_area",
       oracle="(SELECT *, len AS p_wall_long, low * len AS p_wall_area FROM touch) t", needs="touch")
def _(spark, sf_dir):
    return N.party_walls(pairs(spark, sf_dir))


@query("contiguity", "id_zone pk nb_neighbor", "b_floor_long b_wall_area p_wall_long p_wall_area "
       "free_p_wall_long free_ext_area contiguity", oracle="walls", needs="walls")
def _(spark, sf_dir):
    b = buildings(spark, sf_dir)
    return BB.with_contiguity(b, N.contiguity(N.close_pairs(b)))


@query("building_distances", "id_zone pk", "min_dist mean_dist max_dist std_dist", oracle="dist", needs="dist")
def _(spark, sf_dir):
    return D.building_distances(buildings(spark, sf_dir))


@query("near_roads", "id_zone pk wall", oracle="(SELECT id_zone, pk, CASE side WHEN 3 THEN 0 WHEN 2 THEN 1 "
       "WHEN 4 THEN 2 ELSE 3 END AS wall FROM wall_near WHERE whole > 0 OR parts > 0) w", needs="wall_near")
def _(spark, sf_dir):
    """Walls with a part near some road."""
    c = city(spark, sf_dir)
    close = R.near_roads(I.prepare_buildings(c.bati, c.zones), I.prepare_roads(c.roads, c.zones))
    return R.near_intervals(close).select("id_zone", "pk", "wall").distinct()


@query("walls_near_roads", "id_zone pk", "l_3m l_tot l_ratio l_ratio_cvx", oracle="bi", needs="bi")
def _(spark, sf_dir):
    c = city(spark, sf_dir)
    b = I.prepare_buildings(c.bati, c.zones)
    return BB.road_columns(b, R.walls_near_roads(b, I.prepare_roads(c.roads, c.zones)))


@query("passive_volume", "id_zone pk", "p_vol_ratio", oracle="passive", needs="passive")
def _(spark, sf_dir):
    b = buildings(spark, sf_dir)
    return BB.passive_volume(b, N.hidden_spans(N.close_pairs(b)))


@query("passive_volume_x3", "id_zone pk", "p_vol_ratio",
       oracle="(SELECT s.id_zone, s.pk, " + O.rnd(
           "LEAST(1, 1 - GREATEST(w * 3 - 12.01, 0) * GREATEST(h * 3 - 12.01, 0) / (w * h * 9))", 2)
       + " AS p_vol_ratio FROM b s ANTI JOIN contig c ON s.id_zone = c.id_zone AND s.pk = c.pk) s", needs="b contig")
def _(spark, sf_dir):
    """Lone buildings at three times the size, so that a dark core is left."""
    c = city(spark, sf_dir)
    large = c.bati.withColumn("the_geom", F.struct(
        F.col("the_geom.srid").alias("srid"), F.transform("the_geom.rings", lambda r: F.struct(
            r["part"].alias("part"), r["hole"].alias("hole"),
            F.transform(r["pts"], lambda q: F.struct((q["x"] * 3).alias("x"), (q["y"] * 3).alias("y"))).alias("pts")))
        .alias("rings")))
    b = I.prepare_buildings(large, c.zones)
    close = N.close_pairs(b)
    lone = b.join(N.contiguity(close).select("id_zone", "pk"), ["id_zone", "pk"], "left_anti")
    return BB.passive_volume(lone, N.hidden_spans(close))


BUILDING_NUMBERS = " ".join(c for c in BUILDING_COLUMNS if c not in (
    "pk", "pk_usr", "id_zone", "pk_block", "the_geom", "theme", "pai_bdtopo", "pai_nature", "nb_neighbor"))


@query("building_indicators", "pk pk_usr id_zone pk_block nb_neighbor", BUILDING_NUMBERS,
       "theme pai_bdtopo pai_nature", "bi", "bi")
def _(spark, sf_dir):
    c = city(spark, sf_dir)
    b, close, members = with_blocks(spark, sf_dir)
    return BB.building_indicators(b, I.prepare_roads(c.roads, c.zones), close, members)


# --- blocks ----------------------------------------------------------------------------

@query("block_edges", "id_zone pk_usr pk_a pk_b", oracle="(SELECT id_zone, pk_usr, pk AS pk_a, neighbour AS pk_b "
       "FROM touch WHERE pk < neighbour AND same_unit) e", needs="touch")
def _(spark, sf_dir):
    return B.block_edges(pairs(spark, sf_dir))


@query("blocks", "id_zone pk_usr pk_block members", oracle="(SELECT id_zone, pk_usr, pk_block, COUNT(*) AS members "
       "FROM members GROUP BY ALL) m", needs="members")
def _(spark, sf_dir):
    return B.blocks(with_blocks(spark, sf_dir)[2])


@query("building_block", "id_zone pk pk_block", oracle="members", needs="members")
def _(spark, sf_dir):
    return with_blocks(spark, sf_dir)[2]


@query("block_area_vol", "id_zone pk_usr pk_block", "area floor_area vol", oracle="ki", needs="ki")
def _(spark, sf_dir):
    return B.area_and_volume(walled(spark, sf_dir))


@query("block_height", "id_zone pk_usr pk_block", "h_mean h_std", oracle="ki", needs="ki")
def _(spark, sf_dir):
    return B.heights(walled(spark, sf_dir))


@query("block_compacity", "id_zone pk_usr pk_block", "compacity", oracle="ki", needs="ki")
def _(spark, sf_dir):
    return B.compacity(walled(spark, sf_dir))


@query("block_courtyard", "id_zone pk_usr pk_block", "holes_area holes_percent", oracle="courtyard", needs="courtyard")
def _(spark, sf_dir):
    b, close, members = with_blocks(spark, sf_dir)
    return C.courtyards(b, members, close)


@query("block_outline", "id_zone pk_usr pk_block hole breaks", "signed_area length", oracle="outline", needs="outline")
def _(spark, sf_dir):
    """Outlines of all blocks, summed up by shells and courtyards, with the places where walls do not follow."""
    b, close, members = with_blocks(spark, sf_dir)
    walls = cut_lineage(L.block_outlines(b, members, close))
    breaks = L.ring_breaks(walls).groupBy("id_zone", "pk_block", "hole").agg(F.count("*").alias("breaks"))
    sums = L.ring_measures(walls).groupBy("id_zone", "pk_usr", "pk_block", "hole").agg(
        F.sum("signed_area").alias("signed_area"), F.sum("length").alias("length"))
    return sums.join(breaks, ["id_zone", "pk_block", "hole"], "left").fillna(0, ["breaks"])


@query("block_main_dir", "id_zone pk_block", "main_dir_deg", oracle="block_dir", needs="block_dir")
def _(spark, sf_dir):
    b, _, members = with_blocks(spark, sf_dir)
    return B.block_main_dir(b, members)


@query("block_indicators", "id_zone pk_usr pk_block",
       "area floor_area vol h_mean h_std compacity holes_area holes_percent main_dir_deg", oracle="ki", needs="ki")
def _(spark, sf_dir):
    b, close, members = with_blocks(spark, sf_dir)
    rows = BB.net_compacity(BB.with_contiguity(BB.shape_columns(b), N.contiguity(close)))
    rows = cut_lineage(rows.join(members.select("id_zone", "pk", "pk_block"), ["id_zone", "pk"]))
    return B.block_indicators(rows, b, members, close)


# --- urban units -----------------------------------------------------------------------

@query("usr_building_stats", "id_zone pk_usr build_numb", " ".join(O.UB), oracle="ub", needs="ub")
def _(spark, sf_dir):
    c = city(spark, sf_dir)
    b, close, members = with_blocks(spark, sf_dir)
    return U.usr_building_stats(BB.building_indicators(b, I.prepare_roads(c.roads, c.zones), close, members))


@query("usr_floor_density", "id_zone pk_usr", "floor floor_ratio build_dens",
       oracle=f"(SELECT id_zone, pk_usr, {O.rnd('floors', 2)} AS floor, {O.rnd('floors / 3000', 2)} AS floor_ratio, "
       f"{O.rnd('built / 3000', 4)} AS build_dens FROM (SELECT id_zone, pk_usr, SUM(floor_area) AS floors, "
       "SUM(area) AS built FROM shape GROUP BY ALL) s) u", needs="shape")
def _(spark, sf_dir):
    c = city(spark, sf_dir)
    rows = BB.floor_area_and_volume(I.prepare_buildings(c.bati, c.zones))
    return U.usr_floor_density(I.prepare_usr(c.usr), rows)


@query("usr_densities", "id_zone pk_usr", "build_dens hydro_dens veget_dens road_dens",
       oracle=f"(SELECT u.id_zone, u.pk AS pk_usr, {O.rnd('s.built / 3000', 4)} AS build_dens, "
       f"{O.rnd('u.hydro_surface / 3000', 4)} AS hydro_dens, {O.rnd('u.vegetation_surface / 3000', 4)} AS veget_dens, "
       f"{O.rnd('u.route_surface / 3000', 4)} AS road_dens FROM f_usr u LEFT JOIN (SELECT id_zone, pk_usr, "
       "SUM(area) AS built FROM b GROUP BY ALL) s ON s.id_zone = u.id_zone AND s.pk_usr = u.pk) d", needs="b f_usr")
def _(spark, sf_dir):
    c = city(spark, sf_dir)
    rows = BB.floor_area_and_volume(I.prepare_buildings(c.bati, c.zones))
    return U.usr_densities(I.prepare_usr(c.usr), rows)


@query("usr_block_stats", "id_zone pk_usr", " ".join(O.UK), oracle="uk", needs="uk")
def _(spark, sf_dir):
    b, close, members = with_blocks(spark, sf_dir)
    rows = BB.net_compacity(BB.with_contiguity(BB.shape_columns(b), N.contiguity(close)))
    rows = cut_lineage(rows.join(members.select("id_zone", "pk", "pk_block"), ["id_zone", "pk"]))
    return U.usr_block_stats(B.block_indicators(rows, b, members, close))


@query("usr_dist_to_center", "id_zone pk_usr", "dist_to_center", oracle="center", needs="center")
def _(spark, sf_dir):
    c = city(spark, sf_dir)
    return U.usr_dist_to_center(I.prepare_usr(c.usr), I.commune_outline(c.zones))


@query("usr_iris", "id_zone pk_usr", "", "dcomiris", "best_iris", "best_iris")
def _(spark, sf_dir):
    c = city(spark, sf_dir)
    return U.usr_iris(I.prepare_usr(c.usr), I.prepare_iris(c.iris))


def _outlines(df, change):
    """The same rows with other points in their rings."""
    rings = F.transform("the_geom.rings", lambda r: r.withField("pts", change(r["pts"])))
    return df.withColumn("the_geom", F.col("the_geom").withField("rings", rings))


@query("usr_iris_reversed", "id_zone pk_usr", "", "dcomiris", "best_iris", "best_iris")
def _(spark, sf_dir):
    """Units and districts that run the other way round."""
    c = city(spark, sf_dir)
    return U.usr_iris(_outlines(I.prepare_usr(c.usr), F.reverse), _outlines(I.prepare_iris(c.iris), F.reverse))


@query("usr_iris_touching", "id_zone pk_usr", "", "dcomiris",
       """(SELECT id_zone, pk_usr, dcomiris FROM (
         SELECT u.id_zone, u.pk AS pk_usr, i.dcomiris, ROW_NUMBER() OVER (PARTITION BY u.id_zone, u.pk ORDER BY
           LEAST(u.x1, i.x1) - GREATEST(u.x0, i.x0) DESC, i.dcomiris) AS place
         FROM f_usr u LEFT JOIN f_iris i ON u.id_zone = i.id_zone AND u.x0 <= i.x1 AND i.x0 <= u.x1) s WHERE place = 1) s""",
       "f_usr f_iris")
def _(spark, sf_dir):
    """Districts just south of the units: the longer common border wins."""
    c = city(spark, sf_dir)
    south = lambda pts: F.transform(pts, lambda q: F.struct(q["x"].alias("x"), (q["y"] - 50).alias("y")))
    return U.usr_iris(I.prepare_usr(c.usr), _outlines(I.prepare_iris(c.iris), south))


@query("usr_dist_to_center_twice", "id_zone pk_usr", "dist_to_center", oracle="center", needs="center")
def _(spark, sf_dir):
    """The chain on a catalogue that lists every commune twice; the entry without data has the lower number."""
    c = city(spark, sf_dir)
    again = c.zones.withColumn("ogc_fid", -1 - F.col("ogc_fid"))
    r = chain.compute(replace(c, zones=again.unionByName(c.zones)))
    return r.usr_indicators.withColumnRenamed("pk", "pk_usr")


@query("building_iris", "id_zone pk", "", "dcomiris",
       """(SELECT id_zone, pk, dcomiris FROM (
         SELECT b.id_zone, b.pk, i.dcomiris, ROW_NUMBER() OVER (PARTITION BY b.id_zone, b.pk ORDER BY
           GREATEST(LEAST(b.x1, i.x1) - GREATEST(b.x0, i.x0), 0) * (b.y1 - b.y0) DESC, i.dcomiris) AS place
         FROM b LEFT JOIN f_iris i ON b.id_zone = i.id_zone AND b.x0 <= i.x1 AND i.x0 <= b.x1) s WHERE place = 1) s""",
       "b f_iris")
def _(spark, sf_dir):
    """Greatest overlap on the large side: the district of every building."""
    c = city(spark, sf_dir)
    return max_overlap(I.prepare_buildings(c.bati, c.zones), "pk", I.prepare_iris(c.iris), "dcomiris", size=100.0)


USR_NUMBERS = " ".join(c for c in USR_COLUMNS if c not in ("pk", "id_zone", "the_geom", "dcomiris", "build_numb"))


@query("usr_indicators", "pk id_zone build_numb", USR_NUMBERS, "dcomiris", "ui", "ui")
def _(spark, sf_dir):
    return everything(spark, sf_dir).usr_indicators


# --- typology --------------------------------------------------------------------------

def rule_typo(spark, sf_dir):
    """Typology by rule, where a check needs one without a forest."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    rule = F.element_at(F.array(*[F.lit(t) for t in TYPOLOGIES]), F.col("p_size") % 10 + 1)
    return part.select(F.floor(F.col("p_partkey") / 200).cast("int").alias("id_zone"),
                       F.col("p_partkey").cast("int").alias("pk_building"), rule.alias("typo"))


def floor_features(spark, sf_dir):
    """The columns of the feature table that the unit summary reads, and the rule's typology."""
    c = city(spark, sf_dir)
    b = BB.floor_area_and_volume(I.prepare_buildings(c.bati, c.zones))
    floors = b.groupBy("id_zone", "pk_usr").agg(F.sum("floor_area").alias("u_floor"))
    return (b.select("id_zone", "pk_usr", F.col("pk").alias("pk_building"), F.col("floor_area").alias("i_floor"))
            .join(floors, ["id_zone", "pk_usr"])
            .join(rule_typo(spark, sf_dir), ["id_zone", "pk_building"]))


@query("typology_features", "pk_building pk_usr id_zone", " ".join(Y.FEATURES), oracle="feat", needs="feat")
def _(spark, sf_dir):
    r = everything(spark, sf_dir)
    return Y.typology_features(r.building_indicators, r.block_indicators, r.usr_indicators)


@query("typo_buildings", "pk_building pk_usr id_zone", "area", "typo",
       "(SELECT b.pk AS pk_building, b.pk_usr, b.id_zone, b.area, r.typo FROM b JOIN rule_typo r "
       "ON b.id_zone = r.id_zone AND b.pk = r.pk_building) t", "b rule_typo")
def _(spark, sf_dir):
    rows = Y.typo_buildings(buildings(spark, sf_dir), rule_typo(spark, sf_dir))
    return rows.withColumn("area", G.area(F.col("the_geom")))


@query("typo_usr", "pk_usr id_zone", " ".join(TYPOLOGIES), "typo_maj typo_second", "typo_best", "typo_best")
def _(spark, sf_dir):
    return Y.typo_usr(I.prepare_usr(city(spark, sf_dir).usr), floor_features(spark, sf_dir))


@query("classify_buildings", "pk_building pk_usr id_zone", "", "typo")
def _(spark, sf_dir):
    """A small forest trained on the rule's labels, then applied to all buildings."""
    r = everything(spark, sf_dir)
    features = cut_lineage(Y.typology_features(r.building_indicators, r.block_indicators, r.usr_indicators))
    labelled = features.join(rule_typo(spark, sf_dir), ["id_zone", "pk_building"])
    return Y.classify_buildings(Y.train_typology(labelled, P, trees=10, depth=5), features)


@query("classify_from_nodes", "pk_building pk_usr id_zone", "", "typo", "node_typo", "node_typo")
def _(spark, sf_dir):
    """A forest that comes as a table of nodes, walked level by level."""
    r = everything(spark, sf_dir)
    features = cut_lineage(Y.typology_features(r.building_indicators, r.block_indicators, r.usr_indicators))
    return classify_from_nodes(features, forest_table(spark, sf_dir))


# --- results and import ------------------------------------------------------------------

def _result_folder(spark) -> str:
    return tempfile.mkdtemp(prefix="final-", dir=checkpoint_dir(spark)) if spark.sparkContext.master.startswith(
        "local") else f"{checkpoint_dir(spark)}/final-{spark.sparkContext.applicationId}"


@query("final_tables", "id_zone n", "", "table_name",
       "(SELECT 'final_building_indicators' AS table_name, id_zone, COUNT(*) AS n FROM b GROUP BY ALL "
       "UNION ALL SELECT 'final_block_indicators', id_zone, COUNT(DISTINCT pk_block) FROM members GROUP BY ALL "
       "UNION ALL SELECT 'final_usr_indicators', id_zone, COUNT(*) FROM f_usr GROUP BY ALL "
       "UNION ALL SELECT 'final_communes', id_zone, COUNT(*) FROM f_communes GROUP BY ALL "
       "UNION ALL SELECT 'final_iris', id_zone, COUNT(*) FROM f_iris GROUP BY ALL) t", "b members f_usr f_communes f_iris")
def _(spark, sf_dir):
    """The chain, its communes written twice (the second run replaces its zones), and all read back."""
    folder = _result_folder(spark)
    chain.run_chain(city(spark, sf_dir), folder)
    write_final(read_final(spark, folder, "final_communes"), folder, "final_communes")
    return final_counts(spark, folder, ("final_building_indicators", "final_block_indicators",
                                        "final_usr_indicators", "final_communes", "final_iris"))


@query("final_typologies", "pk_usr id_zone typed", " ".join(TYPOLOGIES), "typo_maj typo_second",
       "(SELECT t.*, c.typed FROM node_typo_best t JOIN (SELECT id_zone, pk_usr, COUNT(typo) AS typed FROM node_typo GROUP BY ALL) c "
       "ON c.id_zone = t.id_zone AND c.pk_usr = t.pk_usr) t", "node_typo_best node_typo")
def _(spark, sf_dir):
    """The chain with a forest: typologies of units, and how many buildings have one, read back from the final tables."""
    folder = _result_folder(spark)
    chain.run_chain(city(spark, sf_dir), folder, forest_table(spark, sf_dir))
    typed = read_final(spark, folder, "final_building_typo").groupBy("id_zone", "pk_usr").agg(F.count("typo").alias("typed"))
    return read_final(spark, folder, "final_usr_typo").join(typed, ["id_zone", "pk_usr"])


def _wanted(c):
    """Zones of two urban areas."""
    return I.resolve_areas(I.scan_communes(c.zones), "unite_urbaine", ["UU_0", "UU_2"], key="id_zone")


IN_WANTED = "id_zone % 5 IN (0, 2)"


@query("import_building_indicators", "pk_building pk_usr id_zone", "area vol form_factor shape_area",
       oracle=f"(SELECT *, pk AS pk_building, area AS shape_area FROM shape WHERE {IN_WANTED}) s", needs="shape")
def _(spark, sf_dir):
    c = city(spark, sf_dir)
    computed = BB.shape_columns(I.prepare_buildings(c.bati, c.zones)).withColumnRenamed("pk", "pk_building")
    rows = M.import_building_indicators(computed.drop("the_geom", "hull"), c.bati, _wanted(c))
    return rows.withColumn("shape_area", G.area(F.col("the_geom")))


@query("import_usr_indicators", "pk_usr id_zone", "floor floor_ratio build_dens shape_area",
       oracle=f"(SELECT id_zone, pk_usr, {O.rnd('floors', 2)} AS floor, {O.rnd('floors / 3000', 2)} AS floor_ratio, "
       f"{O.rnd('built / 3000', 4)} AS build_dens, 3000 AS shape_area FROM (SELECT id_zone, pk_usr, SUM(floor_area) AS floors, "
       f"SUM(area) AS built FROM shape WHERE {IN_WANTED} GROUP BY ALL) s) u", needs="shape")
def _(spark, sf_dir):
    c = city(spark, sf_dir)
    rows = BB.floor_area_and_volume(I.prepare_buildings(c.bati, c.zones))
    computed = U.usr_floor_density(I.prepare_usr(c.usr), rows)
    return M.import_usr_indicators(computed, c.usr, _wanted(c)).withColumn("shape_area", G.area(F.col("the_geom")))


@query("import_blocks", "pk_usr pk_block members", oracle="(SELECT pk_usr, pk_block, COUNT(*) AS members FROM members "
       f"WHERE {IN_WANTED} GROUP BY ALL) m", needs="members")
def _(spark, sf_dir):
    c = city(spark, sf_dir)
    computed = B.blocks(with_blocks(spark, sf_dir)[2])
    units = I.prepare_usr(c.usr).withColumnRenamed("pk", "pk_usr")
    return M.import_blocks(computed, units, _wanted(c))


@query("import_block_outlines", "id_zone pk_usr pk_block hole", "signed_area length",
       oracle=f"(SELECT * FROM outline WHERE {IN_WANTED}) o", needs="outline")
def _(spark, sf_dir):
    """Outlines as the chain stores them, of the wanted zones only."""
    c = city(spark, sf_dir)
    b, close, members = with_blocks(spark, sf_dir)
    folder = _result_folder(spark)
    write_final(L.block_outlines(b, members, close), folder, "final_block_outlines")
    walls = M.import_block_outlines(read_final(spark, folder, "final_block_outlines"), _wanted(c))
    return L.ring_measures(walls).groupBy("id_zone", "pk_usr", "pk_block", "hole").agg(
        F.sum("signed_area").alias("signed_area"), F.sum("length").alias("length"))


@query("import_typo_buildings", "pk_building id_zone", "shape_area", "typo",
       f"(SELECT r.*, b.area AS shape_area FROM rule_typo r JOIN b ON b.pk = r.pk_building WHERE r.{IN_WANTED}) t",
       "rule_typo b")
def _(spark, sf_dir):
    c = city(spark, sf_dir)
    rows = M.import_typo_buildings(rule_typo(spark, sf_dir), c.bati, _wanted(c))
    return rows.withColumn("shape_area", G.area(F.col("the_geom")))


@query("import_typo_usr", "pk_usr id_zone", " ".join(TYPOLOGIES) + " shape_area", "typo_maj typo_second",
       f"(SELECT *, 3000 AS shape_area FROM typo_best WHERE {IN_WANTED}) t", "typo_best")
def _(spark, sf_dir):
    c = city(spark, sf_dir)
    computed = Y.usr_typology(floor_features(spark, sf_dir))
    return M.import_typo_usr(computed, c.usr, _wanted(c)).withColumn("shape_area", G.area(F.col("the_geom")))


@query("import_communes", "", "area", "code_insee unite_urbaine",
       f"(SELECT *, (x1 - x0) * (y1 - y0) AS area FROM f_communes WHERE {IN_WANTED}) c", "f_communes")
def _(spark, sf_dir):
    c = city(spark, sf_dir)
    return M.import_communes(c.zones, _wanted(c)).withColumn("area", G.area(F.col("the_geom")))


@query("import_iris", "pk id_zone", " ".join(IRIS_COUNTS), "depcom dcomiris",
       "(SELECT *, " + ", ".join(f"id_zone % {k + 2} AS {c}" for k, c in enumerate(IRIS_COUNTS))
       + f" FROM f_iris WHERE {IN_WANTED}) i", "f_iris")
def _(spark, sf_dir):
    c = city(spark, sf_dir)
    return M.import_iris(c.iris, _wanted(c))
