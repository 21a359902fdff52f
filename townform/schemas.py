"""Columns of the result tables, in their fixed order, and what each means."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from townform.functions.geometry import GEOMETRY

# Names and order of the result columns.
BUILDING_COLUMNS = (
    "pk", "pk_usr", "id_zone", "the_geom", "hauteur_origin", "nb_niv", "hauteur", "area",
    "perimeter", "insee_individus", "floor_area", "vol", "compacity_r", "compacity_n",
    "compactness", "form_factor", "concavity", "main_dir_deg", "b_floor_long", "b_wall_area",
    "p_wall_long", "p_wall_area", "nb_neighbor", "free_p_wall_long", "free_ext_area", "contiguity",
    "p_vol_ratio", "fractal_dim", "min_dist", "mean_dist", "max_dist", "std_dist", "num_points",
    "l_tot", "l_cvx", "l_3m", "l_ratio", "l_ratio_cvx", "pk_block", "theme", "pai_bdtopo",
    "pai_nature")
BLOCK_COLUMNS = (
    "pk_block", "pk_usr", "id_zone", "area", "floor_area", "vol", "h_mean", "h_std", "compacity",
    "holes_area", "holes_percent", "main_dir_deg")
OUTLINE_COLUMNS = ("id_zone", "pk_usr", "pk_block", "ring_id", "hole", "seq", "x1", "y1", "x2", "y2", "srid")
USR_COLUMNS = (
    "pk", "id_zone", "the_geom", "insee_individus", "insee_menages", "insee_men_coll",
    "insee_men_surf", "insee_surface_collectif", "vegetation_surface", "route_surface",
    "route_longueur", "trottoir_longueur", "floor", "floor_ratio", "compac_mean_nw",
    "compac_mean_w", "contig_mean", "contig_std", "main_dir_std", "h_mean", "h_std",
    "p_vol_ratio_mean", "b_area", "b_vol", "b_vol_m", "build_numb", "min_m_dist", "mean_m_dist",
    "mean_std_dist", "b_holes_area_mean", "b_std_h_mean", "b_m_nw_compacity", "b_m_w_compacity",
    "b_std_compacity", "dist_to_center", "build_dens", "hydro_dens", "veget_dens", "road_dens",
    "ext_env_area", "dcomiris")
TYPOLOGIES = ("ba", "bgh", "icif", "icio", "id", "local", "pcif", "pcio", "pd", "psc")
TYPO_BUILDING_COLUMNS = ("the_geom", "pk_building", "pk_usr", "id_zone", "typo")
TYPO_USR_COLUMNS = ("the_geom", "pk_usr", "id_zone", *TYPOLOGIES, "typo_maj", "typo_second")
COMMUNE_COLUMNS = ("code_insee", "unite_urbaine", "the_geom", "id_zone")
IRIS_COLUMNS = (
    "pk", "the_geom", "depcom", "nom_com", "dcomiris", "m_49_74", "m_75_89", "m_90_04", "a_49_74",
    "a_75_89", "a_90_04", "m_a1946", "a_a1946", "m_46_49", "a_46_49", "m_05_08", "a_05_08",
    "m_09_11", "a_09_11", "id_zone")

# Labels of the typologies.
TYPO_LABELS = {
    "ba": "Bâtiment d'activité",
    "bgh": "Bâtiment de grande hauteur",
    "icif": "Immeuble continu sur îlot fermé",
    "icio": "Immeuble continu sur îlot ouvert",
    "id": "Immeuble discontinu",
    "local": "Local annexe",
    "pcif": "Pavillon continu sur îlot fermé",
    "pcio": "Pavillon continu sur îlot ouvert",
    "pd": "Pavillon discontinu",
    "psc": "Pavillon semi-continu",
}

# Result tables by final name, their columns under the final key names.
FINAL_TABLES = {
    "final_building_indicators": ("pk_building", *BUILDING_COLUMNS[1:]),
    "final_block_indicators": BLOCK_COLUMNS,
    "final_usr_indicators": ("pk_usr", *USR_COLUMNS[1:]),
    "final_building_typo": TYPO_BUILDING_COLUMNS,
    "final_usr_typo": TYPO_USR_COLUMNS,
    "final_communes": COMMUNE_COLUMNS,
    "final_iris": IRIS_COLUMNS,
    "final_block_outlines": OUTLINE_COLUMNS,
}

# Types of the result columns; all others are double.
LONG = ("pk", "pk_building", "pk_block", "pk_usr", "id_zone", "ring_id", "seq")
INT = ("nb_niv", "nb_neighbor", "num_points", "build_numb", "srid", "a_46_49", "m_05_08", "a_05_08", "m_09_11", "a_09_11")
TEXT = ("theme", "pai_bdtopo", "pai_nature", "dcomiris", "depcom", "nom_com", "code_insee", "unite_urbaine", "typo", "typo_maj", "typo_second")
TYPES = {**dict.fromkeys(LONG, T.LongType()), **dict.fromkeys(INT, T.IntegerType()), **dict.fromkeys(TEXT, T.StringType()),
         "hole": T.BooleanType(), "the_geom": GEOMETRY}

MEANING = {
    "final_block_indicators": {
        "pk_block": "key of the block, unique within a commune: lowest key of its buildings",
        "pk_usr": "key of the urban unit",
        "id_zone": "key of the commune",
        "area": "summed footprint area of the member buildings (m2)",
        "floor_area": "summed floor area of the member buildings (m2)",
        "vol": "summed volume of the member buildings (m3)",
        "h_mean": "mean building height, weighted by footprint area (m)",
        "h_std": "population standard deviation of building heights (m)",
        "compacity": "free envelope of the members over their volume to the power 2/3",
        "holes_area": "area of the courtyards enclosed by the block (m2)",
        "holes_percent": "courtyards as a share of the block with its courtyards (%)",
        "main_dir_deg": "direction of the long side of the narrowest enclosing rectangle, "
                        "degrees clockwise from north, 0 to 180",
    },
    "final_block_outlines": {
        "id_zone": "key of the commune",
        "pk_usr": "key of the urban unit",
        "pk_block": "key of the block within the commune",
        "ring_id": "key of the ring within the commune",
        "hole": "whether the ring encloses a courtyard",
        "seq": "place of the wall in its ring, from 0",
        "x1": "begin of the wall, east (m)",
        "y1": "begin of the wall, north (m)",
        "x2": "end of the wall, east (m)",
        "y2": "end of the wall, north (m)",
        "srid": "reference system of the coordinates",
    },
    "final_building_indicators": {
        "the_geom": "footprint, rings normalised",
        "pk_building": "key of the building",
        "pk_block": "key of the block within the commune",
        "pk_usr": "key of the urban unit",
        "id_zone": "key of the commune",
        "perimeter": "length of the outer wall (m)",
        "insee_individus": "inhabitants, shared out from census grid cells by floor area",
        "hauteur": "height used, 3 m where unknown (m)",
        "hauteur_origin": "height as delivered (m)",
        "nb_niv": "number of levels, at least 1 where known",
        "area": "footprint area (m2)",
        "floor_area": "footprint area times levels (m2)",
        "vol": "footprint area times height (m3)",
        "compacity_r": "walls and roof over volume to the power 2/3",
        "compacity_n": "free walls and roof over volume to the power 2/3",
        "compactness": "perimeter over that of a circle of equal area",
        "form_factor": "area over squared perimeter",
        "concavity": "area over the area of the convex hull",
        "main_dir_deg": "direction of the long side of the narrowest enclosing rectangle, "
                        "degrees clockwise from north, 0 to 180",
        "b_floor_long": "perimeter at floor level (m)",
        "b_wall_area": "area of all walls, openings included (m2)",
        "p_wall_long": "length of walls shared with neighbours (m)",
        "p_wall_area": "shared wall length times the lower of both heights (m2)",
        "nb_neighbor": "number of touching buildings",
        "free_p_wall_long": "perimeter without shared walls (m)",
        "free_ext_area": "free walls and roof (m2)",
        "contiguity": "shared wall area over wall area",
        "p_vol_ratio": "share of the footprint within 6 m of a free wall",
        "fractal_dim": "twice the log of the perimeter over the log of the area",
        "min_dist": "least distance to another building of the unit (m)",
        "mean_dist": "mean distance to the other buildings of the unit (m)",
        "max_dist": "greatest distance to another building of the unit (m)",
        "std_dist": "population standard deviation of those distances (m)",
        "num_points": "distinct vertices",
        "l_tot": "perimeter, rounded (m)",
        "l_cvx": "perimeter of the convex hull (m)",
        "l_3m": "length of outer walls within road width plus 3 m of a road axis (m)",
        "l_ratio": "l_3m as a share of l_tot (%)",
        "l_ratio_cvx": "l_3m as a share of l_cvx (%)",
        "theme": "theme of the building in the source",
        "pai_bdtopo": "theme of a point of interest on the building",
        "pai_nature": "kind of a point of interest on the building",
    },
    "final_usr_indicators": {
        "the_geom": "outline of the unit",
        "pk_usr": "key of the urban unit",
        "id_zone": "key of the commune",
        "insee_individus": "inhabitants, from census grid cells by residential floor area",
        "insee_menages": "households, from census grid cells by residential floor area",
        "insee_men_coll": "households in collective housing",
        "insee_men_surf": "summed dwelling area of the households (m2)",
        "insee_surface_collectif": "estimated area of collective dwellings (m2)",
        "vegetation_surface": "area of vegetation (m2)",
        "route_surface": "area of roads (m2)",
        "route_longueur": "length of roads (m)",
        "trottoir_longueur": "outline length of the joined parcels (m)",
        "floor": "summed floor area (m2)",
        "floor_ratio": "floor area over unit area",
        "compac_mean_nw": "plain mean of net building compacity",
        "compac_mean_w": "net building compacity, mean weighted by area",
        "contig_mean": "contiguity, mean weighted by area",
        "contig_std": "population standard deviation of contiguity",
        "main_dir_std": "population standard deviation of building directions",
        "h_mean": "building height, mean weighted by area (m)",
        "h_std": "population standard deviation of building heights (m)",
        "p_vol_ratio_mean": "passive volume share, mean weighted by area",
        "b_area": "summed footprint area (m2)",
        "b_vol": "summed building volume (m3)",
        "b_vol_m": "mean building volume (m3)",
        "build_numb": "number of buildings",
        "min_m_dist": "mean of the least distances (m)",
        "mean_m_dist": "mean of the mean distances (m)",
        "mean_std_dist": "population standard deviation of the mean distances (m)",
        "b_holes_area_mean": "courtyard area of blocks, mean weighted by area (m2)",
        "b_std_h_mean": "height deviation of blocks, mean weighted by area (m)",
        "b_m_nw_compacity": "plain mean of block compacity, blocks without value counted",
        "b_m_w_compacity": "block compacity, mean weighted by area",
        "b_std_compacity": "population standard deviation of block compacity",
        "dist_to_center": "distance between the centres of unit and commune (m)",
        "build_dens": "footprint area over unit area",
        "hydro_dens": "water area over unit area",
        "veget_dens": "vegetation area over unit area",
        "road_dens": "road area over unit area",
        "ext_env_area": "summed free wall area (m2)",
        "dcomiris": "census district with the greatest overlap",
    },
}


def documented(df: DataFrame, table: str) -> DataFrame:
    """The same rows with a comment on every documented column."""
    notes = MEANING.get(table, {})
    return df.select(*[F.col(c).alias(c, metadata={"comment": notes[c]}) if c in notes else F.col(c)
                       for c in df.columns])


def final_schema(table: str) -> T.StructType:
    """Declared names, types and comments of a result table."""
    notes = MEANING.get(table, {})
    return T.StructType([T.StructField(c, TYPES.get(c, T.DoubleType()), metadata={"comment": notes[c]} if c in notes else None)
                         for c in FINAL_TABLES[table]])


def column_dictionary(spark: SparkSession) -> DataFrame:
    rows = [(table, column, text) for table, notes in MEANING.items() for column, text in notes.items()]
    return spark.createDataFrame(rows, "table_name string, column_name string, comment string")


def typo_label(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(TYPO_LABELS.items()), "typo string, label string")
