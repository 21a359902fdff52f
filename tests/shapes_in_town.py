"""Hand-made buildings for tests: outlines as lists of corners."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from townform.functions.geometry import GEOMETRY
from townform.functions.shapes import hull
from townform.functions import geometry as G

SCHEMA = f"pk int, pk_usr int, id_zone int, hauteur double, nb_niv int, the_geom {GEOMETRY.simpleString()}"


def turned(points, degrees=0.0, dx=0.0, dy=0.0):
    c, s = math.cos(math.radians(degrees)), math.sin(math.radians(degrees))
    return [(c * x - s * y + dx, s * x + c * y + dy) for x, y in points]


def box(x0, y0, x1, y1):
    return [(x0, y0), (x0, y1), (x1, y1), (x1, y0)]


def polygon(shell, *holes, move=lambda pts: pts):
    """Geometry value; rings are closed here and normalised by ``town``."""
    def ring(pts, hole):
        pts = move(pts)
        return (0, hole, [(float(x), float(y)) for x, y in [*pts, pts[0]]])

    return (2154, [ring(shell, False), *[ring(h, True) for h in holes]])


def line(*points, move=lambda pts: pts):
    return (2154, [(0, False, [(float(x), float(y)) for x, y in move(list(points))])])


def town(spark, outlines, move=lambda pts: pts, usr=None, zone=None, heights=None):
    """Prepared buildings from outlines: a list of corner lists, or of (shell, holes...)."""
    rows = []
    for pk, o in enumerate(outlines):
        shell, *holes = o if isinstance(o[0], list) else (o,)
        rows.append((pk, usr[pk] if usr else 0, zone[pk] if zone else 0,
                     float(heights[pk]) if heights else 6.0, 2, polygon(shell, *holes, move=move)))
    df = spark.createDataFrame(rows, SCHEMA)
    df = df.select(*[c for c in df.columns if c != "the_geom"],
                   F.explode(F.array(G.normalize(F.col("the_geom")))).alias("the_geom"))
    return df.withColumns({
        "area": G.area(F.col("the_geom")), "perimeter": G.perimeter(F.col("the_geom")),
        "hull": hull(F.col("the_geom")), "insee_individus": F.lit(1.0)})


def by_pk(df, *columns, key="pk"):
    return {r[key]: (tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]])
            for r in df.collect()}
