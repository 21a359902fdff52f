"""Closed-form SQL for the rectangles of the test city, to check the Spark jobs against.

Nothing here mirrors how the jobs work: distances, contacts, overlaps, road proximity and lit
areas of axis-parallel rectangles have direct formulas; blocks come from a recursive closure
and courtyards from a flood fill of unit cells.
"""

from __future__ import annotations

from testbed.city import BUILDINGS_SQL, COMMUNES_SQL, FOREST_SQL, IRIS_SQL, ROADS_SQL, SPLITS, USR_SQL
from townform.plans.typology import BLOCK_FEATURES, BUILDING_FEATURES, FEATURES, USR_FEATURES
from townform.schemas import TYPO_LABELS, TYPOLOGIES


def rnd(x: str, digits: int = 6) -> str:
    """Half-up rounding of the printed decimal, as Spark rounds."""
    return f"CAST(ROUND(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,15)), {digits}) AS DOUBLE)"


def even(x: str) -> str:
    """Half-to-even rounding to two digits."""
    return f"CAST(ROUND_EVEN(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,15)), 2) AS DOUBLE)"


def div(a: str, b: str) -> str:
    return f"(({a}) / NULLIF({b}, 0))"


# name -> (tables it needs, SQL)
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "f_buildings": ((), BUILDINGS_SQL.replace("{part}", "part")),
    "f_usr": (("f_buildings",), USR_SQL),
    "f_communes": (("f_buildings",), COMMUNES_SQL),
    "f_iris": (("f_communes",), IRIS_SQL),
    "f_roads": (("f_communes",), ROADS_SQL.replace("{part}", "part")),
}


def cte(name: str, *needs: str):
    def add(sql: str) -> None:
        CTES[name] = (needs, sql)
    return add


def check(final: str, *needs: str) -> str:
    """The final SELECT with all tables it needs, in order."""
    order: list[str] = []

    def visit(name: str) -> None:
        for n in CTES[name][0]:
            visit(n)
        if name not in order:
            order.append(name)

    for n in needs:
        visit(n)
    tables = ",\n".join(f"{n} AS ({CTES[n][1]})" for n in order)
    return f"WITH RECURSIVE {tables}\n{final}"


cte("b", "f_buildings")("""
SELECT pk, pk_usr, id_zone, code_insee, x0, y0, x1, y1, x1 - x0 AS w, y1 - y0 AS h, p_size, slot_c, slot_r,
  hauteur AS hauteur_origin,
  CASE WHEN nb_niv = 0 THEN 1 ELSE nb_niv END AS nb_niv,
  CASE WHEN hauteur_corrigee IS NULL OR hauteur_corrigee = 0 THEN 3.0E0 ELSE hauteur_corrigee END AS hauteur,
  (x1 - x0) * (y1 - y0) AS area, 2 * (x1 - x0 + y1 - y0) AS perimeter,
  insee_individus, theme, pai_bdtopo, pai_nature
FROM f_buildings
""")

cte("shape", "b")("""
SELECT *, area * nb_niv AS floor_area, area * hauteur AS vol, area / POWER(perimeter, 2) AS form_factor,
  1.0E0 AS concavity, (perimeter * hauteur + area) / POWER(area * hauteur, 2.0E0 / 3.0E0) AS compacity_r,
  perimeter / (2 * SQRT(PI() * area)) AS compactness, 2 * LN(perimeter) / LN(area) AS fractal_dim,
  CASE WHEN w > h THEN 90.0E0 ELSE 0.0E0 END AS main_dir_deg, 4 AS num_points
FROM b
""")

cte("touch", "b")("""
SELECT a.id_zone, a.pk AS pk, c.pk AS neighbour, a.pk_usr, a.pk_usr = c.pk_usr AS same_unit,
  GREATEST(LEAST(a.x1, c.x1) - GREATEST(a.x0, c.x0), LEAST(a.y1, c.y1) - GREATEST(a.y0, c.y0)) AS len,
  LEAST(a.hauteur, c.hauteur) AS low
FROM b a JOIN b c ON a.id_zone = c.id_zone AND a.pk <> c.pk
  AND a.x0 <= c.x1 AND c.x0 <= a.x1 AND a.y0 <= c.y1 AND c.y0 <= a.y1
""")

cte("contig", "touch")("""
SELECT id_zone, pk, SUM(len) AS p_wall_long, SUM(low * len) AS p_wall_area, CAST(COUNT(*) AS INT) AS nb_neighbor
FROM touch GROUP BY id_zone, pk
""")

cte("walls", "shape", "contig")("""
SELECT s.*, perimeter AS b_floor_long, perimeter * hauteur AS b_wall_area,
  COALESCE(p_wall_long, 0) AS p_wall_long, COALESCE(p_wall_area, 0) AS p_wall_area,
  COALESCE(nb_neighbor, 0) AS nb_neighbor, perimeter - COALESCE(p_wall_long, 0) AS free_p_wall_long,
  perimeter * hauteur - COALESCE(p_wall_area, 0) + area AS free_ext_area,
  COALESCE(p_wall_area, 0) / (perimeter * hauteur) AS contiguity,
  (perimeter * hauteur - COALESCE(p_wall_area, 0) + area) / POWER(area * hauteur, 2.0E0 / 3.0E0) AS compacity_n
FROM shape s LEFT JOIN contig c ON s.id_zone = c.id_zone AND s.pk = c.pk
""")

cte("dist_pairs", "b")("""
SELECT a.id_zone, a.pk,
  SQRT(POWER(GREATEST(a.x0 - c.x1, c.x0 - a.x1, 0), 2) + POWER(GREATEST(a.y0 - c.y1, c.y0 - a.y1, 0), 2)) AS d
FROM b a JOIN b c ON a.id_zone = c.id_zone AND a.pk_usr = c.pk_usr AND a.pk <> c.pk
""")

cte("dist", "dist_pairs")("""
SELECT id_zone, pk, MIN(d) AS min_dist, AVG(d) AS mean_dist, MAX(d) AS max_dist, STDDEV_POP(d) AS std_dist
FROM dist_pairs GROUP BY id_zone, pk
""")

# A wall along a road is near it as a whole; a wall across a road for the part inside its reach.
cte("zone_roads", "f_roads", "f_communes")("""
SELECT DISTINCT c.id_zone, r.pk, r.dir, r.x1, r.y1, r.largeur + 3 AS reach
FROM f_roads r JOIN f_communes c ON c.code_insee = r.inseecom_g OR c.code_insee = r.inseecom_d
""")

cte("wall_near", "b", "zone_roads")("""
SELECT w.id_zone, w.pk, w.side,
  MAX(CASE WHEN w.dir = r.dir AND ABS(w.at - CASE WHEN r.dir = 'H' THEN r.y1 ELSE r.x1 END) <= r.reach
      THEN w.hi - w.lo ELSE 0 END) AS whole,
  SUM(CASE WHEN w.dir <> r.dir THEN GREATEST(
      LEAST(w.hi, CASE WHEN r.dir = 'H' THEN r.y1 ELSE r.x1 END + r.reach)
      - GREATEST(w.lo, CASE WHEN r.dir = 'H' THEN r.y1 ELSE r.x1 END - r.reach), 0) ELSE 0 END) AS parts
FROM (SELECT id_zone, pk, 1 AS side, 'H' AS dir, y0 AS at, x0 AS lo, x1 AS hi FROM b
      UNION ALL SELECT id_zone, pk, 2, 'H', y1, x0, x1 FROM b
      UNION ALL SELECT id_zone, pk, 3, 'V', x0, y0, y1 FROM b
      UNION ALL SELECT id_zone, pk, 4, 'V', x1, y0, y1 FROM b) w
JOIN zone_roads r ON w.id_zone = r.id_zone
GROUP BY w.id_zone, w.pk, w.side
""")

cte("near3m", "wall_near")("""
SELECT id_zone, pk, SUM(CASE WHEN whole > 0 THEN whole ELSE parts END) AS l_3m
FROM wall_near GROUP BY id_zone, pk
""")

# Each wall is hidden from its lower or left end on; what is left lights a strip 6.005 deep.
cte("hidden", "b", "touch")("""
SELECT b.id_zone, b.pk, b.w, b.h,
  MAX(CASE WHEN c.x1 = b.x0 AND t.len > 0 THEN t.len ELSE 0 END) AS ml,
  MAX(CASE WHEN c.x0 = b.x1 AND t.len > 0 THEN t.len ELSE 0 END) AS mr,
  MAX(CASE WHEN c.y1 = b.y0 AND t.len > 0 THEN t.len ELSE 0 END) AS mb,
  MAX(CASE WHEN c.y0 = b.y1 AND t.len > 0 THEN t.len ELSE 0 END) AS mt
FROM b LEFT JOIN touch t ON t.id_zone = b.id_zone AND t.pk = b.pk
LEFT JOIN b c ON c.id_zone = t.id_zone AND c.pk = t.neighbour
GROUP BY b.id_zone, b.pk, b.w, b.h
""")

cte("strips", "hidden")("""
SELECT id_zone, pk, 1 AS bit, 0.0E0 AS x0, LEAST(6.005E0, w) AS x1, ml AS y0, h AS y1 FROM hidden WHERE ml < h
UNION ALL SELECT id_zone, pk, 2, GREATEST(w - 6.005E0, 0), w, mr, h FROM hidden WHERE mr < h
UNION ALL SELECT id_zone, pk, 4, mb, w, 0.0E0, LEAST(6.005E0, h) FROM hidden WHERE mb < w
UNION ALL SELECT id_zone, pk, 8, mt, w, GREATEST(h - 6.005E0, 0), h FROM hidden WHERE mt < w
""")

cte("lit", "strips")("""
SELECT id_zone, pk, SUM(CASE WHEN n % 2 = 1 THEN 1 ELSE -1 END * GREATEST(x1 - x0, 0) * GREATEST(y1 - y0, 0)) AS area
FROM (SELECT s.id_zone, s.pk, m.mask, COUNT(*) AS n, MAX(x0) AS x0, MIN(x1) AS x1, MAX(y0) AS y0, MIN(y1) AS y1
      FROM strips s JOIN (SELECT CAST(i AS INT) AS mask FROM generate_series(1, 15) g(i)) m ON (m.mask & s.bit) <> 0
      GROUP BY s.id_zone, s.pk, m.mask
      HAVING COUNT(*) = bit_count(m.mask)) k
GROUP BY id_zone, pk
""")

cte("passive", "b", "lit")(f"""
SELECT b.id_zone, b.pk, {rnd('LEAST(COALESCE(lit.area, 0) / b.area, 1)', 2)} AS p_vol_ratio
FROM b LEFT JOIN lit ON lit.id_zone = b.id_zone AND lit.pk = b.pk
""")

cte("closure", "b", "touch")("""
SELECT id_zone, pk, pk AS root FROM b
UNION
SELECT t.id_zone, t.neighbour, r.root FROM closure r JOIN touch t ON t.id_zone = r.id_zone AND t.pk = r.pk AND t.same_unit
""")

cte("members", "closure", "b")("""
SELECT b.id_zone, b.pk, b.pk_usr, MIN(c.root) AS pk_block
FROM b JOIN closure c ON b.id_zone = c.id_zone AND b.pk = c.pk GROUP BY b.id_zone, b.pk, b.pk_usr
""")

cte("bi", "walls", "dist", "near3m", "passive", "members")(f"""
SELECT w.* EXCLUDE (insee_individus), COALESCE(w.insee_individus, 0) AS insee_individus,
  COALESCE(d.min_dist, 0) AS min_dist, COALESCE(d.mean_dist, 0) AS mean_dist,
  COALESCE(d.max_dist, 0) AS max_dist, COALESCE(d.std_dist, 0) AS std_dist,
  w.perimeter AS l_tot, w.perimeter AS l_cvx, n.l_3m, {rnd('n.l_3m * 100 / w.perimeter', 1)} AS l_ratio,
  {rnd('n.l_3m * 100 / w.perimeter', 1)} AS l_ratio_cvx, p.p_vol_ratio, m.pk_block
FROM walls w LEFT JOIN dist d ON w.id_zone = d.id_zone AND w.pk = d.pk
JOIN near3m n ON w.id_zone = n.id_zone AND w.pk = n.pk
JOIN passive p ON w.id_zone = p.id_zone AND w.pk = p.pk
JOIN members m ON w.id_zone = m.id_zone AND w.pk = m.pk
""")

# Courtyards: free unit cells that a flood from outside the slots does not reach. Corner
# contacts are closed, so the flood moves sideways only.
cte("free_cells", "f_usr", "b")("""
SELECT u.id_zone, u.pk AS pk_usr, x, y
FROM f_usr u, generate_series(4, 55) gx(i), generate_series(4, 45) gy(j),
  LATERAL (SELECT CAST(u.x0 AS INT) + CAST(i AS INT) AS x, CAST(u.y0 AS INT) + CAST(j AS INT) AS y) c
WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.id_zone = u.id_zone AND b.pk_usr = u.pk
  AND b.x0 <= c.x AND c.x < b.x1 AND b.y0 <= c.y AND c.y < b.y1)
""")

cte("flood", "free_cells", "f_usr")("""
SELECT f.id_zone, f.pk_usr, f.x, f.y FROM free_cells f JOIN f_usr u ON u.id_zone = f.id_zone AND u.pk = f.pk_usr
WHERE f.x = u.x0 + 4 OR f.y = u.y0 + 4 OR f.x = u.x0 + 55 OR f.y = u.y0 + 45
UNION
SELECT f.id_zone, f.pk_usr, f.x, f.y
FROM flood p, (SELECT 1 AS dx, 0 AS dy UNION ALL SELECT -1, 0 UNION ALL SELECT 0, 1 UNION ALL SELECT 0, -1) m, free_cells f
WHERE f.id_zone = p.id_zone AND f.pk_usr = p.pk_usr AND f.x = p.x + m.dx AND f.y = p.y + m.dy
""")

cte("yard_cells", "free_cells", "flood", "b", "members")("""
SELECT f.id_zone, f.pk_usr, f.x, f.y, ARG_MAX(m.pk_block, b.x1) AS pk_block
FROM free_cells f ANTI JOIN flood o ON f.id_zone = o.id_zone AND f.pk_usr = o.pk_usr AND f.x = o.x AND f.y = o.y
JOIN b ON b.id_zone = f.id_zone AND b.pk_usr = f.pk_usr AND b.x1 <= f.x AND b.y0 <= f.y AND f.y < b.y1
JOIN members m ON m.id_zone = b.id_zone AND m.pk = b.pk
GROUP BY f.id_zone, f.pk_usr, f.x, f.y
""")

# Offset by 0.01: area - 0.01 * length + 0.0001 * (inner corners - pi / 4 * outer corners).
# Corners are read off the four cells around each vertex of a yard cell.
cte("yard_parts", "yard_cells", "free_cells")("""
SELECT y.id_zone, y.pk_usr, y.pk_block,
  4 - (fl.x IS NOT NULL)::INT - (fr.x IS NOT NULL)::INT - (fb.x IS NOT NULL)::INT - (ft.x IS NOT NULL)::INT AS len,
  (fl.x IS NULL AND fb.x IS NULL)::INT + (fl.x IS NULL AND ft.x IS NULL)::INT
    + (fr.x IS NULL AND fb.x IS NULL)::INT + (fr.x IS NULL AND ft.x IS NULL)::INT AS inner_corners,
  (fl.x IS NOT NULL AND fb.x IS NOT NULL AND flb.x IS NULL)::INT
    + (fl.x IS NOT NULL AND ft.x IS NOT NULL AND flt.x IS NULL)::INT
    + (fr.x IS NOT NULL AND fb.x IS NOT NULL AND frb.x IS NULL)::INT
    + (fr.x IS NOT NULL AND ft.x IS NOT NULL AND frt.x IS NULL)::INT AS outer_corners
FROM yard_cells y
LEFT JOIN free_cells fl ON fl.id_zone = y.id_zone AND fl.pk_usr = y.pk_usr AND fl.x = y.x - 1 AND fl.y = y.y
LEFT JOIN free_cells fr ON fr.id_zone = y.id_zone AND fr.pk_usr = y.pk_usr AND fr.x = y.x + 1 AND fr.y = y.y
LEFT JOIN free_cells fb ON fb.id_zone = y.id_zone AND fb.pk_usr = y.pk_usr AND fb.x = y.x AND fb.y = y.y - 1
LEFT JOIN free_cells ft ON ft.id_zone = y.id_zone AND ft.pk_usr = y.pk_usr AND ft.x = y.x AND ft.y = y.y + 1
LEFT JOIN free_cells flb ON flb.id_zone = y.id_zone AND flb.pk_usr = y.pk_usr AND flb.x = y.x - 1 AND flb.y = y.y - 1
LEFT JOIN free_cells flt ON flt.id_zone = y.id_zone AND flt.pk_usr = y.pk_usr AND flt.x = y.x - 1 AND flt.y = y.y + 1
LEFT JOIN free_cells frb ON frb.id_zone = y.id_zone AND frb.pk_usr = y.pk_usr AND frb.x = y.x + 1 AND frb.y = y.y - 1
LEFT JOIN free_cells frt ON frt.id_zone = y.id_zone AND frt.pk_usr = y.pk_usr AND frt.x = y.x + 1 AND frt.y = y.y + 1
""")

cte("yards", "yard_parts")("""
SELECT id_zone, pk_usr, pk_block, COUNT(*) AS cells, SUM(len) AS len,
  SUM(inner_corners) - SUM(outer_corners) * PI() / 4 AS corners,
  COUNT(*) - 0.01E0 * SUM(len) + 0.0001E0 * (SUM(inner_corners) - SUM(outer_corners) * PI() / 4) AS holes_area
FROM yard_parts GROUP BY id_zone, pk_usr, pk_block
""")

# Shells run clockwise around members and courtyards, courtyards the other way.
cte("outline", "members", "b", "contig", "yards")("""
SELECT s.id_zone, s.pk_usr, s.pk_block, 0 AS hole, 0 AS breaks, -(s.area + COALESCE(y.cells, 0)) AS signed_area,
  s.len - COALESCE(y.len, 0) AS length
FROM (SELECT m.id_zone, m.pk_usr, m.pk_block, SUM(b.area) AS area, SUM(b.perimeter - COALESCE(c.p_wall_long, 0)) AS len
      FROM members m JOIN b ON b.id_zone = m.id_zone AND b.pk = m.pk LEFT JOIN contig c ON c.id_zone = b.id_zone AND c.pk = b.pk
      GROUP BY ALL) s
LEFT JOIN yards y ON y.id_zone = s.id_zone AND y.pk_block = s.pk_block
UNION ALL SELECT id_zone, pk_usr, pk_block, 1, 0, cells, len FROM yards
""")

# Corner terms of all outlines of a block with a courtyard, from the cells around each vertex.
cte("yard_blocks", "yards", "members", "b", "contig")("""
SELECT y.id_zone, y.pk_usr, y.pk_block, SUM(b.area) AS area, SUM(b.perimeter - COALESCE(c.p_wall_long, 0)) AS free_len
FROM yards y JOIN members m ON m.id_zone = y.id_zone AND m.pk_block = y.pk_block
JOIN b ON b.id_zone = m.id_zone AND b.pk = m.pk
LEFT JOIN contig c ON c.id_zone = b.id_zone AND c.pk = b.pk
GROUP BY y.id_zone, y.pk_usr, y.pk_block
""")

cte("block_vertices", "yards", "members", "b")("""
SELECT id_zone, pk_block, x, y, COUNT(*) AS cells, BIT_OR(quadrant) AS quadrants
FROM (SELECT DISTINCT m.id_zone, m.pk_block, cx + q.dx AS x, cy + q.dy AS y, q.quadrant
      FROM yards y JOIN members m ON m.id_zone = y.id_zone AND m.pk_block = y.pk_block
      JOIN b ON b.id_zone = m.id_zone AND b.pk = m.pk,
      LATERAL (SELECT unnest(range(CAST(b.x0 AS INT), CAST(b.x1 AS INT))) AS cx) gx,
      LATERAL (SELECT unnest(range(CAST(b.y0 AS INT), CAST(b.y1 AS INT))) AS cy) gy,
      (SELECT 0 AS dx, 0 AS dy, 1 AS quadrant UNION ALL SELECT 1, 0, 2 UNION ALL SELECT 0, 1, 4 UNION ALL SELECT 1, 1, 8) q) v
GROUP BY id_zone, pk_block, x, y
""")

cte("block_corners", "block_vertices")("""
SELECT id_zone, pk_block, SUM(CASE WHEN cells = 1 THEN -PI() / 4 WHEN cells = 3 THEN 1
  WHEN quadrants IN (6, 9) THEN 2 ELSE 0 END) AS corners
FROM block_vertices GROUP BY id_zone, pk_block
""")

cte("courtyard", "yards", "yard_blocks", "block_corners")("""
SELECT y.id_zone, y.pk_usr, y.pk_block, y.holes_area,
  100 * y.holes_area / (k.area + y.cells + 0.01E0 * (k.free_len - y.len) - 0.0001E0 * (c.corners - y.corners)) AS holes_percent
FROM yards y JOIN yard_blocks k ON k.id_zone = y.id_zone AND k.pk_block = y.pk_block
JOIN block_corners c ON c.id_zone = y.id_zone AND c.pk_block = y.pk_block
""")

# Main direction: hull edges are the vertex pairs with all vertices on one side.
cte("block_points", "members", "b")("""
SELECT DISTINCT m.id_zone, m.pk_block, p.x, p.y
FROM members m JOIN b ON m.id_zone = b.id_zone AND m.pk = b.pk,
LATERAL (SELECT b.x0 AS x, b.y0 AS y UNION ALL SELECT b.x0, b.y1 UNION ALL SELECT b.x1, b.y0 UNION ALL SELECT b.x1, b.y1) p
""")

cte("hull_sides", "block_points")("""
SELECT p.id_zone, p.pk_block, q.x - p.x AS dx, q.y - p.y AS dy,
  MAX((q.x - p.x) * (o.y - p.y) - (q.y - p.y) * (o.x - p.x)) / SQRT(POWER(q.x - p.x, 2) + POWER(q.y - p.y, 2)) AS width
FROM block_points p
JOIN block_points q ON p.id_zone = q.id_zone AND p.pk_block = q.pk_block AND (p.x <> q.x OR p.y <> q.y)
JOIN block_points o ON p.id_zone = o.id_zone AND p.pk_block = o.pk_block
GROUP BY p.id_zone, p.pk_block, p.x, p.y, q.x, q.y
HAVING MIN((q.x - p.x) * (o.y - p.y) - (q.y - p.y) * (o.x - p.x)) >= 0
""")

cte("block_dir", "hull_sides")("""
SELECT id_zone, pk_block, MIN(azimuth) AS main_dir_deg
FROM (SELECT id_zone, pk_block, width, MIN(width) OVER (PARTITION BY id_zone, pk_block) AS least,
        CASE WHEN dx = 0 THEN 0.0E0 ELSE (DEGREES(ATAN2(dx, dy)) + 180) % 180 END AS azimuth FROM hull_sides) s
WHERE width <= least * (1 + 1E-9) GROUP BY id_zone, pk_block
""")

cte("ki", "bi", "courtyard", "block_dir")("""
SELECT s.*, COALESCE(c.holes_area, 0) AS holes_area, COALESCE(c.holes_percent, 0) AS holes_percent, d.main_dir_deg
FROM (SELECT id_zone, pk_usr, pk_block, SUM(area) AS area, SUM(floor_area) AS floor_area, SUM(vol) AS vol,
        SUM(area * hauteur) / SUM(area) AS h_mean, STDDEV_POP(hauteur) AS h_std,
        SUM(free_ext_area) / POWER(SUM(vol), 2.0E0 / 3.0E0) AS compacity
      FROM bi GROUP BY id_zone, pk_usr, pk_block) s
LEFT JOIN courtyard c ON s.id_zone = c.id_zone AND s.pk_block = c.pk_block
JOIN block_dir d ON s.id_zone = d.id_zone AND s.pk_block = d.pk_block
""")

UB = {
    "compac_mean_nw": "AVG(compacity_n)",
    "compac_mean_w": "SUM(area * compacity_n) / SUM(area)",
    "contig_mean": "SUM(area * contiguity) / SUM(area)",
    "contig_std": "STDDEV_POP(contiguity)",
    "main_dir_std": "STDDEV_POP(main_dir_deg)",
    "h_mean": "SUM(area * hauteur) / SUM(area)",
    "h_std": "STDDEV_POP(hauteur)",
    "p_vol_ratio_mean": "SUM(area * p_vol_ratio) / SUM(area)",
    "b_area": "SUM(area)",
    "b_vol": "SUM(vol)",
    "b_vol_m": "SUM(vol) / COUNT(*)",
    "min_m_dist": "AVG(min_dist)",
    "mean_m_dist": "AVG(mean_dist)",
    "mean_std_dist": "STDDEV_POP(mean_dist)",
    "ext_env_area": "SUM(b_wall_area - p_wall_area)",
}
cte("ub", "bi")("SELECT id_zone, pk_usr, CAST(COUNT(*) AS INT) AS build_numb, SUM(floor_area) AS floors, SUM(area) AS built,\n"
                + ",\n".join(f"{rnd(sql, 2)} AS {name}" for name, sql in UB.items())
                + "\nFROM bi GROUP BY id_zone, pk_usr")

UK = {
    "b_holes_area_mean": "SUM(area * holes_area) / SUM(area)",
    "b_std_h_mean": "SUM(area * h_std) / SUM(area)",
    "b_m_nw_compacity": "SUM(compacity) / COUNT(*)",
    "b_m_w_compacity": "SUM(area * compacity) / SUM(area)",
    "b_std_compacity": "STDDEV_POP(compacity)",
}
cte("uk", "ki")("SELECT id_zone, pk_usr,\n" + ",\n".join(f"{rnd(sql, 2)} AS {n}" for n, sql in UK.items())
                + "\nFROM ki GROUP BY id_zone, pk_usr")

cte("center", "f_usr", "f_communes")("""
SELECT u.id_zone, u.pk AS pk_usr,
  SQRT(POWER((u.x0 + u.x1) / 2 - (c.x0 + c.x1) / 2, 2) + POWER((u.y0 + u.y1) / 2 - (c.y0 + c.y1) / 2, 2)) AS dist_to_center
FROM f_usr u JOIN f_communes c ON u.id_zone = c.id_zone
""")

cte("best_iris", "f_usr", "f_iris")("""
SELECT id_zone, pk_usr, dcomiris FROM (
  SELECT u.id_zone, u.pk AS pk_usr, i.dcomiris, ROW_NUMBER() OVER (PARTITION BY u.id_zone, u.pk ORDER BY
      GREATEST(LEAST(u.x1, i.x1) - GREATEST(u.x0, i.x0), 0) * GREATEST(LEAST(u.y1, i.y1) - GREATEST(u.y0, i.y0), 0) DESC,
      i.dcomiris) AS place
  FROM f_usr u LEFT JOIN f_iris i ON u.id_zone = i.id_zone AND u.x0 - 0.0001 <= i.x1 + 0.0001 AND i.x0 - 0.0001 <= u.x1 + 0.0001
    AND u.y0 - 0.0001 <= i.y1 + 0.0001 AND i.y0 - 0.0001 <= u.y1 + 0.0001) s
WHERE place = 1
""")

USR_CARRIED = ("insee_individus", "insee_menages", "insee_men_coll", "insee_men_surf",
               "insee_surface_collectif", "vegetation_surface", "route_surface", "route_longueur",
               "trottoir_longueur")
cte("ui", "f_usr", "ub", "uk", "center", "best_iris")(
    "SELECT u.pk, u.id_zone, i.dcomiris,\n"
    + ",\n".join(f"COALESCE(u.{c}, 0) AS {c}" for c in USR_CARRIED) + ",\n"
    + ",\n".join(f"COALESCE(ub.{c}, 0) AS {c}" for c in (*UB, "build_numb")) + ",\n"
    + ",\n".join(f"COALESCE(uk.{c}, 0) AS {c}" for c in UK) + ",\n"
    + f"""COALESCE({rnd('ub.floors', 2)}, 0) AS floor, COALESCE({rnd('ub.floors / 3000', 2)}, 0) AS floor_ratio,
COALESCE(c.dist_to_center, 0) AS dist_to_center, COALESCE({rnd('ub.built / 3000', 4)}, 0) AS build_dens,
COALESCE({rnd('u.hydro_surface / 3000', 4)}, 0) AS hydro_dens,
COALESCE({rnd('u.vegetation_surface / 3000', 4)}, 0) AS veget_dens,
COALESCE({rnd('u.route_surface / 3000', 4)}, 0) AS road_dens
FROM f_usr u LEFT JOIN ub ON u.id_zone = ub.id_zone AND u.pk = ub.pk_usr
LEFT JOIN uk ON u.id_zone = uk.id_zone AND u.pk = uk.pk_usr
LEFT JOIN center c ON u.id_zone = c.id_zone AND u.pk = c.pk_usr
LEFT JOIN best_iris i ON u.id_zone = i.id_zone AND u.pk = i.pk_usr""")


def pick(names: dict[str, str], table: str) -> str:
    return ", ".join(f"{table}.{source} AS {name}" for source, name in names.items())


cte("feat", "bi", "ki", "ui")(
    f"""SELECT bi.pk AS pk_building, bi.pk_usr, bi.id_zone, {pick(BUILDING_FEATURES, 'bi')},
{pick(BLOCK_FEATURES, 'ki')}, {pick(USR_FEATURES, 'ui')}, bi.p_size
FROM bi JOIN ki ON bi.id_zone = ki.id_zone AND bi.pk_usr = ki.pk_usr AND bi.pk_block = ki.pk_block
JOIN ui ON bi.id_zone = ui.id_zone AND bi.pk_usr = ui.pk""")

TYPO_LIST = "[" + ", ".join(f"'{t}'" for t in TYPOLOGIES) + "]"
cte("rule_typo", "b")(f"SELECT id_zone, pk AS pk_building, {TYPO_LIST}[p_size % 10 + 1] AS typo FROM b")

cte("floors", "b")("SELECT id_zone, pk_usr, SUM(area * nb_niv) AS u_floor FROM b GROUP BY id_zone, pk_usr")

cte("typo_cells", "b", "rule_typo", "floors")(f"""
SELECT b.id_zone, b.pk_usr, t.typo, {even('SUM(CASE WHEN f.u_floor <> 0 THEN b.area * b.nb_niv / f.u_floor * 100 ELSE 0 END)')} AS share
FROM b JOIN rule_typo t ON t.id_zone = b.id_zone AND t.pk_building = b.pk
JOIN floors f ON f.id_zone = b.id_zone AND f.pk_usr = b.pk_usr
GROUP BY b.id_zone, b.pk_usr, t.typo
""")

cte("typo_table", "typo_cells")(
    "SELECT id_zone, pk_usr, " + ", ".join(
        f"COALESCE(MAX(CASE WHEN typo = '{t}' THEN share END), 0) AS {t}" for t in TYPOLOGIES)
    + " FROM typo_cells GROUP BY id_zone, pk_usr")

cte("typo_rank", "typo_table")(
    " UNION ALL ".join(f"SELECT id_zone, pk_usr, {k} AS place, '{t}' AS typo, {t} AS share FROM typo_table"
                       for k, t in enumerate(TYPOLOGIES)))

cte("typo_best", "typo_table", "typo_rank")("""
SELECT t.*, r.typo_maj, r.typo_second FROM typo_table t JOIN (
  SELECT id_zone, pk_usr, ARG_MIN(typo, (-share, place)) AS typo_maj, MAX(CASE WHEN up = 9 THEN CASE WHEN share = 0 THEN 'na' ELSE typo END END) AS typo_second
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY id_zone, pk_usr ORDER BY share, place) AS up FROM typo_rank) s
  GROUP BY id_zone, pk_usr) r ON t.id_zone = r.id_zone AND t.pk_usr = r.pk_usr
""")

# Every building walks down every tree; the most votes win, of equal ones the first name.
cte("forest")(FOREST_SQL.replace("{part}", "part"))

cte("known_feat", "feat")("SELECT * FROM feat WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in FEATURES))

cte("node_walk", "known_feat", "forest")("""
SELECT f.id_zone, f.pk_building, t.tree, CAST(1 AS BIGINT) AS node FROM known_feat f, (SELECT DISTINCT tree FROM forest) t
UNION ALL
SELECT w.id_zone, w.pk_building, w.tree, CASE WHEN CASE n.variable """ + " ".join(f"WHEN '{v}' THEN f.{v}" for v in SPLITS) + """ END <= n.split
  THEN n.below ELSE n.above END
FROM node_walk w JOIN forest n ON n.tree = w.tree AND n.node = w.node AND n.variable IS NOT NULL
JOIN known_feat f ON f.id_zone = w.id_zone AND f.pk_building = w.pk_building
""")

cte("node_votes", "node_walk", "forest")("""
SELECT w.id_zone, w.pk_building, n.typo, COUNT(*) AS votes
FROM node_walk w JOIN forest n ON n.tree = w.tree AND n.node = w.node AND n.typo IS NOT NULL GROUP BY ALL
""")

cte("node_typo", "feat", "node_votes")("""
SELECT f.id_zone, f.pk_usr, f.pk_building, v.typo, f.i_floor, f.u_floor
FROM feat f LEFT JOIN (SELECT id_zone, pk_building, ARG_MIN(typo, (-votes, typo)) AS typo FROM node_votes GROUP BY ALL) v
ON v.id_zone = f.id_zone AND v.pk_building = f.pk_building
""")

cte("node_typo_cells", "node_typo")(f"""
SELECT id_zone, pk_usr, typo, {even('SUM(CASE WHEN u_floor <> 0 THEN i_floor / u_floor * 100 ELSE 0 END)')} AS share
FROM node_typo WHERE typo IS NOT NULL GROUP BY id_zone, pk_usr, typo
""")

for _name in ("typo_table", "typo_rank", "typo_best"):
    _needs, _sql = CTES[_name]
    for _other in ("typo_cells", "typo_table", "typo_rank"):
        _sql = _sql.replace(_other, f"node_{_other}")
    CTES[f"node_{_name}"] = (tuple(f"node_{n}" for n in _needs), _sql)

LABEL_VALUES = ", ".join("('{}', '{}')".format(t, label.replace("'", "''")) for t, label in TYPO_LABELS.items())
