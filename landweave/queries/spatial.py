"""Queries of neighbourhoods, distances, polygons and patches."""

from __future__ import annotations

from pyspark.sql import functions as F

from landweave.operators import conserve as K
from landweave.operators import distance as D
from landweave.operators import focal as N
from landweave.operators import patches as P
from landweave.operators import vector as V
from landweave.queries.base import query

_FEAT = "(SELECT row, col FROM cells WHERE lulc_2022 = 106)"
_NINE = ", ".join(f"MAX(n.elevation) FILTER (n.row = c.row + {r - 2} AND n.col = c.col + {k - 2}) AS z{r}{k}" for r in (1, 2, 3) for k in (1, 2, 3))
_Z = [f"z{r}{k}" for r in (1, 2, 3) for k in (1, 2, 3)]
_RIM = [z for z in _Z if z != "z22"]


@query("g7_terrain", f"""WITH z AS (SELECT c.row, c.col, {_NINE} FROM cells AS c JOIN cells AS n ON n.row BETWEEN c.row - 1 AND c.row + 1 AND n.col BETWEEN c.col - 1 AND c.col + 1 GROUP BY c.row, c.col),
 d AS (SELECT *, {' AND '.join(f'{z} IS NOT NULL' for z in _Z)} AS ok, ((z13 + 2 * z23 + z33) - (z11 + 2 * z21 + z31)) / 240 AS dx, ((z31 + 2 * z32 + z33) - (z11 + 2 * z12 + z13)) / 240 AS dy FROM z)
 SELECT row, col, CASE WHEN ok THEN round(degrees(atan(sqrt(dx * dx + dy * dy))), 6) END AS slope, CASE WHEN ok AND NOT (dx = 0 AND dy = 0) THEN round(CASE WHEN degrees(atan2(dy, -dx)) > 90 THEN 450 ELSE 90 END - degrees(atan2(dy, -dx)), 6) END AS aspect,
 CASE WHEN ok THEN round(z22 - ({' + '.join(_RIM)}) / 8, 6) END AS tpi, CASE WHEN ok THEN round(({' + '.join(f'abs({z} - z22)' for z in _RIM)}) / 8, 6) END AS tri, CASE WHEN ok THEN round(greatest({', '.join(_Z)}) - least({', '.join(_Z)}), 6) END AS roughness FROM d""")
def _(t):
    return N.terrain(t.cells, "elevation", 30.0)


_KERNEL = "(SELECT CAST(r - {h} AS INT) AS dr, CAST(c - {h} AS INT) AS dc, pow(1 / 2.0::DOUBLE, sqrt(pow(r - {h}, 2) + pow(c - {h}, 2))) * 10 AS w FROM range({n}) AS a(r), range({n}) AS b(c))"


def _summed(kernel: str, classes: str) -> str:
    """Oracle: focal sums of classes by every matrix of kernel (matrix_id, dr, dc, w)."""
    return f"""k AS ({kernel}), s AS (SELECT matrix_id, c.row - dr AS row, c.col - dc AS col, lulc_2022 AS class, SUM(w) AS value FROM cells AS c, k WHERE lulc_2022 IN ({classes}) GROUP BY ALL)
 SELECT c.cell_id, c.row, c.col, v AS class, m AS matrix_id, round(COALESCE(value, 0), 6) AS value FROM cells AS c CROSS JOIN (SELECT unnest([{classes}]) AS v) CROSS JOIN (SELECT DISTINCT matrix_id AS m FROM k) LEFT JOIN s ON s.row = c.row AND s.col = c.col AND s.class = v AND s.matrix_id = m"""


@query("g8_kernel", "WITH " + _summed(" UNION ALL ".join(f"SELECT 'k{n}' AS matrix_id, dr, dc, w FROM {_KERNEL.format(h=n // 2, n=n)}" for n in (3, 5, 7, 9, 11)), "105"))
def _(t):
    out = None
    for n in (3, 5, 7, 9, 11):
        one = N.focal_sum(t.cells, "lulc_2022", [105], N.kernel(t.spark, n, 10.0, 2.0, matrix_id=f"k{n}"))
        out = one if out is None else out.unionByName(one)
    return out


@query("g9_kernel_family")
def _(t):
    return N.focal_sum(t.cells, "lulc_2022", [105], N.kernel_family(t.spark, [3, 5], 2, seed=68))


@query("g10_decay_profile", f"SELECT cell_id, round(10 * pow(0.5::DOUBLE, k / 10), 6) AS w FROM (SELECT c.cell_id, round(sqrt(MIN(pow(c.row - f.row, 2) + pow(c.col - f.col, 2))) * 10) AS k FROM cells AS c, {_FEAT} AS f GROUP BY 1) WHERE k <= 100")
def _(t):
    step = lambda c: F.round(F.col(c) * 10).cast("int").alias("step")
    near = D.distance_to(t.cells, t.cells.filter("lulc_2022 = 106")).select("cell_id", step("distance"))
    return near.join(F.broadcast(N.decay_profile(t.spark, 10.0, 2.0).select(step("radius"), "w")), "step").select("cell_id", "w")


@query("g11_focal_sum", f"""WITH k AS {_KERNEL.format(h=2, n=5)}, s AS (SELECT c.row - dr AS row, c.col - dc AS col, lulc_2022 AS class, SUM(w) AS value FROM cells AS c, k WHERE lulc_2022 IN (103, 105) GROUP BY ALL)
 SELECT c.cell_id, c.row, c.col, v AS class, 'k' AS matrix_id, round(COALESCE(value, 0), 6) AS value FROM cells AS c CROSS JOIN (VALUES (103), (105)) AS x(v) LEFT JOIN s ON s.row = c.row AND s.col = c.col AND s.class = v""")
def _(t):
    return N.focal_sum(t.cells, "lulc_2022", [103, 105], N.kernel(t.spark, 5, 10.0, 2.0))


@query("g12_neighbour_count", "SELECT c.cell_id, n.lulc_2018 AS class, COUNT(*) AS n FROM cells AS c JOIN cells AS n ON n.row BETWEEN c.row - 1 AND c.row + 1 AND n.col BETWEEN c.col - 1 AND c.col + 1 AND n.cell_id <> c.cell_id GROUP BY 1, 2")
def _(t):
    return N.neighbour_count(t.cells, "lulc_2018")


@query("g13_neighbours_within", "SELECT a.id_coord AS id_coord_origin, b.id_coord AS id_coord_neighbor, round(sqrt(pow(a.lon - b.lon, 2) + pow(a.lat - b.lat, 2)), 6) AS distance FROM points AS a JOIN points AS b ON a.id_coord <> b.id_coord AND pow(a.lon - b.lon, 2) + pow(a.lat - b.lat, 2) <= 4", digits=None)
def _(t):
    # rounded as the SQL does it; Spark's round makes a decimal of each of the many rows
    return N.neighbours_within(t.points, 2.0).withColumn("distance", F.floor(F.col("distance") * 1e6 + 0.5) / 1e6)


@query("g14_distance", f"SELECT c.cell_id, round(sqrt(MIN(pow(c.row - f.row, 2) + pow(c.col - f.col, 2))) * 30, 6) AS distance FROM cells AS c, {_FEAT} AS f GROUP BY 1")
def _(t):
    return D.distance_to(t.cells, t.cells.filter("lulc_2022 = 106"), 30.0)


@query("g15_fill_nearest", """WITH gap AS (SELECT o_orderkey + 1 AS cell_id, CAST(FLOOR(o_orderkey / 100.0) AS INT) + 1 AS row, CAST(o_orderkey % 100 AS INT) + 1 AS col FROM orders WHERE o_custkey % 10 = 0),
 d AS (SELECT g.cell_id, lulc_2022 AS zone, MIN(pow(g.row - z.row, 2) + pow(g.col - z.col, 2)) AS sq FROM gap AS g CROSS JOIN cells AS z GROUP BY 1, 2)
 SELECT cell_id, zone, round(sqrt(sq), 6) AS distance FROM d QUALIFY row_number() OVER (PARTITION BY cell_id ORDER BY sq, zone) = 1""")
def _(t):
    key = F.col("o_orderkey")
    gaps = t.orders.filter("o_custkey % 10 = 0").select((key + 1).alias("cell_id"), (F.floor(key / 100) + 1).cast("int").alias("row"), (key % 100 + 1).cast("int").alias("col"))
    return D.fill_nearest(gaps, t.cells.select("row", "col", F.col("lulc_2022").alias("zone")), "zone")


@query("g16_within_buffer", f"SELECT DISTINCT c.cell_id FROM cells AS c JOIN {_FEAT} AS f ON f.row BETWEEN c.row - 3 AND c.row + 3 AND f.col BETWEEN c.col - 3 AND c.col + 3 AND pow(c.row - f.row, 2) + pow(c.col - f.col, 2) <= 9")
def _(t):
    return D.within_buffer(t.cells, t.cells.filter("lulc_2022 = 106"), 3.0)


_RAST = """e AS (SELECT poly_id, x AS x1, y AS y1, COALESCE(lead(x) OVER w, first(x) OVER w) AS x2, COALESCE(lead(y) OVER w, first(y) OVER w) AS y2 FROM polygons WINDOW w AS (PARTITION BY poly_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
 cov AS (SELECT c.cell_id, e.poly_id FROM cells AS c JOIN e ON (y1 > c.row - 0.5) <> (y2 > c.row - 0.5) AND c.col - 0.5 < x1 + (c.row - 0.5 - y1) * (x2 - x1) / (y2 - y1) GROUP BY 1, 2 HAVING COUNT(*) % 2 = 1)"""


@query("g17_rasterize", f"WITH {_RAST} SELECT poly_id, cell_id FROM cov")
def _(t):
    return V.rasterize(t.polygons, t.cells)


@query("g17_rasterize_touches", f"""WITH {_RAST}, d AS (SELECT *, 1 / (x2 - x1) AS ix, 1 / (y2 - y1) AS iy FROM e),
 h AS (SELECT cell_id, poly_id, greatest(least((col - 1 - x1) * ix, (col - x1) * ix), least((row - 1 - y1) * iy, (row - y1) * iy), 0) AS t0, least(greatest((col - 1 - x1) * ix, (col - x1) * ix), greatest((row - 1 - y1) * iy, (row - y1) * iy), 1) AS t1 FROM cells, d)
 SELECT poly_id, cell_id FROM cov UNION SELECT poly_id, cell_id FROM h WHERE t1 - t0 > 1e-9""")
def _(t):
    return V.rasterize(t.polygons, t.cells, touches=True)


@query("g17_field_last_wins", f"WITH {_RAST} SELECT cell_id, MAX(poly_id * 10) AS f FROM cov GROUP BY 1")
def _(t):
    return V.field_of(V.rasterize(t.polygons, t.cells), t.polygons.select("poly_id", (F.col("poly_id") * 10).alias("f")).distinct(), "f")


@query("g18_dissolve", f"WITH {_RAST} SELECT DISTINCT p.parent_id, cell_id FROM cov JOIN polygons AS p ON p.poly_id = cov.poly_id")
def _(t):
    return V.dissolve(t.polygons, t.cells, t.polygons.select("poly_id", "parent_id").distinct(), "parent_id")


@query("g19_union_features", "SELECT poly_id, x, y, 0 AS layer FROM polygons UNION ALL SELECT CAST(id_coord AS INT), lon, lat, 1 FROM points")
def _(t):
    return V.union_features(t.polygons.select("poly_id", "x", "y"), t.points.select(F.col("id_coord").cast("int").alias("poly_id"), F.col("lon").alias("x"), F.col("lat").alias("y")))


@query("j13_overlay", f"WITH {_RAST} SELECT poly_id, COUNT(*) AS n_cells, COUNT(m.cell_id) AS n_in_zone FROM cov LEFT JOIN mask AS m ON m.cell_id = cov.cell_id GROUP BY 1")
def _(t):
    return V.overlaps(V.rasterize(t.polygons, t.cells), t.mask)


def _patch_sql(col: str, eight: bool = True, where: str = "TRUE") -> str:
    """Labels by flooding from every cell that no smaller neighbour reaches first."""
    near = "n.row BETWEEN c.row - 1 AND c.row + 1 AND n.col BETWEEN c.col - 1 AND c.col + 1" if eight else "abs(n.row - c.row) + abs(n.col - c.col) = 1"
    return f"""src AS (SELECT cell_id, row, col, {col} AS k FROM cells WHERE {where}),
 e AS MATERIALIZED (SELECT c.cell_id AS a, n.cell_id AS b FROM src AS c JOIN src AS n ON n.k = c.k AND {near} AND n.cell_id <> c.cell_id),
 reach(a, b) AS (SELECT cell_id, cell_id FROM src UNION SELECT r.a, e.b FROM reach AS r JOIN e ON e.a = r.b WHERE e.b > r.a),
 lab AS (SELECT s.cell_id, s.row, s.col, s.k AS class, MIN(r.a) AS patch FROM src AS s JOIN reach AS r ON r.b = s.cell_id GROUP BY ALL)"""


@query("g20_patches", f"WITH {_patch_sql('lulc_2022')} SELECT cell_id, row, col, class, patch FROM lab")
def _(t):
    return P.patches(t.cells, "lulc_2022", 8)


@query("g20_patches_4", f"WITH {_patch_sql('lulc_2022', False)} SELECT cell_id, row, col, class, patch FROM lab")
def _(t):
    return P.patches(t.cells, "lulc_2022", 4, tile=16)


_LIKE = "(SELECT c.class, COUNT(*) / 2.0::DOUBLE AS lk FROM lab AS c JOIN lab AS n ON n.class = c.class AND abs(n.row - c.row) + abs(n.col - c.col) = 1 GROUP BY 1)"
_MAXG = "(2 * floor(sqrt(n_cells)) * (floor(sqrt(n_cells)) - 1) + CASE WHEN n_cells = pow(floor(sqrt(n_cells)), 2) THEN 0 WHEN n_cells - pow(floor(sqrt(n_cells)), 2) <= floor(sqrt(n_cells)) THEN 2 * (n_cells - pow(floor(sqrt(n_cells)), 2)) - 1 ELSE 2 * (n_cells - pow(floor(sqrt(n_cells)), 2)) - 2 END)"
_STATS = f"""sz AS (SELECT class, patch, COUNT(*) AS n FROM lab GROUP BY 1, 2), st AS (SELECT class, AVG(n) AS mean_patch_area, stddev_samp(n) AS sd_patch_area, COUNT(*) AS n_patches, CAST(SUM(n) AS BIGINT) AS n_cells FROM sz GROUP BY 1),
 cs AS (SELECT st.class, mean_patch_area, sd_patch_area, n_patches, n_cells, COALESCE(lk, 0) AS "like", COALESCE(COALESCE(lk, 0) * 100 / NULLIF({_MAXG}, 0), 0) AS aggregation_index FROM st LEFT JOIN {_LIKE} AS l ON l.class = st.class)"""


@query("a17_class_stats", f'WITH {_patch_sql("lulc_2022")}, {_STATS} SELECT class, round(mean_patch_area, 6) AS mean_patch_area, round(sd_patch_area, 6) AS sd_patch_area, n_patches, n_cells, "like", round(aggregation_index, 6) AS aggregation_index FROM cs')
def _(t):
    return P.class_stats(P.patches(t.cells, "lulc_2022", 8))


@query("a18_allocation_params", f"""WITH {_patch_sql("region * 1000000 + lulc_2018 * 1000 + lulc_2022", where="lulc_2018 <> lulc_2022")}, {_STATS},
 ex AS (SELECT c.region * 1000000 + c.lulc_2018 * 1000 + c.lulc_2022 AS t, AVG(CASE WHEN EXISTS (SELECT 1 FROM cells AS n WHERE n.row BETWEEN c.row - 1 AND c.row + 1 AND n.col BETWEEN c.col - 1 AND c.col + 1 AND n.cell_id <> c.cell_id AND n.lulc_2022 = c.lulc_2022 AND n.region = c.region) THEN 100.0::DOUBLE ELSE 0 END) AS pe FROM cells AS c WHERE c.lulc_2018 <> c.lulc_2022 GROUP BY 1)
 SELECT CAST(floor(t / 1000000) AS INT) AS region, CAST(floor(t / 1000) % 1000 AS INT) AS from_v, CAST(t % 1000 AS INT) AS to_v, round(mean_patch_area, 6) AS mean_patch_area, round(sd_patch_area, 6) AS sd_patch_area, round(aggregation_index / 70, 6) AS isometry, round(pe, 6) AS perc_expander, round(100 - pe, 6) AS perc_patcher FROM cs JOIN ex ON class = t""")
def _(t):
    return P.allocation_params(t.cells, "lulc_2018", "lulc_2022")


_SIDES = "sd AS (SELECT c.class, n.class AS other, COUNT(*) AS n FROM lab AS c JOIN lab AS n ON abs(n.row - c.row) + abs(n.col - c.col) = 1 GROUP BY 1, 2)"
_PERIM = """inn AS (SELECT c.class, c.patch, COUNT(*) AS i FROM lab AS c JOIN lab AS n ON n.patch = c.patch AND abs(n.row - c.row) + abs(n.col - c.col) = 1 GROUP BY 1, 2),
 pp AS (SELECT sz.class, sz.patch, n, 4 * n - COALESCE(i, 0) AS perim FROM sz LEFT JOIN inn ON inn.patch = sz.patch AND inn.class = sz.class)"""
_RIMS = "rm AS (SELECT SUM(CAST(4 - k > 0 AS INT)) AS b, SUM(4 - k) AS z FROM (SELECT c.cell_id, COUNT(n.cell_id) AS k FROM lab AS c LEFT JOIN lab AS n ON n.row BETWEEN c.row - 1 AND c.row + 1 AND n.col BETWEEN c.col - 1 AND c.col + 1 AND abs(n.row - c.row) + abs(n.col - c.col) = 1 GROUP BY 1))"
_LEAST = "(CASE WHEN {a} = pow(floor(sqrt({a})), 2) THEN 4 * floor(sqrt({a})) WHEN {a} <= floor(sqrt({a})) * (floor(sqrt({a})) + 1) THEN 4 * floor(sqrt({a})) + 2 ELSE 4 * floor(sqrt({a})) + 4 END)"


@query("a24_landscape_metrics", f"""WITH {_patch_sql("lulc_2022")}, {_STATS}, {_SIDES},
 un AS (SELECT class, SUM(n) AS u FROM sd WHERE class <> other GROUP BY 1), en AS (SELECT sd.class, -SUM(n / u * ln(n / u)) AS h FROM sd JOIN un ON un.class = sd.class WHERE sd.class <> other GROUP BY 1),
 sq AS (SELECT class, SUM(n * n)::DOUBLE AS sq FROM sz GROUP BY 1), tt AS (SELECT SUM(n)::DOUBLE AS t, COUNT(DISTINCT class) AS m FROM sz)
 SELECT cs.class, round(aggregation_index, 6) AS ai, round(1 - sq / (t * t), 6) AS division, round(h / ln(m - 1) * 100, 6) AS iji, round(sq / t * 0.09::DOUBLE, 6) AS mesh, n_patches AS np, round("like" * 200 / (4 * n_cells), 6) AS pladj, round(t * t / sq, 6) AS split FROM cs JOIN sq ON sq.class = cs.class JOIN en ON en.class = cs.class, tt""")
def _(t):
    out = P.landscape_metrics(P.patches(t.cells, "lulc_2022", 8), 30.0)
    return out.select("class", "ai", "division", "iji", "mesh", "np", "pladj", "split")


@query("a24_shape_metrics", f"""WITH {_patch_sql("lulc_2022")}, {_STATS}, {_PERIM}, {_RIMS}, tt AS (SELECT SUM(n)::DOUBLE AS t FROM sz),
 b AS (SELECT class, COUNT(*) AS np, SUM(n)::DOUBLE AS a, SUM(perim)::DOUBLE AS p, SUM(perim * sqrt(n)) AS ps FROM pp GROUP BY 1),
 x AS (SELECT b.*, t, rm.b AS rim, z, {_LEAST.format(a="a")} AS lo, "like" * 2 AS lk FROM b JOIN cs ON cs.class = b.class, tt, rm),
 y AS (SELECT *, lk / (4 * a - lo) AS g, a / t AS s, CASE WHEN 2 * a <= t THEN 4 * a WHEN a <= 0.5 * (t + rim + t % 2) THEN 3 * t - 2 * a + 3 * (t % 2) ELSE z + 4 * (t - a) END AS hi FROM x)
 SELECT class, round(CASE WHEN g < s AND s < 0.5 THEN (g - s) / s ELSE (g - s) / (1 - s) END, 6) AS clumpy, round((1 - p / ps) * 100 / (1 - 1 / sqrt(t)), 6) AS cohesion, round(p / lo, 6) AS lsi, round((p - lo) / (hi - lo), 6) AS nlsi, round(np / (t * 900) * 1000000, 6) AS pd FROM y""")
def _(t):
    return P.landscape_metrics(P.patches(t.cells, "lulc_2022", 8), 30.0).select("class", "clumpy", "cohesion", "lsi", "nlsi", "pd")


@query("a24_masked_metrics", f"""WITH {_patch_sql("lulc_2022", where="cell_id IN (SELECT cell_id FROM mask)")}, {_STATS} SELECT class, round(aggregation_index, 6) AS ai, n_patches AS np FROM cs""")
def _(t):
    inside = t.cells.join(t.mask.select("cell_id"), "cell_id", "left_semi")
    return P.landscape_metrics(P.patches(inside, "lulc_2022", 8), 30.0).select("class", "ai", "np")


@query("a24_landscape_level", f"""WITH {_patch_sql("lulc_2022")}, {_STATS}, {_SIDES}, {_PERIM}, {_RIMS}, tt AS (SELECT SUM(n)::DOUBLE AS t, COUNT(*) AS np, SUM(n * n)::DOUBLE AS sq, COUNT(DISTINCT class) AS m, SUM(perim) AS p, SUM(perim * sqrt(n)) AS ps FROM pp),
 q AS (SELECT sd.class, other, n, n_cells / (SELECT t FROM tt) * n / SUM(n) OVER (PARTITION BY sd.class) AS q FROM sd JOIN st ON st.class = sd.class),
 ux AS (SELECT SUM(n)::DOUBLE AS e FROM sd WHERE class < other), ij AS (SELECT -SUM(n / e * ln(n / e)) AS h FROM sd, ux WHERE class < other), ag AS (SELECT SUM(aggregation_index * n_cells) AS s FROM cs)
 SELECT round(s / t, 6) AS ai, round((1 - p / ps) * 100 / (1 - 1 / sqrt(t)), 6) AS cohesion, round((1 + (SELECT SUM(q * ln(q)) FROM q) / (2 * ln(m))) * 100, 6) AS contag, round(1 - sq / (t * t), 6) AS division, round(h / ln(0.5 * m * (m - 1)) * 100, 6) AS iji, round((e + z) / {_LEAST.format(a="t")}, 6) AS lsi, round(sq / t * 0.09::DOUBLE, 6) AS mesh, np, round(np / (t * 900) * 1000000, 6) AS pd, round((SELECT SUM(n) FROM q WHERE class = other) * 100.0::DOUBLE / (4 * t), 6) AS pladj, round(t * t / sq, 6) AS split FROM tt, ux, ij, ag, rm""")
def _(t):
    return P.landscape_level(P.patches(t.cells, "lulc_2022", 8), 30.0)


_ENN = f"{_patch_sql('lulc_2022')}, d AS (SELECT c.class, c.patch, 30 * sqrt(MIN(pow(c.row - n.row, 2) + pow(c.col - n.col, 2))) AS enn FROM lab AS c JOIN lab AS n ON n.class = c.class AND n.patch <> c.patch GROUP BY 1, 2)"
_SPREAD = "COUNT(*) AS n, round(AVG(enn), 6) AS enn_mn, round(stddev_pop(enn), 6) AS enn_sd, round(stddev_pop(enn) / AVG(enn) * 100, 6) AS enn_cv FROM d"


@query("a24_enn", f"WITH {_ENN} SELECT class, {_SPREAD} GROUP BY 1")
def _(t):
    return P.enn_metrics(P.patches(t.cells, "lulc_2022", 8), 30.0)


@query("a24_enn_landscape", f"WITH {_ENN} SELECT {_SPREAD}")
def _(t):
    return P.enn_metrics(P.patches(t.cells, "lulc_2022", 8), 30.0, level="landscape")


_PRIO = "(SELECT c.cell_id, elevation FROM cells AS c WHERE cell_id NOT IN (SELECT cell_id FROM mask) AND lulc_2022 <> 105)"


@query("a26_top_bins", f"""WITH p AS {_PRIO}, h AS (SELECT CAST(floor((elevation - (SELECT MIN(elevation) FROM p)) / 20000) AS BIGINT) AS bin, COUNT(*) AS n FROM p GROUP BY 1), u AS (SELECT *, CAST(SUM(n) OVER (ORDER BY bin DESC) AS BIGINT) AS n_above FROM h)
 SELECT bin, n, n_above, n_above - n < 2000 AS needed FROM u""")
def _(t):
    prio = K.candidate_priority(t.cells, [t.mask, t.cells.filter("lulc_2022 = 105")])
    return K.top_bins_for_target(prio, "elevation", 20000.0, 2000)


@query("a29_coverage_gap", """WITH e AS (SELECT poly_id, abs(SUM(x * COALESCE(ny, fy) - COALESCE(nx, fx) * y)) / 2 AS area FROM (SELECT *, lead(x) OVER w AS nx, lead(y) OVER w AS ny, first(x) OVER w AS fx, first(y) OVER w AS fy FROM polygons WINDOW w AS (PARTITION BY poly_id ORDER BY seq)) GROUP BY 1),
 h AS (SELECT SUM(CASE WHEN poly_id % 3 = 0 THEN area ELSE 100 + poly_id END) AS p FROM e)
 SELECT scenario, target, round(p / 20000, 6) AS share, CAST(ceil(greatest(0, target - p / 20000) * 20000 / 4) AS BIGINT) AS cells_needed FROM h, (VALUES ('BAU', 0.1::DOUBLE), ('NAT', 0.9::DOUBLE)) AS t(scenario, target)""")
def _(t):
    ids = t.polygons.select("poly_id").distinct()
    areas = ids.withColumn("area", F.when(F.col("poly_id") % 3 != 0, 100.0 + F.col("poly_id")))
    return K.coverage_gap(areas, K.polygon_areas(t.polygons), 20000.0, t.spark.createDataFrame([("BAU", 0.1), ("NAT", 0.9)], "scenario string, target double"), 4.0)


@query("t15_combine_protected", "SELECT cell_id FROM cells WHERE lulc_2018 IN (102, 104) UNION SELECT cell_id FROM mask")
def _(t):
    return K.combine_protected(t.cells.withColumnRenamed("lulc_2018", "type"), [102, 104], t.mask)


@query("t16_candidate_priority", f"SELECT cell_id, elevation FROM {_PRIO}")
def _(t):
    return K.candidate_priority(t.cells.select("cell_id", "elevation"), [t.mask, t.cells.filter("lulc_2022 = 105")])


_CAND = _patch_sql("1", where="elevation > 250000") + ", pt AS (SELECT patch, COUNT(*) AS n, median(elevation) AS priority FROM lab JOIN cells AS g ON g.cell_id = lab.cell_id GROUP BY 1 HAVING COUNT(*) >= 3)"


def _candidates(t):
    high = t.cells.filter("elevation > 250000").withColumn("one", F.lit(1))
    return K.candidate_patches(t.cells, P.patches(high, "one", 8), "elevation")


@query("t17_candidate_patches", f"WITH {_CAND} SELECT patch, n, round(priority, 6) AS priority FROM pt")
def _(t):
    return _candidates(t)


def _pick(order: str = "priority DESC, n DESC, patch", target: int = 60) -> str:
    """First fit, a patch after the other."""
    return f"""rk AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY {order}) AS rank FROM pt),
 ff(rank, patch, n, priority, chosen, room) AS (SELECT 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::DOUBLE, FALSE, {target}::BIGINT UNION ALL SELECT rk.rank, rk.patch, rk.n, rk.priority, rk.n <= room, room - CASE WHEN rk.n <= room THEN rk.n ELSE 0 END FROM ff JOIN rk ON rk.rank = ff.rank + 1),
 ch AS (SELECT patch, n, priority, CAST(rank AS INT) AS rank, chosen FROM ff WHERE rank > 0)"""


_PICK = _pick()


@query("t18_select_to_budget", f"WITH {_CAND}, {_PICK} SELECT patch, n, round(priority, 6) AS priority, rank, chosen FROM ch")
def _(t):
    return K.select_to_budget(_candidates(t), 60)


@query("t18_small_patches", f"WITH {_CAND}, {_pick('n, priority DESC, patch', 500)} SELECT patch, n, round(priority, 6) AS priority, rank, chosen FROM ch")
def _(t):
    return K.select_to_budget(_candidates(t), 500, "small")


@query("t18_connectivity", f"WITH {_CAND.replace(', pt AS', ', p0 AS')}, gp AS (SELECT patch, MIN(pow(l.row - m.row, 2) + pow(l.col - m.col, 2)) AS gap FROM lab AS l CROSS JOIN mask AS m GROUP BY 1), pt AS (SELECT p0.*, gap FROM p0 JOIN gp ON gp.patch = p0.patch), {_pick('gap, priority DESC, patch', 200)} SELECT patch, n, round(priority, 6) AS priority, rank, chosen FROM ch")
def _(t):
    high = P.patches(t.cells.filter("elevation > 250000").withColumn("one", F.lit(1)), "one", 8)
    own = K.candidate_patches(t.cells, high, "elevation").join(K.patch_gaps(high, t.mask), "patch")
    return K.select_to_budget(own, 200, "connectivity")


_PHASED = "s AS (SELECT patch, floor((row_number() OVER (ORDER BY rank) - 1) / ceil(COUNT(*) OVER () / {k}.0)) + 1 AS step FROM ch WHERE chosen)"
_TEN_YEARS = [2030, 2040, 2050, 2060]


def _phased(t, *pace):
    return K.phase_in(K.select_to_budget(_candidates(t), 60).filter("chosen"), _TEN_YEARS, *pace)


@query("t19_phase_in", f"WITH {_CAND}, {_PICK}, {_PHASED.format(k=4)} SELECT patch, y AS year FROM s, (VALUES (2030), (2040), (2050), (2060)) AS v(y) WHERE y >= 2020 + 10 * step")
def _(t):
    return _phased(t)


@query("t19_phase_rapid", f"WITH {_CAND}, {_PICK}, {_PHASED.format(k=2)} SELECT patch, y AS year FROM s, (VALUES (2030), (2040), (2050), (2060)) AS v(y) WHERE y >= 2020 + 10 * step")
def _(t):
    return _phased(t, "Rapid")


@query("t19_phase_lagged", f"WITH {_CAND}, {_PICK}, {_PHASED.format(k=1)} SELECT patch, y AS year FROM s, (VALUES (2030), (2040), (2050), (2060)) AS v(y) WHERE y >= 2050")
def _(t):
    return _phased(t, "Lagged", 2050)


@query("t19_protected_cells", f"WITH {_CAND}, {_PICK}, {_PHASED.format(k=4)} SELECT cell_id, y AS year FROM mask, (VALUES (2030), (2040), (2050), (2060)) AS v(y) UNION SELECT cell_id, y FROM s JOIN lab ON lab.patch = s.patch, (VALUES (2030), (2040), (2050), (2060)) AS v(y) WHERE y >= 2020 + 10 * step")
def _(t):
    labels = P.patches(t.cells.filter("elevation > 250000").withColumn("one", F.lit(1)), "one", 8)
    return K.protected_cells(_phased(t), labels, t.mask, _TEN_YEARS)
