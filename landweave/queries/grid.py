"""Queries of cell maps: recoding, filters, masks and resampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from landweave import functions as fn
from landweave.operators import grid as G
from landweave.queries.base import query

_RECLASS = [(101, 1), (102, 2), (103, 3), (104, 3), (105, 4), (0, None)]
_XS = ["x1", "x2", "x3", "x4", "x5", "x6"]


@query("p1_reclassify", "SELECT cell_id, CASE lulc_2022 WHEN 101 THEN 1 WHEN 102 THEN 2 WHEN 103 THEN 3 WHEN 104 THEN 3 WHEN 105 THEN 4 END AS lulc FROM cells")
def _(t):
    return G.reclassify(t.cells.select("cell_id", "lulc_2022"), "lulc_2022", t.spark.createDataFrame(_RECLASS, "old int, new int"), "lulc").drop("lulc_2022")


@query("p2_cut", "SELECT cell_id, CASE WHEN elevation > 0 AND elevation <= 100000 THEN 1 WHEN elevation > 100000 AND elevation <= 200000 THEN 2 WHEN elevation > 200000 AND elevation <= 300000 THEN 3 END AS band FROM cells")
def _(t):
    return t.cells.select("cell_id", fn.cut(F.col("elevation"), [0, 100000, 200000, 300000]).alias("band"))


@query("p3_ifelse", "SELECT c.cell_id, CASE WHEN m.zone IS NULL THEN 0 ELSE m.zone END AS zone0, NULLIF(CASE WHEN elevation > 200000 THEN 1 ELSE 0 END, 0) AS high, CASE WHEN coalesce(m.zone, 0) + CASE WHEN elevation > 200000 THEN 1 ELSE 0 END >= 1 THEN 1 END AS either FROM cells AS c LEFT JOIN mask AS m ON m.cell_id = c.cell_id")
def _(t):
    df = t.cells.join(t.mask.select("cell_id", "zone"), "cell_id", "left")
    zone, high = F.coalesce("zone", F.lit(0)), (F.col("elevation") > 200000).cast("int")
    return df.select("cell_id", zone.alias("zone0"), F.nullif(high, F.lit(0)).alias("high"), F.when(zone + high >= 1, 1).alias("either"))


@query("p4_layerize", "SELECT cell_id, " + ", ".join(f"CAST(lulc_2022 = {v} AS INT) AS is_{v}" for v in range(101, 108)) + " FROM cells")
def _(t):
    return G.layerize(t.cells, "lulc_2022", list(range(101, 108)), ["cell_id"])


@query("p5_change_map", "SELECT cell_id, CASE WHEN lulc_2018 = lulc_2022 THEN NULL ELSE lulc_2022 END AS changed FROM cells")
def _(t):
    return t.cells.select("cell_id", G.change_map(F.col("lulc_2018"), F.col("lulc_2022")).alias("changed"))


@query("p6_transition_response", """SELECT cell_id, region, from_v, to_v, CAST(lulc_2022 = to_v AS INT) AS response FROM cells
 JOIN (SELECT DISTINCT from_v, to_v FROM rates WHERE period = '2018_2022') AS p ON p.from_v = lulc_2018""")
def _(t):
    return G.transition_response(t.cells, t.rates.filter("period = '2018_2022'").select("from_v", "to_v").distinct(), "lulc_2018", "lulc_2022")


@query("p6_response_wide", """SELECT cell_id, region, CASE WHEN lulc_2018 = 101 THEN CAST(lulc_2022 = 102 AS INT) END AS "101-102", CASE WHEN lulc_2018 = 103 THEN CAST(lulc_2022 = 105 AS INT) END AS "103-105" FROM cells WHERE lulc_2018 IN (101, 103)""")
def _(t):
    pairs = [(101, 102), (103, 105)]
    long = G.transition_response(t.cells, t.spark.createDataFrame(pairs, "from_v int, to_v int"), "lulc_2018", "lulc_2022")
    return G.response_wide(long, pairs)


@query("p7_viable", "SELECT DISTINCT lulc_2018 AS from_v, lulc_2022 AS to_v, lulc_2018 || '-' || lulc_2022 AS transition FROM cells WHERE lulc_2018 <> lulc_2022")
def _(t):
    from landweave.operators.rates import viable_table

    return G.viable(viable_table(t.cells, [("2018_2022", "lulc_2018", "lulc_2022")]), "2018_2022")


@query("p8_select_predictors", "SELECT cell_id, CAST(CAST(x1 AS VARCHAR) AS DOUBLE) AS x1, x4 FROM predictors")
def _(t):
    return G.select_predictors(t.predictors.withColumn("x1", F.col("x1").cast("string")), ["cell_id"], ["x1", "x4"])


@query("p9_range_and_list", "SELECT cell_id, region FROM cells WHERE cell_id BETWEEN (SELECT min(cell_id) FROM mask) AND (SELECT max(cell_id) FROM mask) AND cell_id IN (SELECT cell_id FROM mask)")
def _(t):
    ends = t.mask.agg(F.min("cell_id").alias("first"), F.max("cell_id").alias("last"))
    inside = t.cells.crossJoin(F.broadcast(ends)).filter("cell_id BETWEEN first AND last")
    return inside.join(t.mask.select("cell_id"), "cell_id", "left_semi").select("cell_id", "region")


@query("p10_complete_cases", "SELECT region, COUNT(*) AS n_before, CAST(SUM(CASE WHEN x5 IS NOT NULL AND x1 IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_after FROM predictors GROUP BY region")
def _(t):
    return G.complete_cases(t.predictors, ["x1", "x5"], ["region"])


@query("p11_drop_constant", "SELECT cell_id, round(x1, 6) AS x1, round(x2, 6) AS x2, round(x3, 6) AS x3, x4, x5 FROM predictors")
def _(t):
    return G.drop_constant(t.predictors.drop("region"), _XS)


@query("p12_rescale01", "SELECT cell_id, round((x1 - MIN(x1) OVER ()) / (MAX(x1) OVER () - MIN(x1) OVER ()), 6) AS x1, round(1 - (x4 - MIN(x4) OVER ()) / (MAX(x4) OVER () - MIN(x4) OVER ()), 6) AS x4 FROM predictors")
def _(t):
    return G.rescale01(t.predictors.select("cell_id", "x1", "x4"), {"x1": False, "x4": True})


@query("p13_normalize", "WITH s AS (SELECT AVG(x2) AS m2, stddev_samp(x2) AS s2, AVG(x5) AS m5, stddev_samp(x5) AS s5 FROM predictors) SELECT cell_id, round((x2 - m2) / s2, 6) AS x2, round((x5 - m5) / s5, 6) AS x5 FROM predictors, s")
def _(t):
    return G.normalize(t.predictors.select("cell_id", "x2", "x5"), ["x2", "x5"])


@query("p14_normalize_probs", "WITH s AS (SELECT cell_id, round(SUM(p), 12) AS s FROM probs GROUP BY cell_id) SELECT q.cell_id, to_v, round(CASE WHEN s > 1 THEN p / s ELSE p END, 12) AS p FROM probs AS q JOIN s ON s.cell_id = q.cell_id", digits=12)
def _(t):
    from landweave.operators.potential import normalize_long

    return normalize_long(t.probs).select("cell_id", "to_v", "p")


@query("p15_mask_from_class", "SELECT q.cell_id, from_v, to_v, round(CASE WHEN lulc_2018 = from_v THEN p ELSE 0 END, 6) AS p FROM probs AS q JOIN cells AS c ON c.cell_id = q.cell_id")
def _(t):
    return G.one_hot_masked(t.probs.drop("region"), t.cells, "lulc_2018")


@query("p16_combine_layers", "SELECT cell_id, round(x1 + x2 + x4, 6) AS s, round((x1 + x2 + x4) / 3, 6) AS m, round(x4 * x5, 6) AS p, round(least(x1, x2), 6) AS lo FROM predictors")
def _(t):
    c = F.col
    return t.predictors.select("cell_id", fn.combine([c("x1"), c("x2"), c("x4")], "sum").alias("s"), fn.combine([c("x1"), c("x2"), c("x4")], "mean").alias("m"), fn.combine([c("x4"), c("x5")], "product").alias("p"), fn.combine([c("x1"), c("x2")], "min").alias("lo"))


@query("p17_ordinal_encode", """WITH f AS (SELECT curve_type, MIN(id) AS first FROM demand GROUP BY 1), o AS (SELECT curve_type, CAST(dense_rank() OVER (ORDER BY first, curve_type) AS INT) AS code FROM f)
 SELECT d.curve_type, o.code, CASE d.curve_type WHEN 'Instant growth' THEN 1 WHEN 'Delayed growth' THEN 2 END AS fixed_code, COUNT(*) AS n FROM demand AS d JOIN o ON o.curve_type = d.curve_type GROUP BY ALL""")
def _(t):
    from pyspark.sql import Window

    first = t.demand.groupBy("curve_type").agg(F.min("id").alias("first"))
    codes = first.select("curve_type", F.dense_rank().over(Window.orderBy("first", "curve_type")).alias("code"))
    return t.demand.join(codes, "curve_type").groupBy("curve_type", "code", fn.ordinal(F.col("curve_type"), ["Instant growth", "Delayed growth"]).alias("fixed_code")).agg(F.count("*").alias("n"))


@query("p18_recode", "SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'housing' WHEN 'MACHINERY' THEN 'industry' ELSE c_mktsegment END AS segment, round(c_acctbal, 2) AS amount FROM customer")
def _(t):
    names = t.spark.createDataFrame([("BUILDING", "housing"), ("MACHINERY", "industry")], "old string, new string")
    text = F.concat(F.lit(" "), F.regexp_replace(F.round("c_acctbal", 2).cast("decimal(18,2)").cast("string"), r"\.", ","))
    return G.reclassify(t.customer, "c_mktsegment", names, "new").select("c_custkey", F.coalesce("new", "c_mktsegment").alias("segment"), fn.clean_numeric(text).alias("amount"))


@query("p19_string_helpers", r"""SELECT c_custkey, regexp_extract(c_name, '([0-9]+)', 1) AS digits, len(regexp_extract_all(c_name, '[0-9]')) AS n_digits, replace(c_name, '#', '_') AS plain, split_part(c_name, '#', 1) AS head,
 regexp_matches(c_name, '7$') AS ends7, lower(trim(c_mktsegment)) AS seg, lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS padded, c_mktsegment || '-' || c_nationkey AS joined FROM customer""")
def _(t):
    c = F.col
    return t.customer.select("c_custkey", F.regexp_extract("c_name", "([0-9]+)", 1).alias("digits"), F.size(F.regexp_extract_all("c_name", F.lit("[0-9]"), 0)).cast("long").alias("n_digits"), F.replace(c("c_name"), F.lit("#"), F.lit("_")).alias("plain"), F.split_part("c_name", F.lit("#"), F.lit(1)).alias("head"), c("c_name").rlike("7$").alias("ends7"), F.lower(F.trim("c_mktsegment")).alias("seg"), F.lpad(c("c_nationkey").cast("string"), 3, "0").alias("padded"), F.concat_ws("-", "c_mktsegment", "c_nationkey").alias("joined"))


@query("p20_days_in_month", "SELECT o_orderkey, CAST(day(last_day(o_orderdate)) AS INT) AS days, CAST(day(last_day(make_date(2001, month(o_orderdate), 1))) AS INT) AS fixed_days FROM orders")
def _(t):
    d = F.col("o_orderdate")
    return t.orders.select("o_orderkey", fn.days_in_month(F.year(d), F.month(d)).alias("days"), fn.days_in_month(F.lit(2001), F.month(d)).alias("fixed_days"))


@query("p21_math", "SELECT cell_id, round(sqrt(x1), 6) AS a, round(pow(x4, 1.5::DOUBLE), 6) AS b, round(ln(x1 + 1), 6) AS c, round(abs(x2), 6) AS d, CAST(ceil(x2) AS BIGINT) AS e, CAST(floor(x2) AS BIGINT) AS f, round(least(1, greatest(0, x2 / 10000)), 6) AS g FROM predictors")
def _(t):
    c = F.col
    return t.predictors.select("cell_id", F.sqrt("x1").alias("a"), F.pow("x4", F.lit(1.5)).alias("b"), F.ln(c("x1") + 1).alias("c"), F.abs("x2").alias("d"), F.ceil("x2").alias("e"), F.floor("x2").alias("f"), F.least(F.lit(1.0), F.greatest(F.lit(0.0), c("x2") / 10000)).alias("g"))


@query("p25_periods", "SELECT y AS year_from, n AS year_to, y || '_' || n AS period FROM (SELECT year AS y, lead(year) OVER (ORDER BY year) AS n FROM (SELECT DISTINCT year FROM long_cells)) WHERE n IS NOT NULL")
def _(t):
    from landweave.sources.catalog import periods

    return periods(t.long_cells.select("year").distinct())


@query("p26_region_ids", "SELECT CAST(row_number() OVER (ORDER BY l, n_name) AS INT) AS value, l AS label, n_name AS pretty FROM (SELECT lower(regexp_replace(trim(n_name), '[^A-Za-z0-9]+', '_', 'g')) AS l, n_name FROM nation)")
def _(t):
    from pyspark.sql import Window

    rows = t.nation.select(fn.clean_label(F.col("n_name")).alias("label"), F.col("n_name").alias("pretty"))
    return rows.select(F.row_number().over(Window.orderBy("label", "pretty")).alias("value"), "label", "pretty")


@query("p27_pre_period_years", "SELECT DISTINCT year, CAST(year - k AS INT) AS before FROM long_cells, (VALUES (1), (2), (3), (4)) AS v(k)")
def _(t):
    from landweave.sources.catalog import pre_period_years

    return pre_period_years(t.long_cells.select("year").distinct(), 4)


@query("s2_valid_cells", """SELECT CAST(row_number() OVER (ORDER BY cell_id) AS BIGINT) AS row_idx, cell_id, row, col, lulc_2022 AS value FROM cells""")
def _(t):
    grid = t.cells.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("col", "lulc_2022"))).alias("m"))
    rows = grid.select("row", F.transform(F.sequence(F.lit(1), F.lit(100)), lambda k: F.try_element_at("m", k)).alias("values"))
    return G.valid_cells(rows, 100)


_GRIDS = [("ref", 10, 20, 0.0, 5.0, 1.0, 1.0, "A"), ("near", 10, 20, 1e-12, 5.0, 1.0, 1.0, "A"), ("rows", 11, 20, 0.0, 5.0, 1.0, 1.0, "A"), ("shift", 10, 20, 0.5, 5.0, 1.0, 1.0, "A"), ("res", 10, 20, 0.0, 5.0, 2.0, 2.0, "A"), ("crs", 10, 20, 0.0, 5.0, 1.0, 1.0, "B")]


@query("g1_check_grids", """WITH g AS (SELECT year, CAST(max(row) AS INT) AS nrow, CAST(max(col) AS INT) AS ncol, CAST(min(col) - 1 + CASE WHEN year = 2014 THEN 0.5 ELSE 0 END AS DOUBLE) AS xmin FROM (SELECT l.year, c.row, c.col FROM long_cells AS l JOIN cells AS c ON c.cell_id = l.cell_id WHERE NOT (l.year = 2018 AND c.row > 10)) GROUP BY year),
 r AS (SELECT * FROM g WHERE year = 2010)
 SELECT CAST(g.year AS VARCHAR) AS name, concat_ws(',', CASE WHEN g.nrow <> r.nrow THEN 'nrow' END, CASE WHEN g.ncol <> r.ncol THEN 'ncol' END, CASE WHEN abs(g.xmin - r.xmin) >= 1e-10 THEN 'xmin' END) AS differs FROM g, r WHERE g.year <> 2010""")
def _(t):
    rows = t.long_cells.join(t.cells.select("cell_id", "row", "col"), "cell_id").filter("NOT (year = 2018 AND row > 10)")
    meta = rows.groupBy(F.col("year").cast("string").alias("name")).agg(F.max("row").alias("nrow"), F.max("col").alias("ncol"), (F.min("col") - 1).cast("double").alias("xmin"))
    meta = meta.withColumns({"xmin": F.col("xmin") + F.when(F.col("name") == "2014", 0.5).otherwise(0.0), "ymax": F.lit(0.0), "xres": F.lit(1.0), "yres": F.lit(1.0), "crs": F.lit("A")})
    return G.check_grids(meta, "2010")


@query("g2_mask", "SELECT c.cell_id, CASE WHEN m.cell_id IS NULL THEN lulc_2022 ELSE 0 END AS lulc_2022 FROM cells AS c LEFT JOIN mask AS m ON m.cell_id = c.cell_id WHERE c.cell_id NOT IN (SELECT cell_id FROM cells WHERE region = 4)")
def _(t):
    rest = G.mask(t.cells.select("cell_id", "lulc_2022"), t.cells.filter("region = 4"), inverse=True)
    return G.mask(rest, t.mask, inverse=True, value="lulc_2022", update=0)


@query("g3_extend_trim", """WITH b AS (SELECT min(row) AS r0, max(row) AS r1, min(col) AS c0, max(col) AS c1 FROM mask)
 SELECT CAST((r - 1) * 100 + c AS BIGINT) AS cell_id, CAST(r AS INT) AS row, CAST(c AS INT) AS col, lulc_2022 FROM b, (SELECT unnest(range(1, (SELECT max(row) FROM mask) + 1))) AS x(r), range(1, 101) AS y(c) LEFT JOIN cells ON cell_id = (r - 1) * 100 + c WHERE r BETWEEN r0 AND r1 AND c BETWEEN c0 AND c1""")
def _(t):
    box = G.bounding_box(t.mask)
    height = box.first()["row_max"] or 0
    inside = G.full_grid(t.spark, height, 100).crossJoin(F.broadcast(box)).filter("row BETWEEN row_min AND row_max AND col BETWEEN col_min AND col_max").select("cell_id", "row", "col")
    return G.extend(t.cells, inside, ["lulc_2022"])


_UP = "(SELECT CAST(floor((row - 1) / 3.0) AS INT) + 1 AS r, CAST(floor((col - 1) / 3.0) AS INT) + 1 AS c, * FROM cells)"


@query("g4_resample_modal", f"SELECT r AS row, c AS col, v AS value FROM (SELECT r, c, lulc_2022 AS v, COUNT(*) AS n FROM {_UP} GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY r, c ORDER BY n DESC, v) = 1")
def _(t):
    return G.coarser(t.cells, 3, "lulc_2022", "modal")


@query("g4_resample_stats", f"""SELECT r AS row, c AS col, round(AVG(elevation), 6) AS average, MIN(elevation) AS min, MAX(elevation) AS max, round(quantile_cont(elevation, 0.5), 6) AS med, round(quantile_cont(elevation, 0.25), 6) AS q1, round(quantile_cont(elevation, 0.75), 6) AS q3 FROM {_UP} GROUP BY ALL""")
def _(t):
    return G.coarser_stats(t.cells, 3, "elevation", ["average", "min", "max", "med", "q1", "q3"])


@query("g4_resample_near", f"SELECT r AS row, c AS col, lulc_2022 AS value FROM {_UP} WHERE (row - 1) % 3 = 1 AND (col - 1) % 3 = 1")
def _(t):
    return G.coarser(t.cells, 3, "lulc_2022", "near")


@query("g4_resample_bilinear", """WITH f AS (SELECT CAST(R AS INT) AS row, CAST(C AS INT) AS col, (R - 0.5::DOUBLE) / 2 + 0.5 AS y, (C - 0.5::DOUBLE) / 2 + 0.5 AS x FROM (SELECT unnest(range(1, 2 * (SELECT max(row) FROM cells) + 1))) AS a(R), range(1, 201) AS b(C)),
 q AS (SELECT f.*, CAST(floor(y) AS INT) + i AS r, CAST(floor(x) AS INT) + j AS k FROM f, (VALUES (0), (1)) AS di(i), (VALUES (0), (1)) AS dj(j)),
 w AS (SELECT q.row, q.col, elevation, (1 - abs(y - c.row)) * (1 - abs(x - c.col)) AS w FROM q JOIN cells AS c ON c.row = r AND c.col = k)
 SELECT row, col, round(SUM(w * elevation), 6) AS value FROM w GROUP BY ALL HAVING SUM(w) > 1 - 1e-9""")
def _(t):
    return G.finer(t.cells, 2, "elevation", "bilinear")


@query("g5_extract", "SELECT m.cell_id, c.lulc_2022 AS lulc, round(x1, 6) AS x1 FROM mask AS m LEFT JOIN cells AS c ON c.cell_id = m.cell_id LEFT JOIN predictors AS p ON p.cell_id = m.cell_id")
def _(t):
    return G.extract(t.mask.select("cell_id"), {"lulc": (t.cells, "lulc_2022"), "x1": (t.predictors, "x1")})


@query("g6_with_xy", "SELECT cell_id, CAST(floor((cell_id - 1) / 100.0) AS INT) + 1 AS row, CAST((cell_id - 1) % 100 AS INT) + 1 AS col, round(1000 + (col - 0.5::DOUBLE) * 30, 6) AS x, round(5000 - (row - 0.5::DOUBLE) * 30, 6) AS y FROM cells")
def _(t):
    r, c = G.row_col(F.col("cell_id"), 100)
    return G.with_xy(t.cells.select("cell_id", r.alias("row"), c.alias("col")), 1000.0, 5000.0, 30.0)


@query("g21_region_view", "WITH o AS (SELECT * FROM cells WHERE region = 2) SELECT cell_id, row - (SELECT min(row) FROM o) + 1 AS row, col - (SELECT min(col) FROM o) + 1 AS col, lulc_2022 FROM o")
def _(t):
    return G.region_view(t.cells, 2).select("cell_id", "row", "col", "lulc_2022")
