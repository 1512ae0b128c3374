"""Queries of aggregations, joins, windows, sets, climate, catalogues and sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
import numpy as np
from pyspark.sql import functions as F

from landweave import functions as fn
from landweave.operators import climate as C
from landweave.operators import quality as Q
from landweave.queries.base import query
from landweave.sources import catalog as S

GCMS = [f"gcm{k}" for k in range(5)]
MONTHS = list(range(1, 13))


@query("a9_zonal", "SELECT region, lulc_2022 AS lulc, round(SUM(elevation), 3) AS total, round(median(elevation), 6) AS mid, COUNT(*) AS n FROM cells GROUP BY 1, 2")
def _(t):
    return Q.zonal(t.cells.withColumnRenamed("lulc_2022", "lulc"), ["region", "lulc"], {"total": F.round(F.sum("elevation"), 3), "mid": F.median("elevation"), "n": F.count("*")})


@query("a9_zonal_fold", "SELECT region, lulc_2022 AS lulc, round(exp(AVG(ln(1 + elevation))) - 1, 6) AS value FROM cells GROUP BY 1, 2")
def _(t):
    return Q.zonal_fold(t.cells.withColumnRenamed("lulc_2022", "lulc"), ["region", "lulc"], "elevation", lambda v: (np.log1p(v).sum(), len(v)), lambda s: np.expm1(s[0] / s[1]))


@query("a10_share_of_parent", "WITH n AS (SELECT CAST(region AS BIGINT) AS region, row, CAST(SUM(CAST(lulc_2022 = 105 AS INT)) AS BIGINT) AS value FROM cells GROUP BY 1, 2) SELECT CAST(region AS INT) AS region, row, value, round(COALESCE(value * 100.0::DOUBLE / NULLIF(SUM(value) OVER (PARTITION BY region), 0), 0), 6) AS perc FROM n")
def _(t):
    return Q.share_of_parent(t.cells.withColumn("urban", (F.col("lulc_2022") == 105).cast("long")), "row", "region", "urban")


@query("a11_allocate_population", """WITH n AS (SELECT region, row, SUM(CAST(lulc_2022 = 105 AS INT)) AS v FROM cells GROUP BY 1, 2), w AS (SELECT region, row, COALESCE(v::DOUBLE / NULLIF(SUM(v) OVER (PARTITION BY region), 0), 0) AS w FROM n)
 SELECT c.cell_id, y AS year, round(w * (1000.0::DOUBLE * c.region + y), 6) AS population FROM cells AS c JOIN w ON w.region = c.region AND w.row = c.row, (VALUES (2030), (2060)) AS p(y)""")
def _(t):
    shares = Q.share_of_parent(t.cells.withColumn("urban", (F.col("lulc_2022") == 105).cast("long")), "row", "region", "urban")
    years = t.spark.createDataFrame([(2030,), (2060,)], "year int")
    proj = t.cells.select("region").distinct().crossJoin(years).withColumn("total", F.lit(1000.0) * F.col("region") + F.col("year"))
    return Q.allocate_population(shares, proj, t.cells.select("cell_id", "row", "region"), "row", "region")


@query("a12_null_profile", " UNION ALL ".join(f"SELECT '{c}' AS column_name, COUNT(*) - COUNT({c}) AS n_null, round((COUNT(*) - COUNT({c}))::DOUBLE / COUNT(*), 6) AS share FROM predictors" for c in ("x1", "x2", "x5")))
def _(t):
    return Q.null_profile(t.predictors, ["x1", "x2", "x5"])


@query("a13_sanity_summary", """WITH r AS (SELECT region, cell_id, x5 FROM predictors UNION ALL SELECT region, cell_id, x5 FROM predictors WHERE cell_id % 7 = 0),
 k AS (SELECT region, cell_id, COUNT(*) AS k, SUM(CAST(x5 IS NULL AS INT)) AS z FROM r GROUP BY 1, 2)
 SELECT region, CAST(SUM(k) AS BIGINT) AS n_rows, COUNT(*) AS n_keys, CAST(SUM(CAST(k > 1 AS INT)) AS BIGINT) AS n_duplicates, CAST(SUM(z) AS BIGINT) AS n_nulls FROM k GROUP BY region""")
def _(t):
    rows = t.predictors.select("region", "cell_id", "x5")
    return Q.sanity_summary(rows.unionByName(rows.filter("cell_id % 7 = 0")), "region", "cell_id", ["x5"])


@query("a14_verify_alignment", "SELECT COUNT(*) AS n, CAST(SUM(CASE WHEN c.region <> CASE WHEN p.cell_id % 50 = 0 THEN 9 ELSE p.region END THEN 1 ELSE 0 END) AS BIGINT) AS n_mismatch, CAST(SUM(CAST(p.cell_id IS NULL AS INT)) AS BIGINT) AS n_missing FROM cells AS c LEFT JOIN (SELECT * FROM predictors WHERE cell_id % 11 <> 0) AS p ON p.cell_id = c.cell_id")
def _(t):
    mask = t.predictors.filter("cell_id % 11 <> 0").select("cell_id", F.when(F.col("cell_id") % 50 == 0, 9).otherwise(F.col("region")).alias("region"))
    return Q.verify_alignment(t.cells, mask, "region")


@query("a27_aggregate_metrics", "SELECT curve_type AS model, scenario AS metric, round(AVG(slider_value), 6) AS mean, round(stddev_samp(slider_value), 6) AS sd, round(MIN(slider_value), 6) AS min, round(MAX(slider_value), 6) AS max FROM demand GROUP BY 1, 2")
def _(t):
    from landweave.operators.ml import aggregate_metrics

    return aggregate_metrics(t.demand.select(F.col("curve_type").alias("model"), F.col("scenario").alias("metric"), F.col("slider_value").alias("value")))


@query("a28_district_sums", "WITH s AS (SELECT row AS district, SUM(elevation) AS total FROM cells GROUP BY 1) SELECT cell_id, round(total, 3) AS total FROM cells JOIN s ON district = row")
def _(t):
    sums = Q.zonal(t.cells.withColumnRenamed("row", "district"), ["district"], {"total": F.round(F.sum("elevation"), 3)})
    return t.cells.join(sums, F.col("row") == F.col("district")).select("cell_id", "total")


@query("j1_inner_chain", "SELECT c.cell_id, c.lulc_2022, round(p.x1, 6) AS x1, m.zone FROM cells AS c JOIN predictors AS p USING (cell_id) JOIN mask AS m USING (cell_id)")
def _(t):
    return reduce(lambda a, b: a.join(b, "cell_id"), [t.cells.select("cell_id", "lulc_2022"), t.predictors.select("cell_id", "x1"), t.mask.select("cell_id", "zone")])


@query("j2_lookup", "SELECT cell_id, class_name FROM cells LEFT JOIN (SELECT * FROM classes WHERE value <> 104) AS k ON value = lulc_2022")
def _(t):
    return t.cells.join(t.classes.filter("value <> 104"), F.col("lulc_2022") == F.col("value"), "left").select("cell_id", "class_name")


@query("j3_full_outer", "SELECT cell_id, round(x1, 6) AS x1, zone FROM (SELECT cell_id, x1 FROM predictors WHERE cell_id % 3 <> 0) FULL JOIN (SELECT cell_id, zone FROM mask) USING (cell_id)")
def _(t):
    return t.predictors.filter("cell_id % 3 <> 0").select("cell_id", "x1").join(t.mask.select("cell_id", "zone"), "cell_id", "full")


@query("j4_right_outer", "SELECT o_orderkey + 1 AS cell_id, lulc_2022 FROM cells RIGHT JOIN orders ON cell_id = o_orderkey + 1")
def _(t):
    return t.cells.select("cell_id", "lulc_2022").join(t.orders.select((F.col("o_orderkey") + 1).alias("cell_id")), "cell_id", "right")


@query("j5_s13_pending", "SELECT cell_id, region FROM cells WHERE cell_id NOT IN (SELECT cell_id FROM mask)")
def _(t):
    return S.pending(t.cells.select("cell_id", "region"), t.mask, ["cell_id"])


@query("j6_semi", "SELECT region, period, from_v, to_v, n FROM pair_counts AS p WHERE EXISTS (SELECT 1 FROM probs AS q WHERE q.from_v = p.from_v AND q.to_v = p.to_v)")
def _(t):
    return t.pair_counts.join(t.probs.select("from_v", "to_v").distinct(), ["from_v", "to_v"], "left_semi").select("region", "period", "from_v", "to_v", "n")


@query("j7_task_grid", "SELECT r.region, s.scenario, k.lulc FROM (SELECT DISTINCT region FROM cells) AS r, (SELECT DISTINCT scenario FROM demand) AS s, (SELECT DISTINCT lulc FROM long_cells) AS k")
def _(t):
    return t.cells.select("region").distinct().crossJoin(t.demand.select("scenario").distinct()).crossJoin(t.long_cells.select("lulc").distinct())


@query("j8_nearest_year", "WITH y AS (SELECT DISTINCT year FROM long_cells) SELECT CAST(t AS INT) AS target, (SELECT year FROM y ORDER BY abs(year - t), year LIMIT 1) AS year FROM range(2008, 2031) AS r(t)")
def _(t):
    from landweave.operators.joins import nearest_value

    return nearest_value(t.spark.range(2008, 2031).select(F.col("id").cast("int").alias("target")), t.long_cells.select("year").distinct(), "target", "year")


@query("j9_interval_join", "SELECT o_orderkey, year_from, year_to FROM orders JOIN (VALUES (1992, 1993), (1993, 1995), (1995, 1998)) AS p(year_from, year_to) ON year(o_orderdate) > year_from AND year(o_orderdate) <= year_to")
def _(t):
    from landweave.operators.joins import interval_join

    p = t.spark.createDataFrame([(1992, 1993), (1993, 1995), (1995, 1998)], "year_from int, year_to int")
    return interval_join(t.orders.select("o_orderkey", F.year("o_orderdate").alias("y")), p, "y", "year_from", "year_to").drop("y")


@query("j11_overlap_counts", """WITH s AS (SELECT DISTINCT region, cell_id FROM predictors WHERE cell_id % 5 <> 0), d AS (SELECT DISTINCT region, cell_id FROM cells WHERE cell_id % 3 <> 0), x AS (SELECT DISTINCT region, cell_id FROM probs WHERE cell_id % 7 <> 0),
 k AS (SELECT region, cell_id, s.cell_id IS NOT NULL AS s, d.cell_id IS NOT NULL AS d, x.cell_id IS NOT NULL AS t FROM cells AS c LEFT JOIN s USING (region, cell_id) LEFT JOIN d USING (region, cell_id) LEFT JOIN x USING (region, cell_id))
 SELECT region, """ + ", ".join(f"COUNT(*) FILTER ({' AND '.join(x)}) AS n_{x}" for x in ("s", "d", "t", "sd", "st", "dt", "sdt")) + " FROM k WHERE s OR d OR t GROUP BY region")
def _(t):
    return Q.overlap_counts(t.predictors.filter("cell_id % 5 <> 0"), t.cells.filter("cell_id % 3 <> 0"), t.probs.filter("cell_id % 7 <> 0"))


@query("w2_trans_id", "SELECT from_v, to_v, lpad(CAST(row_number() OVER (ORDER BY from_v, to_v) AS VARCHAR), 3, '0') AS trans_id FROM (SELECT DISTINCT from_v, to_v FROM rates)")
def _(t):
    pairs = t.rates.select("from_v", "to_v").distinct()
    return pairs.withColumn("trans_id", F.lpad(F.row_number().over(Window.orderBy("from_v", "to_v")).cast("string"), 3, "0"))


@query("w3_first_per_group", "SELECT gcm, cell_id, month, round(tasmin, 6) AS tasmin FROM climate QUALIFY row_number() OVER (PARTITION BY gcm, cell_id ORDER BY ssp = 'R' DESC, ssp, month) = 1")
def _(t):
    own = Window.partitionBy("gcm", "cell_id").orderBy((F.col("ssp") == "R").desc(), "ssp", "month")
    return t.climate.withColumn("k", F.row_number().over(own)).filter("k = 1").select("gcm", "cell_id", "month", "tasmin")


@query("w4_running_sums", "SELECT region, lulc, n, CAST(SUM(n) OVER (PARTITION BY region ORDER BY lulc) AS BIGINT) AS up, CAST(SUM(n) OVER (PARTITION BY region ORDER BY lulc DESC) AS BIGINT) AS down FROM areas")
def _(t):
    own = Window.partitionBy("region")
    return t.areas.withColumns({"up": F.sum("n").over(own.orderBy("lulc")), "down": F.sum("n").over(own.orderBy(F.col("lulc").desc()))})


@query("w5_lag_lead", "WITH n AS (SELECT region, lulc, year, COUNT(*) AS n FROM long_cells GROUP BY ALL) SELECT *, n - lag(n) OVER w AS step, round((lead(n) OVER w - n)::DOUBLE / (lead(year) OVER w - year), 6) AS slope FROM n WINDOW w AS (PARTITION BY region, lulc ORDER BY year)")
def _(t):
    n = t.long_cells.groupBy("region", "lulc", "year").agg(F.count("*").alias("n"))
    w = Window.partitionBy("region", "lulc").orderBy("year")
    return n.withColumns({"step": F.col("n") - F.lag("n").over(w), "slope": (F.lead("n").over(w) - F.col("n")) / (F.lead("year").over(w) - F.col("year"))})


@query("w6_carry_forward", """WITH d AS (SELECT user_id, event_id, CASE WHEN value < 5 THEN NULL ELSE value END AS v FROM events)
 SELECT user_id, event_id, round(COALESCE(last_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), first_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)), 6) AS v FROM d""")
def _(t):
    from landweave.operators.joins import carry_forward

    return carry_forward(t.events.select("user_id", "event_id", F.when(F.col("value") >= 5, F.col("value")).alias("v")), ["user_id"], "event_id", "v")


@query("w7_thin", """WITH c AS (SELECT region, cell_id, row_number() OVER (PARTITION BY region ORDER BY cell_id) AS rn, COUNT(*) OVER (PARTITION BY region) AS n FROM cells) SELECT region, cell_id FROM c WHERE (rn - 1) % CAST(ceil(n / 100.0) AS BIGINT) = 0""")
def _(t):
    from landweave.operators.joins import thin_evenly

    return thin_evenly(t.cells.select("region", "cell_id"), ["region"], "cell_id", F.lit(100))


@query("w8_split_steps", "WITH c AS (SELECT region, lulc, n, row_number() OVER (PARTITION BY region ORDER BY n DESC, lulc) AS rn, COUNT(*) OVER (PARTITION BY region) AS k FROM areas) SELECT region, lulc, CAST(floor((rn - 1) / ceil(k / 3.0)) + 1 AS INT) AS step FROM c")
def _(t):
    from landweave.operators.conserve import steps_by_rank

    return steps_by_rank(t.areas, ["region"], [F.col("n").desc(), F.col("lulc")], 3).select("region", "lulc", "step")


@query("w10_w11_top_k", "SELECT region, lulc, n FROM areas ORDER BY n DESC, region, lulc LIMIT 5")
def _(t):
    return t.areas.orderBy(F.col("n").desc(), "region", "lulc").limit(5)


@query("w12_rank_solutions", "SELECT region, round(SUM(n * lulc::DOUBLE), 6) AS score, CAST(rank() OVER (ORDER BY SUM(n * lulc::DOUBLE) DESC) AS INT) AS place FROM areas GROUP BY region")
def _(t):
    s = t.areas.groupBy("region").agg(F.sum(F.col("n") * F.col("lulc").cast("double")).alias("score"))
    return s.withColumn("place", F.rank().over(Window.orderBy(F.col("score").desc())))


@query("x1_bind_rows", "SELECT 'static' AS source, cell_id, round(x1, 6) AS x1, CAST(NULL AS INT) AS zone FROM predictors UNION ALL SELECT 'mask', cell_id, NULL, zone FROM mask")
def _(t):
    return t.predictors.select(F.lit("static").alias("source"), "cell_id", "x1").unionByName(t.mask.select(F.lit("mask").alias("source"), "cell_id", "zone"), allowMissingColumns=True)


@query("x2_union_distinct", "SELECT from_v AS node FROM rates UNION SELECT to_v FROM rates")
def _(t):
    return t.rates.select(F.col("from_v").alias("node")).union(t.rates.select("to_v")).distinct()


@query("x3_intersect", "SELECT from_v, to_v FROM rates WHERE period = '2010_2014' INTERSECT SELECT from_v, to_v FROM rates WHERE period = '2018_2022'")
def _(t):
    pick = lambda p: t.rates.filter(F.col("period") == p).select("from_v", "to_v")
    return pick("2010_2014").intersect(pick("2018_2022"))


@query("x4_set_mismatch", "(SELECT cell_id, 'a' AS only_in FROM cells WHERE row <= 40 AND cell_id NOT IN (SELECT cell_id FROM mask)) UNION ALL (SELECT cell_id, 'b' FROM mask WHERE row > 40)")
def _(t):
    return Q.set_mismatch(t.cells.filter("row <= 40"), t.mask, "cell_id")


@query("x5_completeness", """WITH g AS (SELECT cell_id, ssp, gcm, list(DISTINCT month) AS m FROM climate GROUP BY ALL)
 SELECT cell_id, ssp, gcm, len(m) = 12 AS complete, array_to_string(list_sort(list_filter(range(1, 13), lambda x: NOT list_contains(m, x))), ',') AS missing FROM g""")
def _(t):
    return Q.completeness(t.climate, ["cell_id", "ssp", "gcm"], "month", MONTHS)


_FULL = "(SELECT * FROM climate WHERE (cell_id, ssp) IN (SELECT (cell_id, ssp) FROM climate GROUP BY cell_id, ssp HAVING COUNT(DISTINCT gcm) = 5))"


@query("c1_ensemble_yearly", f"WITH g AS (SELECT cell_id, ssp, gcm, AVG(tasmin) AS a, AVG(tasmax) AS b, SUM(pr) AS c, AVG(rsds) AS d FROM {_FULL} GROUP BY 1, 2, 3) SELECT cell_id, ssp, round(AVG(a), 9) AS tasmin, round(AVG(b), 9) AS tasmax, round(AVG(c), 9) AS pr, round(AVG(d), 9) AS rsds FROM g GROUP BY 1, 2", digits=9)
def _(t):
    return C.ensemble_yearly(t.climate, GCMS)


@query("c2_ensemble_monthly", """WITH f AS (SELECT cell_id, ssp, month, AVG(tasmin) AS a, AVG(tasmax) AS b, AVG(pr) AS c FROM climate GROUP BY 1, 2, 3 HAVING COUNT(DISTINCT gcm) = 5), k AS (SELECT cell_id, ssp FROM f GROUP BY 1, 2 HAVING COUNT(*) = 12)
 SELECT f.cell_id, f.ssp, month, round(a, 9) AS tasmin, round(b, 9) AS tasmax, round(c * day(last_day(make_date(2001, month, 1))), 9) AS pr FROM f JOIN k ON k.cell_id = f.cell_id AND k.ssp = f.ssp""", digits=9)
def _(t):
    return C.ensemble_monthly(t.climate, GCMS)


_DAILY = "(SELECT CAST(l_partkey % n AS INT) + 1 AS cell_id, 'R' AS ssp, concat('gcm', CAST(l_suppkey % 2 AS VARCHAR(4))) AS gcm, CAST((l_orderkey * 7 + l_linenumber * 3) % 360 + 1 AS INT) AS band, AVG(l_extendedprice) / 10000 AS pr FROM lineitem CROSS JOIN (SELECT GREATEST(1, FLOOR(COUNT(*) / 400.0)) AS n FROM part) AS k GROUP BY 1, 2, 3, 4)"


@query("c2_monthly_precipitation", f"""WITH d AS {_DAILY}, n AS (SELECT cell_id, gcm FROM d GROUP BY 1, 2 HAVING COUNT(*) = 360), m AS (SELECT d.cell_id, d.gcm, (band - 1) % 12 + 1 AS month, AVG(pr * day(last_day(make_date(2001 + (band - 1) // 12, (band - 1) % 12 + 1, 1)))) AS pr FROM d JOIN n ON n.cell_id = d.cell_id AND n.gcm = d.gcm GROUP BY 1, 2, 3)
 SELECT cell_id, 'R' AS ssp, CAST(month AS INT) AS month, round(AVG(pr), 9) AS pr FROM m GROUP BY 1, 3 HAVING COUNT(*) = 2""", digits=9)
def _(t):
    rows = t.lineitem.sparkSession.sql("SELECT * FROM " + _DAILY.replace("FROM lineitem", "FROM {lineitem}").replace("FROM part", "FROM {part}"), lineitem=t.lineitem, part=t.part)
    return C.monthly_precipitation(rows, ["gcm0", "gcm1"])


@query("c3_historic_layers", "WITH x AS (SELECT cell_id, month, unnest(['tasmin', 'tasmax', 'pr', 'rsds']) AS variable, unnest([tasmin, tasmax, pr, CASE WHEN month = 1 THEN rsds END]) AS value FROM climate WHERE gcm = 'gcm1' AND ssp = 'R') SELECT cell_id, variable, round(CASE WHEN variable = 'pr' THEN SUM(value) ELSE AVG(value) END, 9) AS value FROM x WHERE value IS NOT NULL GROUP BY 1, 2 HAVING COUNT(*) IN (1, 12)", digits=9)
def _(t):
    rows = t.climate.filter("gcm = 'gcm1' AND ssp = 'R'")
    return C.historic_layers(rows.withColumn("rsds", F.when(F.col("month") == 1, F.col("rsds"))))


@query("c4_missing_gcms", """WITH g AS (SELECT cell_id, ssp, month, list(DISTINCT gcm) AS m FROM climate WHERE tasmax > 28 GROUP BY ALL)
 SELECT cell_id, ssp, month, array_to_string(list_filter(['gcm0', 'gcm1', 'gcm2', 'gcm3', 'gcm4'], lambda x: NOT list_contains(m, x)), ',') AS missing FROM g WHERE len(m) < 5""")
def _(t):
    return C.missing_gcms(t.climate.filter("tasmax > 28"), ["cell_id", "ssp", "month"], GCMS)


@query("c5_monthly_climatology", "SELECT cell_id, month, round(AVG(rsds), 9) AS rsds, COUNT(DISTINCT gcm) AS n_files FROM climate GROUP BY 1, 2 HAVING COUNT(DISTINCT gcm) >= 2", digits=9)
def _(t):
    return C.monthly_climatology(t.climate, "rsds", "gcm")


@query("c6_et0_turc", """WITH m AS (SELECT cell_id, month, AVG(tasmin) AS a, AVG(tasmax) AS b, AVG(rsds) AS r FROM climate GROUP BY 1, 2), e AS (SELECT cell_id, month, CASE WHEN (a + b) / 2 > 0 THEN ((a + b) / 2) / ((a + b) / 2 + 15) ELSE 0 END * (0.3107::DOUBLE * r + 0.65::DOUBLE) * day(last_day(make_date(2001, month, 1))) AS e FROM m)
 SELECT cell_id, round(SUM(e), 9) AS et0 FROM e GROUP BY 1 HAVING COUNT(*) = 12""", digits=9)
def _(t):
    m = t.climate.groupBy("cell_id", "month").agg(*(F.avg(c).alias(c) for c in ("tasmin", "tasmax", "rsds")))
    return C.et0_turc(m)


@query("c7_quick_stats", "SELECT ssp, month, round(MIN(pr), 9) AS min, round(AVG(pr), 9) AS mean, round(MAX(pr), 9) AS max FROM climate GROUP BY 1, 2", digits=9)
def _(t):
    return C.quick_stats(t.climate, ["ssp", "month"], "pr")


@query("s8_read_interventions", """SELECT user_id, CAST(trim(x) AS INT) AS time_step, replace(k, ' ', '') AS target FROM (SELECT user_id, unnest(string_split(' ' || (2000 + user_id % 7) || ', ' || (2010 + user_id % 5), ',')) AS x, unnest(string_split('urban, ' || event_type, ',')) AS k FROM events)""")
def _(t):
    raw = t.events.select("user_id", F.concat(F.lit(" "), 2000 + F.col("user_id") % 7, F.lit(", "), 2010 + F.col("user_id") % 5).alias("time_step"), F.concat(F.lit("urban, "), "event_type").alias("target_classes"))
    both = S.read_interventions(raw).select("user_id", F.explode(F.arrays_zip("time_step", "target_classes")).alias("z"))
    return both.select("user_id", F.col("z.time_step").alias("time_step"), F.col("z.target_classes").alias("target"))


@query("s9_ingest_year_table", """WITH w AS (SELECT lower(trim(n_name)) AS name, c_custkey, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_acctbal END AS v2010, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_custkey END AS v2014 FROM customer JOIN nation ON n_nationkey = c_nationkey)
 SELECT name AS n_name, CAST(c_custkey AS VARCHAR) AS c_custkey, 2010 AS year, round(v2010, 6) AS value FROM w UNION ALL SELECT name, CAST(c_custkey AS VARCHAR), 2014, CAST(v2014 AS DOUBLE) FROM w""")
def _(t):
    rows = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    text = lambda c, k: F.when(F.col("c_custkey") % k == 0, " ").otherwise(F.concat(F.lit(" "), F.col(c).cast("string")))
    wide = rows.select("n_name", F.col("c_custkey").cast("string").alias("c_custkey "), text("c_acctbal", 3).alias("X2010"), text("c_custkey", 4).alias("X2014"), F.lit(" ").alias("X2018"))
    return S.ingest_year_table(wide, ["n_name", "c_custkey"], [2010, 2014, 2018])


@query("s10_write_rates", """WITH a AS (SELECT from_v AS a_from, to_v AS a_to, 2016 AS year_from, 2022 AS year_to FROM rates WHERE period = '2010_2014' GROUP BY ALL), r AS (SELECT 'BAU' AS scenario, 'r' || region AS region_name, CAST(split_part(period, '_', 2) AS INT) AS year, from_v, to_v, rate FROM rates)
 SELECT scenario, region_name, year, from_v AS "From", to_v AS "To", round(rate, 6) AS "Rate" FROM r WHERE EXISTS (SELECT 1 FROM a WHERE a_from = from_v AND a_to = to_v AND year > year_from AND year <= year_to)""")
def _(t):
    allowed = t.rates.filter("period = '2010_2014'").select(F.col("from_v").alias("a_from"), F.col("to_v").alias("a_to"), F.lit(2016).alias("year_from"), F.lit(2022).alias("year_to")).distinct()
    rows = t.rates.select(F.lit("BAU").alias("scenario"), F.concat(F.lit("r"), "region").alias("region_name"), F.split_part("period", F.lit("_"), F.lit(2)).cast("int").alias("year"), "from_v", "to_v", "rate")
    from landweave.queries.sources import _path

    path = _path(t, "rates")
    S.write_rates(rows, allowed, path)
    schema = "\"From\" int, \"To\" int, \"Rate\" double, scenario string, region_name string, year int".replace('"', "`")
    return t.spark.read.schema(schema).option("header", True).csv(path)


_CAT = """SELECT CASE WHEN p_partkey % 9 = 0 THEN 'soil_ph_' || (CASE WHEN p_partkey % 2 = 0 THEN '100_200_' ELSE '0_5_' END) || p_partkey WHEN p_partkey % 4 = 0 THEN 'nhood_urban_' || p_partkey ELSE 'k' || p_partkey END AS key,
 CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE 'b' || p_partkey END AS base_name, CASE WHEN p_partkey % 4 = 0 THEN 'neighbourhood' ELSE 'suitability' END AS pred_category, CASE WHEN p_partkey % 2 = 0 THEN 'static' ELSE 'dynamic' END AS static_or_dynamic,
 CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE 'ssp' || (p_partkey % 3) END AS scenario_variant, CASE WHEN p_partkey % 2 = 0 THEN 'all' ELSE CAST(2010 + 4 * (p_partkey % 4) AS VARCHAR(4)) END AS period, CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE '/d/' || p_partkey END AS path,
 CASE WHEN p_partkey % 9 = 0 THEN 'soil' ELSE 'other' END AS {grouping}, p_partkey AS version FROM part"""


def _catalog(t) -> DataFrame:
    return t.spark.sql(_CAT.format(grouping="grouping").replace("FROM part", "FROM {part}"), part=t.part)


_CATSQL = "WITH k AS (" + _CAT.format(grouping="grp") + ") "


@query("s11_dataset_metadata", _CATSQL + "SELECT static_or_dynamic AS type, period, COUNT(DISTINCT key) AS n_variables, array_to_string(list_sort(list(DISTINCT key)), ',') AS variables, CASE WHEN static_or_dynamic = 'static' THEN 'region' ELSE 'scenario,region' END AS partitioning FROM k GROUP BY 1, 2")
def _(t):
    return S.dataset_metadata(_catalog(t).select(F.col("static_or_dynamic").alias("type"), "period", F.col("key").alias("name")))


@query("p22_static_layers", _CATSQL + "SELECT coalesce(base_name, key) AS name, path FROM k WHERE static_or_dynamic = 'static' AND path IS NOT NULL AND (grp <> 'soil' OR contains(key, '100_200'))")
def _(t):
    return S.static_layers(_catalog(t))


@query("p23_dynamic_layers", _CATSQL + "SELECT period, coalesce(scenario_variant, 'baseline') AS scenario, coalesce(base_name, key) AS name, path FROM k WHERE static_or_dynamic = 'dynamic'")
def _(t):
    return S.dynamic_layers(_catalog(t))


@query("p24_categorize", _CATSQL + "SELECT key, CASE WHEN pred_category = 'neighbourhood' AND contains(key, 'urban') THEN 'nhood_urban' WHEN grp = 'soil' THEN split_part(key, '_', 1) ELSE pred_category END AS category FROM k")
def _(t):
    return S.categorize(_catalog(t), t.classes)


@query("s14_parse_layer_name", r"""SELECT l_orderkey, l_linenumber, 'tasmax' AS variable, 'gcm' || (l_suppkey % 5) AS gcm, 'ssp' || (126 + l_suppkey % 3) AS ssp, CAST(2011 + l_suppkey % 3 * 30 AS INT) AS year_from, CAST(2040 + l_suppkey % 3 * 30 AS INT) AS year_to, CAST(2026 + l_suppkey % 3 * 30 AS INT) AS mid_year, CASE WHEN l_linenumber % 2 = 0 THEN CAST(month(l_shipdate) AS INT) END AS month FROM lineitem""")
def _(t):
    c, k = F.col, F.col("l_suppkey") % 3
    month = F.when(c("l_linenumber") % 2 == 0, F.concat(F.lit("_"), F.lpad(F.month("l_shipdate").cast("string"), 2, "0"))).otherwise("")
    name = F.concat(F.lit("GCM"), c("l_suppkey") % 5, F.lit("_tasmax_ssp"), 126 + k, F.lit("_"), 2011 + k * 30, F.lit("-01-01_"), 2040 + k * 30, F.lit("-12-31"), month)
    return t.lineitem.select("l_orderkey", "l_linenumber", *(v.alias(n) for n, v in fn.parse_layer_name(name).items()))


@query("s15_upsert_catalog", _CATSQL + ", u AS (SELECT key, path, version FROM k UNION ALL SELECT key, '/new', version + 1 FROM k WHERE version % 6 = 0) SELECT key, path, version FROM u QUALIFY row_number() OVER (PARTITION BY key ORDER BY version DESC) = 1")
def _(t):
    old = _catalog(t).select("key", "path", "version")
    return S.upsert_catalog(old, old.filter("version % 6 = 0").select("key", F.lit("/new").alias("path"), (F.col("version") + 1).alias("version")), "key", "version")


@query("s16_control_table", "WITH c AS (SELECT o_orderkey AS run, CASE o_orderstatus WHEN 'F' THEN 'Y' ELSE 'N' END AS completed FROM orders) SELECT run, CASE WHEN run = 3 THEN 'Y' WHEN run = 4 THEN 'ERROR' ELSE completed END AS completed FROM c WHERE CASE WHEN run = 3 THEN 'Y' WHEN run = 4 THEN 'ERROR' ELSE completed END = 'N'")
def _(t):
    ctrl = t.orders.select(F.col("o_orderkey").alias("run"), F.when(F.col("o_orderstatus") == "F", "Y").otherwise("N").alias("completed"))
    return S.remaining(S.mark_done(S.mark_done(ctrl, 3, True), 4, False))


@query("r14_timesteps", "SELECT run, a AS step_from, b AS step_to FROM (SELECT c_custkey AS run, unnest(range(2020 + c_custkey % 4, 2060, 5)) AS a, unnest(range(2025 + c_custkey % 4, 2065, 5)) AS b FROM customer) WHERE b <= 2060")
def _(t):
    ctrl = t.customer.select(F.col("c_custkey").alias("run"), (2020 + F.col("c_custkey") % 4).cast("long").alias("scenario_start"), F.lit(2060).cast("long").alias("scenario_end"), F.lit(5).cast("long").alias("step_length"))
    return S.timesteps(ctrl)
