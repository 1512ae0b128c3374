"""Queries of class areas, transitions and rates."""

from __future__ import annotations

from pyspark.sql import functions as F

from landweave.fixtures import YEARS
from landweave.operators import rates as R
from landweave.queries.base import query

PERIODS = [(f"{a}_{b}", f"lulc_{a}", f"lulc_{b}") for a, b in zip(YEARS, YEARS[1:], strict=False)]


@query("a1_class_area", "SELECT lulc, " + ", ".join(f"COUNT(*) FILTER (year = {y}) AS n_{y}" for y in YEARS) + " FROM long_cells GROUP BY lulc")
def _(t):
    return R.class_area(t.long_cells, list(YEARS))


@query("a2_crosstab", "SELECT lulc_2018 AS from_v, lulc_2022 AS to_v, COUNT(*) AS n FROM cells GROUP BY 1, 2")
def _(t):
    return R.crosstab(t.cells, "lulc_2018", "lulc_2022")


@query("a3_transition_rates", """WITH n AS (SELECT lulc_2018 AS from_v, lulc_2022 AS to_v, COUNT(*) AS n FROM cells GROUP BY 1, 2),
 r AS (SELECT from_v, to_v, n * 1.0::DOUBLE / SUM(n) OVER (PARTITION BY from_v) AS rate FROM n)
 SELECT from_v, to_v, round(rate, 6) AS rate FROM r WHERE from_v <> to_v""")
def _(t):
    return R.transition_rates(t.cells, "lulc_2018", "lulc_2022").orderBy("from_v", "to_v")


@query("a4_regional_rates", """WITH r AS (SELECT region, from_v, to_v, n / SUM(n::DOUBLE) OVER (PARTITION BY region, from_v) AS rate FROM pair_counts WHERE period = '2018_2022'),
 v AS (SELECT lulc_2014 AS from_v, lulc_2018 AS to_v FROM cells WHERE lulc_2014 <> lulc_2018 GROUP BY 1, 2 HAVING COUNT(*) >= 30)
 SELECT region, from_v, to_v, round(rate, 6) AS rate FROM r WHERE from_v = to_v OR EXISTS (SELECT 1 FROM v WHERE v.from_v = r.from_v AND v.to_v = r.to_v)""")
def _(t):
    whole = R.crosstab(t.cells, "lulc_2014", "lulc_2018").filter("from_v <> to_v AND n >= 30")
    return R.transition_rates(t.cells, "lulc_2018", "lulc_2022", ["region"], whole).select("region", "from_v", "to_v", "rate")


@query("a5_persistence", """WITH s AS (SELECT region, period, from_v, from_v AS to_v, 1 - SUM(rate) AS rate FROM rates GROUP BY region, period, from_v)
 SELECT region, period, from_v, to_v, round(rate, 6) AS rate FROM rates UNION ALL SELECT region, period, from_v, to_v, round(rate, 6) FROM s""")
def _(t):
    return R.persistence(t.rates, ["region", "period"])


def _viable_sql() -> str:
    return """WITH q AS (SELECT CASE WHEN GROUPING(region) = 1 THEN 'whole_map' ELSE 'region_' || region END AS region_name, period, from_v, to_v, SUM(n) AS n
   FROM pair_counts GROUP BY GROUPING SETS ((region, period, from_v, to_v), (period, from_v, to_v))),
 r AS (SELECT *, n / SUM(n::DOUBLE) OVER (PARTITION BY region_name, period, from_v) AS rate FROM q),
 a AS (SELECT region_name, period, from_v, to_v, rate FROM r WHERE from_v <> to_v
   UNION ALL SELECT region_name, period, from_v, from_v, 1 - SUM(rate) FROM r WHERE from_v <> to_v GROUP BY ALL)
 SELECT region_name, from_v, to_v, """ + ", ".join(f"round(MAX(rate) FILTER (period = '{p}'), 6) AS rate_{p}" for p, _, _ in PERIODS) + " FROM a GROUP BY region_name, from_v, to_v"


@query("a6_viable_table", _viable_sql())
def _(t):
    return R.viable_table(t.cells, PERIODS)


@query("a7_region_class_area", """SELECT 'r' || region AS region_name, class_name AS lulc_name, COUNT(*) AS initial_amount FROM cells JOIN classes ON value = lulc_2022 WHERE region <> 4 GROUP BY 1, 2""")
def _(t):
    regions = t.cells.select("region").distinct().filter("region <> 4").withColumn("label", F.concat(F.lit("r"), "region"))
    return R.region_class_area(t.cells, "lulc_2022", regions, t.classes)


@query("a8_class_counts_filled", """WITH m(old, new) AS (VALUES (101, 1), (102, 2), (103, 3), (104, 3), (105, 4), (106, 5), (999, 6)),
 x AS (SELECT CAST(region AS VARCHAR) AS area, year, new AS lulc FROM long_cells JOIN m ON lulc = old),
 y AS (SELECT * FROM x UNION ALL SELECT 'all', year, lulc FROM x)
 SELECT a.area, n.new AS lulc, """ + ", ".join(f"COUNT(*) FILTER (y.year = {v}) AS n_{v}" for v in YEARS) + """
 FROM (SELECT DISTINCT area FROM y) AS a CROSS JOIN (SELECT DISTINCT new FROM m) AS n LEFT JOIN y ON y.area = a.area AND y.lulc = n.new GROUP BY 1, 2""")
def _(t):
    mapping = t.spark.createDataFrame([(101, 1), (102, 2), (103, 3), (104, 3), (105, 4), (106, 5), (999, 6)], "old int, new int")
    return R.class_counts_filled(t.long_cells, mapping, list(YEARS))


@query("a15_rate_bounds", "SELECT region, from_v, to_v, round(MIN(rate), 6) AS min_rate, round(MAX(rate), 6) AS max_rate, round(AVG(rate), 6) AS mean_rate FROM rates GROUP BY 1, 2, 3")
def _(t):
    return R.rate_bounds(t.rates, ["region", "from_v", "to_v"])


@query("a16_extrapolate", """WITH f AS (SELECT region, from_v, to_v, regr_slope(rate, y) AS s, AVG(rate) AS m, AVG(y) AS x FROM (SELECT *, CAST(split_part(period, '_', 2) AS DOUBLE) AS y FROM rates) GROUP BY 1, 2, 3)
 SELECT region, from_v, to_v, year, round(greatest(0, m + CASE WHEN s IS NULL OR isnan(s) THEN 0 ELSE s END * (year - x)), 6) AS rate FROM f, (VALUES (2030), (2060)) AS y(year)""")
def _(t):
    rates = t.rates.withColumn("year", F.split_part("period", F.lit("_"), F.lit(2)).cast("double"))
    return R.extrapolate(rates, ["region", "from_v", "to_v"], t.spark.createDataFrame([(2030,), (2060,)], "year int"))


@query("a19_complete_params", """WITH o AS (SELECT from_v, to_v, AVG(rate) AS mean_rate, CAST(COUNT(*) AS BIGINT) AS n FROM rates WHERE period = '2018_2022' GROUP BY 1, 2)
 SELECT DISTINCT r.from_v, r.to_v, round(COALESCE(o.mean_rate, 0), 6) AS mean_rate, COALESCE(o.n, 0) AS n FROM rates AS r LEFT JOIN o ON o.from_v = r.from_v AND o.to_v = r.to_v""")
def _(t):
    seen = t.rates.filter("period = '2018_2022'").groupBy("from_v", "to_v").agg(F.avg("rate").alias("mean_rate"), F.count("*").alias("n"))
    return R.complete_params(t.rates, seen, ["from_v", "to_v"], ["mean_rate", "n"])


_CHANGE = " UNION ALL ".join(f"SELECT {a} AS y0, {b} AS y1, lulc_{a} AS from_v, lulc_{b} AS to_v, COUNT(*) AS n FROM cells WHERE lulc_{a} <> 101 AND lulc_{b} <> 101 GROUP BY 3, 4" for a, b in [*zip(YEARS, YEARS[1:], strict=False), (YEARS[0], YEARS[-1])])


@query("a20_change_table", f"""WITH n AS ({_CHANGE}), p AS (SELECT *, n * 100.0::DOUBLE / SUM(n) OVER (PARTITION BY y0, y1) AS perc_total, n * 100.0::DOUBLE / SUM(n) OVER (PARTITION BY y0, y1, from_v) AS perc_class FROM n)
 SELECT y0, y1, from_v, to_v, n, round(perc_total, 6) AS perc_total, round(perc_class, 6) AS perc_class FROM p WHERE from_v <> to_v""")
def _(t):
    return R.change_table(t.long_cells, list(YEARS), [101])


_COLS = [f"lulc_{y}" for y in YEARS]


@query("a21_trajectory_counts", f"SELECT {', '.join(_COLS)}, COUNT(*) AS n FROM cells GROUP BY ALL HAVING COUNT(*) > 0 AND NOT (lulc_2010 = lulc_2014 AND lulc_2014 = lulc_2018 AND lulc_2018 = lulc_2022)")
def _(t):
    return R.trajectory_counts(t.cells, _COLS, constant=False)


@query("a21_trajectory_long", f"""WITH n AS (SELECT {', '.join(_COLS)}, COUNT(*) AS n FROM cells GROUP BY ALL), i AS (SELECT *, CAST(row_number() OVER (ORDER BY {', '.join(_COLS)}) AS INT) AS path_id FROM n)
 SELECT path_id, n, CAST(k AS INT) AS step, [{', '.join(_COLS)}][k + 1] AS lulc FROM i, range(4) AS s(k)""")
def _(t):
    return R.trajectory_long(R.trajectory_counts(t.cells, _COLS), _COLS)


@query("a22_zone_relative_change", """WITH b AS (SELECT lulc_2010 AS lulc, -1 AS w, zone FROM cells LEFT JOIN mask USING (cell_id) UNION ALL SELECT lulc_2022, 1, zone FROM cells LEFT JOIN mask USING (cell_id)),
 n AS (SELECT lulc, CAST(SUM(w) AS BIGINT) AS map_change, CAST(COALESCE(SUM(w) FILTER (zone IS NOT NULL), 0) AS BIGINT) AS zone_change FROM b GROUP BY lulc)
 SELECT *, round(zone_change * 100.0::DOUBLE / NULLIF(map_change, 0), 6) AS perc FROM n""")
def _(t):
    return R.zone_relative_change(t.cells, t.mask, "lulc_2010", "lulc_2022")


@query("a23_area_share", """WITH n AS (SELECT region, year, lulc, COUNT(*) AS n FROM long_cells GROUP BY ALL), b AS (SELECT *, lag(n) OVER (PARTITION BY region, lulc ORDER BY year) AS p, SUM(n) OVER (PARTITION BY region, year) AS s FROM n)
 SELECT region, year, lulc, n, round(n * 100.0::DOUBLE / s, 6) AS perc, round((n - p) * 100.0::DOUBLE / p, 6) AS perc_change FROM b""")
def _(t):
    return R.area_share(t.long_cells, ["region"])


@query("a25_series_step_change", """WITH n AS (SELECT region, year, CAST(SUM(CASE WHEN lulc = 107 THEN 1 ELSE 0 END) AS BIGINT) AS area FROM long_cells GROUP BY ALL)
 SELECT *, area - lag(area) OVER (PARTITION BY region ORDER BY year) AS step_change FROM n""")
def _(t):
    return R.series_step_change(t.long_cells.withColumn("area_of", (F.col("lulc") == 107).cast("long")), "region", "year", "area_of")


@query("a30_key_counts", """SELECT 'cells' AS source, COUNT(DISTINCT cell_id) AS n_keys FROM cells UNION ALL SELECT 'mask', COUNT(DISTINCT cell_id) FROM mask UNION ALL SELECT 'probs', COUNT(DISTINCT cell_id) FROM probs""")
def _(t):
    return R.key_counts({"cells": t.cells, "mask": t.mask, "probs": t.probs}, "cell_id")


@query("w1_share_of_partition", "SELECT region, lulc, n, round(n / SUM(n::DOUBLE) OVER (PARTITION BY region), 6) AS share FROM areas")
def _(t):
    return t.areas.withColumn("share", R.share("n", ["region"]))


@query("w9_r2_pick_shape", """WITH n AS (SELECT scenario, lulc, curve_type, COUNT(*) AS n FROM demand GROUP BY ALL)
 SELECT scenario, lulc, curve_type, n FROM n QUALIFY row_number() OVER (PARTITION BY scenario, lulc ORDER BY n DESC, curve_type = 'Constant change', curve_type) = 1""")
def _(t):
    return R.pick_shape(t.demand, ["scenario", "lulc"], "curve_type")
