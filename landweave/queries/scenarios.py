"""Queries of potentials, interventions, projections, validation and modelling."""

from __future__ import annotations

from pyspark.sql import functions as F

from landweave.operators import ml as M
from landweave.operators import models as B
from landweave.operators import potential as T
from landweave.operators import scenario as R
from landweave.operators import validate as V
from landweave.queries.base import query

_NORM = "nm AS (SELECT cell_id, from_v, to_v, CASE WHEN s > 1 THEN p / s ELSE p END AS p FROM (SELECT *, round(SUM(p) OVER (PARTITION BY cell_id), 12) AS s FROM probs))"


def _norm(t):
    return T.normalize_long(t.probs).select("cell_id", "from_v", "to_v", "p")


@query("t2_active_interventions", "SELECT user_id AS intervention_id, event_id AS rank FROM events WHERE event_id % 3 = 0 AND user_id % 7 = 2018 - 2015")
def _(t):
    ints = t.events.select(F.col("user_id").alias("intervention_id"), F.col("event_id").alias("rank"), F.when(F.col("event_id") % 3 == 0, "BAU").otherwise("NAT").alias("scenario_id"), F.array((2015 + F.col("user_id") % 7).cast("int"), F.lit(2090)).alias("time_step"))
    return T.active_interventions(ints, "BAU", 2018).select("intervention_id", "rank")


def _absolute(value: float, targets: str, froms: str = "TRUE") -> str:
    return f"WITH {_NORM} SELECT cell_id, from_v, to_v, round(CASE WHEN cell_id IN (SELECT cell_id FROM mask) AND p > 0 AND to_v IN ({targets}) AND {froms} THEN {value} ELSE p END, 9) AS p FROM nm"


@query("t3_absolute_densification", _absolute(1.0, "105"), digits=9)
def _(t):
    return T.apply_intervention(_norm(t), t.mask, T.PRESETS["densification"])


@query("t3_absolute_protection", _absolute(0.0, "105"), digits=9)
def _(t):
    return T.apply_intervention(_norm(t), t.mask, T.PRESETS["protection"])


@query("t12_conservation", _absolute(0.0, "103, 105", "from_v IN (102)"), digits=9)
def _(t):
    return T.apply_intervention(_norm(t), t.mask, T.PRESETS["conservation"])


def _step(i: T.Intervention, source: str, k: int) -> str:
    """Oracle: the CTE s{k}, source after one intervention within the mask (or beyond it)."""
    where = f"to_v IN ({', '.join(map(str, i.targets))})" + (f" AND from_v IN ({', '.join(map(str, i.from_filter))})" if i.from_filter else "")
    side = f"cell_id {'NOT ' if i.zone == 'outside' else ''}IN (SELECT cell_id FROM mask)"
    if i.kind == "absolute":
        return f"s{k} AS (SELECT cell_id, from_v, to_v, CASE WHEN {side} AND p > 0 AND {where} THEN {i.value} ELSE p END AS p FROM {source})"

    def scaled(rule: str) -> str:
        move, which = rule.split("_")
        hit = "(i AND round(p, 9) > round(q_in, 9))" if which == "inside" else "(NOT i AND round(p, 9) > round(q_out, 9))"
        return f"CASE WHEN {hit} THEN least(1, greatest(0, p * (1 {'+' if move == 'raise' else '-'} abs(gap)))) ELSE p END"

    diff = "m_in - m_out" if i.order == "in-out" else "m_out - m_in"
    return f"""f{k} AS (SELECT *, {side} AS i, {where} AS ap FROM {source}),
 q{k} AS (SELECT to_v AS k, quantile_cont(p, {i.q_in}) FILTER (i) AS q_in, quantile_cont(p, {i.q_out}) FILTER (NOT i) AS q_out FROM f{k} WHERE ap AND p > 0 GROUP BY 1),
 m{k} AS (SELECT k, q_in, q_out, AVG(p) FILTER (i AND round(p, 9) >= round(q_in, 9)) AS m_in, AVG(p) FILTER (NOT i AND round(p, 9) >= round(q_out, 9)) AS m_out FROM f{k} JOIN q{k} ON k = to_v WHERE ap AND p > 0 GROUP BY 1, 2, 3),
 g{k} AS (SELECT *, ({diff}) / ((m_in + m_out) / 2) AS g0 FROM m{k}), h{k} AS (SELECT k, q_in, q_out, CASE WHEN abs(g0) < {i.threshold} THEN CASE WHEN g0 < 0 THEN -{i.threshold} ELSE {i.threshold} END ELSE g0 END AS gap FROM g{k}),
 s{k} AS (SELECT cell_id, from_v, to_v, CASE WHEN ap AND gap > 0 THEN {scaled(i.when_positive)} WHEN ap AND gap < 0 THEN {scaled(i.when_negative)} ELSE p END AS p FROM f{k} LEFT JOIN h{k} ON k = to_v)"""


def _in_order(*steps: T.Intervention) -> str:
    """Oracle: normalised potentials after interventions in order."""
    ctes = [_step(i, "nm" if k == 0 else f"s{k - 1}", k) for k, i in enumerate(steps)]
    return f"WITH {_NORM}, {', '.join(ctes)} SELECT cell_id, from_v, to_v, round(p, 9) AS p FROM s{len(steps) - 1}"


def _relative(name: str) -> str:
    return _in_order(T.PRESETS[name])


#: Interventions as they are configured: identifier, rank, years, targets, type, value, valency, percentiles, threshold, zone, from-classes.
_CONFIGURED = (
    ("agri_expansion", 2, "2020, 2030 ,2040", "cropland,grassland", "Relative", None, "Increase", 90.0, 80.0, 5.0, "Outside", "forest"),
    ("urban_densification", 1, "2020,2030", "urban", "Absolute", 100.0, None, None, None, None, "Inside", None),
    ("rural_decline", 3, "2030, 2050", "urban, cropland", "Relative", None, "decrease", 85.0, 90.0, 5.0, "Inside", None),
    ("protected_areas", 4, "2030", "urban", "Absolute", 0.0, None, None, None, None, "Outside", "grassland, bare"),
    ("not_in_2030", 0, "2020,20301", "urban", "Absolute", 0.0, None, None, None, None, "Inside", None),
)
_CONFIGURED_COLS = "intervention_id string, rank int, time_step string, target_classes string, prob_adjust_type string, prob_adjust_value double, prob_adjust_valency string, prob_adjust_intervention_percentile double, prob_adjust_non_intervention_percentile double, prob_adjust_threshold double, prob_adjust_zone string, from_lulc_filter string"


@query(
    "t12_configured_in_rank_order",
    _in_order(
        T.Intervention("absolute", "inside", 1.0, targets=(105,)),
        T.Intervention("relative", "outside", q_in=0.9, q_out=0.8, when_positive="raise_inside", when_negative="raise_inside", targets=(103, 104), from_filter=(102,)),
        T.Intervention("relative", "inside", q_in=0.85, q_out=0.9, when_positive="lower_inside", when_negative="lower_inside", targets=(105, 103)),
        T.Intervention("absolute", "outside", 0.0, targets=(105,), from_filter=(104, 106)),
    ),
    digits=9,
)
def _(t):
    from landweave.sources.catalog import read_interventions

    table = t.spark.createDataFrame(_CONFIGURED, _CONFIGURED_COLS).withColumn("scenario_id", F.lit("SSP3"))
    active = T.active_interventions(read_interventions(table), "SSP3", 2030)
    classes = {r["class_name"]: r["value"] for r in t.classes.collect()}
    return T.apply_configured(_norm(t), active, {r[0]: t.mask for r in _CONFIGURED}, classes)


for _id, _name in (("t4_relative_sprawl", "urban_sprawl"), ("t5_urban_migration", "urban_migration"), ("t6_mountain_development", "mountain_development"), ("t7_rural_migration", "rural_migration"), ("t8_cultural_protection", "cultural_protection"), ("t12_agri_expansion", "agri_expansion"), ("t12_ineffective_conservation", "ineffective_conservation")):

    @query(_id, _relative(_name), digits=9)
    def _(t, name=_name):
        return T.apply_intervention(_norm(t), t.mask, T.PRESETS[name])


_RS = lambda c: f"(({c} - MIN({c}) OVER ()) / (MAX({c}) OVER () - MIN({c}) OVER ()))"
_INDEX = f"ix AS (SELECT cell_id, ({_RS('x4')} + {_RS('x2')} + {_RS('x1')} + 1 - {_RS('x3')}) / 4 AS marginality FROM predictors)"


def _index(t):
    return T.marginality(t.predictors.select("cell_id", F.col("x4").alias("dist_roads"), F.col("x2").alias("slope"), F.col("x1").alias("elevation"), F.col("x3").alias("dist_building")))


@query("t9_marginality", f"WITH {_INDEX} SELECT cell_id, round(marginality, 9) AS marginality FROM ix", digits=9)
def _(t):
    return _index(t)


_AGRI = f"""WITH {_NORM}, {_INDEX}, a AS (SELECT nm.*, marginality FROM nm JOIN ix ON ix.cell_id = nm.cell_id WHERE from_v IN (103, 104)),
 c AS (SELECT quantile_cont(marginality, 0.75) AS cut FROM (SELECT DISTINCT cell_id, marginality FROM a)), b AS (SELECT a.*, round(marginality, 9) > round(cut, 9) AS marginal FROM a, c)"""


@query("t10_abandonment", _AGRI + """, q AS (SELECT marginal, quantile_cont(p, 0.9) AS q FROM b WHERE p > 0 GROUP BY 1)
 SELECT cell_id, from_v, to_v, round(CASE WHEN round(p, 9) > round(q, 9) THEN least(1, p * CASE WHEN b.marginal THEN 1.2::DOUBLE ELSE 0.8::DOUBLE END) ELSE p END, 9) AS p, b.marginal FROM b JOIN q ON q.marginal = b.marginal""", digits=9)
def _(t):
    return T.abandonment(_norm(t), _index(t), 0.2)


@query("t11_maintenance", _AGRI + """, q AS (SELECT quantile_cont(p, 0.95) AS q FROM b WHERE p > 0 AND NOT marginal) SELECT cell_id, from_v, to_v, round(CASE WHEN marginal AND round(p, 9) > round(q, 9) THEN p * 0.8::DOUBLE ELSE p END, 9) AS p, marginal FROM b, q""", digits=9)
def _(t):
    return T.maintenance(_norm(t), _index(t), 0.2)


@query("t13_adjust_params", """SELECT to_v, year, name, round(CASE WHEN to_v IN (103, 105) AND year = 2030 AND name = 'expander' THEN 1 WHEN to_v = 105 AND year = 2040 AND name = 'patcher' THEN value * 0.5 ELSE value END, 6) AS value
 FROM (SELECT DISTINCT to_v, y AS year, k AS name, (to_v % 10)::DOUBLE / 10 AS value FROM rates, (VALUES (2030), (2040)) AS v(y), (VALUES ('expander'), ('patcher')) AS w(k))""")
def _(t):
    params = t.rates.select("to_v").distinct().withColumns({"year": F.explode(F.array(F.lit(2030), F.lit(2040)))}).withColumn("name", F.explode(F.array(F.lit("expander"), F.lit("patcher")))).withColumn("value", (F.col("to_v") % 10).cast("double") / 10)
    ints = t.spark.createDataFrame([([2030], [103, 105], "expander", "absolute", 1.0), ([2040], [105], "patcher", "relative", 0.5)], "years array<int>, classes array<int>, name string, kind string, value double")
    return T.adjust_params(params, ints)


@query("t14_typology_zone", "SELECT cell_id, CASE WHEN row % 9 IN (2, 5) THEN 1 END AS zone FROM cells")
def _(t):
    kinds = t.cells.select("row").distinct().withColumn("code", F.col("row") % 9)
    return T.typology_zone(t.cells, "row", kinds, [2, 5])


@query("t20_deterministic_override", "SELECT cell_id, CASE WHEN cell_id % 17 = 0 AND cell_id % 2 = 0 THEN 107 WHEN cell_id % 17 = 0 THEN 106 WHEN lulc_2022 = 107 THEN 106 ELSE lulc_2022 END AS lulc_2022 FROM cells")
def _(t):
    index = t.cells.filter("cell_id % 17 = 0").select("cell_id", (F.col("cell_id") % 2 == 0).cast("int").alias("is_glacier"))
    return T.deterministic_override(t.cells.select("cell_id", "lulc_2022"), "lulc_2022", index)


@query("t21_drop_from_class", "SELECT region, period, from_v, to_v, round(rate, 6) AS rate FROM rates WHERE from_v NOT IN (101, 107)")
def _(t):
    return T.drop_from_class(t.rates, [101, 107])


_WHOLE = "wr AS (SELECT from_v, to_v, n / SUM(n::DOUBLE) OVER (PARTITION BY from_v) AS rate FROM (SELECT lulc_2018 AS from_v, lulc_2022 AS to_v, COUNT(*) AS n FROM cells GROUP BY 1, 2)), rt AS (SELECT * FROM wr WHERE from_v <> to_v), cn AS (SELECT lulc_2022 AS f, COUNT(*) AS cells FROM cells GROUP BY 1), qn AS (SELECT from_v, to_v, CAST(round(rate * cells) AS BIGINT) AS n FROM rt JOIN cn ON f = from_v)"


def _quantities(t):
    from landweave.operators.rates import transition_rates

    rates = transition_rates(t.cells, "lulc_2018", "lulc_2022")
    pct = rates.filter("to_v <> 107").select("from_v", "to_v", (F.col("to_v") % 10 * 10).cast("double").alias("perc_expander"))
    return T.change_quantities(t.cells, "lulc_2022", rates, pct)


@query("t22_change_quantities", f"WITH {_WHOLE} SELECT from_v, to_v, n, CAST(round(CASE WHEN to_v = 107 THEN 0 ELSE to_v % 10 * 10 END::DOUBLE / 100 * n) AS BIGINT) AS n_expander, n - CAST(round(CASE WHEN to_v = 107 THEN 0 ELSE to_v % 10 * 10 END::DOUBLE / 100 * n) AS BIGINT) AS n_patcher FROM qn")
def _(t):
    return _quantities(t)


@query("t23_shortlist", f"WITH {_WHOLE}, r AS (SELECT p.cell_id, p.from_v, p.to_v, p.p, CAST(row_number() OVER (PARTITION BY p.from_v, p.to_v ORDER BY p.p DESC, p.cell_id) AS INT) AS rank, n FROM probs AS p JOIN qn ON qn.from_v = p.from_v AND qn.to_v = p.to_v WHERE p.p > 0) SELECT cell_id, from_v, to_v, round(p, 6) AS p, rank FROM r WHERE rank <= n * 2")
def _(t):
    return T.shortlist(t.probs.drop("region"), _quantities(t), 2.0)


@query("t1_transition_potential", f"""WITH {_NORM}, a AS (SELECT cell_id, from_v, to_v, CASE WHEN cell_id IN (SELECT cell_id FROM mask) AND p > 0 AND to_v = 105 THEN 1 ELSE p END AS p FROM nm), b AS (SELECT *, round(SUM(p) OVER (PARTITION BY cell_id), 12) AS s FROM a)
 SELECT o_orderkey + 1 AS cell_id, from_v, to_v, round(COALESCE(CASE WHEN s > 1 THEN p / s ELSE p END, 0), 9) AS p FROM orders LEFT JOIN b ON cell_id = o_orderkey + 1""", digits=9)
def _(t):
    return T.transition_potential(t.probs, t.orders.select((F.col("o_orderkey") + 1).alias("cell_id")), [(t.mask, T.PRESETS["densification"])])


_SIM = "sim AS (SELECT c.*, CASE WHEN c.cell_id % 5 = 0 THEN k.v ELSE lulc_2018 END AS lulc_sim FROM cells AS c LEFT JOIN (SELECT cell_id, arg_max(to_v, p) AS v FROM probs GROUP BY 1) AS k ON k.cell_id = c.cell_id)"


@query("t24_similarity", f"""WITH {_SIM}, o AS (SELECT cell_id, row, col, lulc_2022 AS v FROM sim WHERE lulc_2022 <> lulc_2018), s AS (SELECT cell_id, row, col, lulc_sim AS v FROM sim WHERE lulc_sim <> lulc_2018),
 a AS (SELECT o.cell_id, MAX(pow(2::DOUBLE, -sqrt(pow(o.row - s.row, 2) + pow(o.col - s.col, 2)) / 2)) AS z FROM o LEFT JOIN s ON s.v = o.v AND s.row BETWEEN o.row - 5 AND o.row + 5 AND s.col BETWEEN o.col - 5 AND o.col + 5 GROUP BY 1),
 b AS (SELECT s.cell_id, MAX(pow(2::DOUBLE, -sqrt(pow(o.row - s.row, 2) + pow(o.col - s.col, 2)) / 2)) AS z FROM s LEFT JOIN o ON s.v = o.v AND o.row BETWEEN s.row - 5 AND s.row + 5 AND o.col BETWEEN s.col - 5 AND s.col + 5 GROUP BY 1),
 x AS (SELECT AVG(COALESCE(z, 0)) AS f, COUNT(*) AS n FROM a), y AS (SELECT AVG(COALESCE(z, 0)) AS g, COUNT(*) AS m FROM b)
 SELECT round(f, 6) AS observed_in_simulated, n AS n_observed, round(g, 6) AS simulated_in_observed, m AS n_simulated, round(least(f, g), 6) AS similarity FROM x, y""")
def _(t):
    best = t.probs.groupBy("cell_id").agg(F.max_by("to_v", "p").alias("best"))
    sim = t.cells.join(best, "cell_id", "left").withColumn("lulc_sim", F.when(F.col("cell_id") % 5 == 0, F.col("best")).otherwise(F.col("lulc_2018")))
    return V.similarity_of_differences(sim, "lulc_2018", "lulc_2022", "lulc_sim")


@query("r1_demand_targets", """WITH per AS (SELECT region, scenario, lulc, id, SUM(slider_value) AS slider, AVG(confidence_factor) AS conf, AVG(initial_rate) AS rate FROM demand GROUP BY 1, 2, 3, 4),
 mn AS (SELECT region, scenario, lulc, AVG(slider) AS slider, AVG(conf) AS conf, AVG(rate) AS rate FROM per GROUP BY 1, 2, 3),
 j AS (SELECT mn.*, a.n AS initial, SUM(a.n) OVER (PARTITION BY mn.region, scenario) AS total FROM mn JOIN areas AS a ON a.region = mn.region AND a.lulc = mn.lulc),
 w AS (SELECT j.*, s AS scalar, greatest(0, (initial * 100.0::DOUBLE / total + rate + abs(rate) * (2 * slider * s / 100) * conf) / 100 * total) AS raw FROM j, (VALUES (0.5::DOUBLE), (1::DOUBLE)) AS v(s))
 SELECT region, scenario, lulc, scalar, initial, round(raw * total / SUM(raw) OVER (PARTITION BY region, scenario, scalar), 6) AS target FROM w""")
def _(t):
    return R.demand_targets(t.demand, t.areas, [0.5, 1.0])


_EXPECT = "(SELECT region, lulc, n AS initial, n * (CASE WHEN region % 2 = 0 THEN 90 ELSE 100 END + lulc % 7 * 5) / 100.0::DOUBLE AS expected FROM areas)"


def _expect(t):
    return t.areas.select("region", "lulc", F.col("n").alias("initial"), (F.col("n") * (F.when(F.col("region") % 2 == 0, 90).otherwise(100) + F.col("lulc") % 7 * 5) / 100).alias("expected"))


_CURVES = "CASE WHEN expected > initial THEN curve_type IN ('Constant change', 'Instant growth', 'Delayed growth') WHEN expected < initial THEN curve_type IN ('Constant change', 'Instant decline', 'Delayed decline') ELSE FALSE END"


@query("r2_curve_shape", f"""WITH ex AS {{EXPECT}}, n AS (SELECT d.region, d.lulc, curve_type, COUNT(*) AS n FROM demand AS d JOIN ex ON ex.region = d.region AND ex.lulc = d.lulc WHERE {_CURVES} GROUP BY 1, 2, 3),
 b AS (SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY region, lulc ORDER BY n DESC, curve_type = 'Constant change', curve_type) = 1)
 SELECT ex.region, ex.lulc, CAST(sign(expected - initial) AS INT) AS direction, COALESCE(curve_type, 'Constant change') AS curve_type FROM ex LEFT JOIN b ON b.region = ex.region AND b.lulc = ex.lulc""".replace("{EXPECT}", _EXPECT))
def _(t):
    from landweave.operators.rates import curve_shape

    return curve_shape(t.demand.select("region", "lulc", "curve_type"), _expect(t).withColumnRenamed("expected", "final"), ["region", "lulc"], "curve_type")


@query("r3_transition_bounds", """WITH b AS (SELECT region, from_v, to_v, MIN(rate) AS lo, MAX(rate) AS hi, AVG(rate) AS me FROM rates GROUP BY 1, 2, 3),
 g AS (SELECT r.region, i.value AS from_v, k.value AS to_v, lo, hi, me, i.value = k.value AS st, (k.value = 107 AND i.value <> 107) OR (i.value = 105 AND k.value = 103) AS z FROM (SELECT DISTINCT region FROM rates) AS r CROSS JOIN classes AS i CROSS JOIN classes AS k LEFT JOIN b ON b.region = r.region AND b.from_v = i.value AND b.to_v = k.value),
 v AS (SELECT region, from_v, to_v, CASE WHEN z THEN 0 WHEN st THEN greatest(COALESCE(lo, 0), 0.5) ELSE COALESCE(lo, 0) END AS a, CASE WHEN z THEN 0 WHEN st THEN least(COALESCE(hi, 1), 0.999::DOUBLE) ELSE COALESCE(hi, 1) END AS b, CASE WHEN z THEN 0 ELSE COALESCE(me, 0) END AS m, z FROM g),
 p AS (SELECT *, (m + 0.01::DOUBLE) / SUM(m + 0.01::DOUBLE) OVER (PARTITION BY region, from_v) AS pr FROM v)
 SELECT region, from_v, to_v, round(a, 6) AS min_rate, round(b, 6) AS max_rate, round(m, 6) AS mean_rate, z AS zero, round(pr, 6) AS preference, round(1 + pr, 6) AS weight FROM p""")
def _(t):
    from landweave.operators.rates import rate_bounds

    return R.transition_bounds(rate_bounds(t.rates, ["region", "from_v", "to_v"]), t.classes, no_inflow=(107,), forbidden=((105, 103),))


@query("r4_flows_to_rates", "SELECT p.region, period, from_v, to_v, round(p.n / greatest(a.n::DOUBLE, 1e-12), 6) AS rate FROM pair_counts AS p JOIN areas AS a ON a.region = p.region AND a.lulc = p.from_v")
def _(t):
    flows = t.pair_counts.withColumnRenamed("n", "flow")
    areas = t.areas.join(flows.select("region", "period").distinct(), "region").select("region", "period", F.col("lulc").alias("from_v"), F.col("n").cast("double").alias("area"))
    return R.flows_to_rates(flows, areas, ["region", "period"])


_STEP = "SELECT a.region, a.lulc, {n} AS step, a.area + COALESCE((SELECT SUM(r.rate * b.area) FROM rt AS r JOIN a{k} AS b ON b.region = r.region AND b.lulc = r.from_v WHERE r.region = a.region AND r.to_v = a.lulc), 0) - a.area * COALESCE((SELECT SUM(r.rate) FROM rt AS r WHERE r.region = a.region AND r.from_v = a.lulc), 0) AS area FROM a{k} AS a"
_PROJ = "rt AS (SELECT region, from_v, to_v, rate FROM rates WHERE period = '2018_2022'), a0 AS (SELECT region, lulc, 2022 AS step, n::DOUBLE AS area FROM areas), " + ", ".join(f"a{k + 1} AS ({_STEP.format(n=2026 + 4 * k, k=k)})" for k in range(5))
_STEPS = [2022, 2026, 2030, 2034, 2038, 2042]


def _projected(t):
    rates = t.rates.filter("period = '2018_2022'").drop("period")
    return R.project_areas(t.areas.withColumnRenamed("n", "area"), rates, _STEPS, ["region"])


@query("r5_project_areas", f"WITH {_PROJ}, al AS (" + " UNION ALL ".join(f"SELECT * FROM a{k}" for k in range(6)) + ") SELECT region, lulc, step, round(area, 6) AS area FROM al")
def _(t):
    return _projected(t)


@query("r6_area_trajectories", f"WITH {_PROJ} SELECT a0.region, a0.lulc, " + ", ".join(f"round(a{k}.area, 6) AS area_{s}" for k, s in enumerate(_STEPS)) + ", round(a5.area * 100 / SUM(a0.area) OVER (PARTITION BY a0.region), 6) AS perc_end, CAST(round(a0.area) AS BIGINT) || ' -> ' || CAST(round(a5.area) AS BIGINT) AS label FROM a0 " + " ".join(f"JOIN a{k} ON a{k}.region = a0.region AND a{k}.lulc = a0.lulc" for k in range(1, 6)))
def _(t):
    return R.area_trajectories(_projected(t), ["region"], _STEPS)


@query("r7_scenario_areas", f"WITH e AS (SELECT *, SUM(initial) OVER w AS h, SUM(expected) OVER w AS x FROM {_EXPECT} WINDOW w AS (PARTITION BY region)), s AS (SELECT region, lulc, initial, (CASE WHEN x > h THEN expected * h / x ELSE expected END - initial) / 4 AS st FROM e) SELECT region, lulc, CAST(k AS INT) AS step, round(st, 6) AS step_change, round(initial + st * k, 6) AS area FROM s, range(5) AS r(k)")
def _(t):
    return R.scenario_areas(_expect(t), ["region"], 4)


@query("r8_rebalance_class", "SELECT region, lulc, round(CASE WHEN lulc = 107 THEN n / 2.0::DOUBLE WHEN lulc = 106 THEN n + COALESCE((SELECT b.n / 2.0::DOUBLE FROM areas AS b WHERE b.region = a.region AND b.lulc = 107), 0) ELSE n END, 6) AS area FROM areas AS a")
def _(t):
    areas = t.areas.select("region", "lulc", F.col("n").cast("double").alias("area"))
    return R.rebalance_class(areas, areas.filter("lulc = 107").select("region", (F.col("area") / 2).alias("area")), ["region"], 107, 106)


_REF = "(SELECT region, from_v, to_v, n::DOUBLE AS amount FROM pair_counts WHERE period = '2018_2022' AND from_v <> to_v)"


def _reference(t):
    return t.pair_counts.filter("period = '2018_2022' AND from_v <> to_v").select("region", "from_v", "to_v", F.col("n").cast("double").alias("amount"))


@query("r9_distribute_change", f"""WITH n AS (SELECT region, lulc, n * (lulc % 5 - 2) / 50.0::DOUBLE AS ch FROM areas), s AS (SELECT *, amount / SUM(amount) OVER (PARTITION BY region, to_v) AS g, amount / SUM(amount) OVER (PARTITION BY region, from_v) AS l FROM {_REF})
 SELECT s.region, from_v, to_v, round(greatest(0, amount + COALESCE(greatest(a.ch, 0) * g, 0) + COALESCE(greatest(-b.ch, 0) * l, 0)), 6) AS amount FROM s LEFT JOIN n AS a ON a.region = s.region AND a.lulc = to_v LEFT JOIN n AS b ON b.region = s.region AND b.lulc = from_v""")
def _(t):
    net = t.areas.select("region", "lulc", (F.col("n") * (F.col("lulc") % 5 - 2) / 50).alias("change"))
    return R.distribute_change(net, _reference(t), ["region"])


_MISM = f"""tr AS {_REF}, ar AS (SELECT region, lulc, initial, expected AS desired FROM {_EXPECT}), fl AS (SELECT region, lulc, SUM(d) AS net FROM (SELECT region, to_v AS lulc, amount AS d FROM tr UNION ALL SELECT region, from_v, -amount FROM tr) GROUP BY 1, 2),
 mm AS (SELECT ar.region, ar.lulc, initial, desired, initial + COALESCE(net, 0) AS projected, initial + COALESCE(net, 0) - desired AS mismatch, (initial + COALESCE(net, 0) - desired) * 100 / NULLIF(desired, 0) AS mp FROM ar LEFT JOIN fl ON fl.region = ar.region AND fl.lulc = ar.lulc)"""


@query("r10_area_mismatch", f"WITH {_MISM} SELECT region, lulc, initial, round(desired, 6) AS desired, round(projected, 6) AS projected, round(mismatch, 6) AS mismatch, round(mp, 6) AS mismatch_perc FROM mm")
def _(t):
    return R.area_mismatch(_reference(t), _expect(t).withColumnRenamed("expected", "desired"), ["region"])


@query("r10_target_transitions", f"WITH {_MISM} SELECT tr.region, from_v, to_v, amount, amount = 0 AS zero, a.mp > 2 AND b.mp < -2 AS synergistic FROM tr JOIN mm AS a ON a.region = tr.region AND a.lulc = from_v JOIN mm AS b ON b.region = tr.region AND b.lulc = to_v WHERE a.mp > 2 OR b.mp < -2")
def _(t):
    ref = _reference(t)
    return R.target_transitions(ref, R.area_mismatch(ref, _expect(t).withColumnRenamed("expected", "desired"), ["region"]), ["region"], 2.0)


def _mismatch_sql(name: str, trans: str) -> str:
    return f"""{name}f AS (SELECT region, lulc, SUM(d) AS net FROM (SELECT region, to_v AS lulc, amount AS d FROM {trans} UNION ALL SELECT region, from_v, -amount FROM {trans}) GROUP BY 1, 2),
 {name} AS (SELECT ar.region, ar.lulc, initial, desired, initial + COALESCE(net, 0) AS projected, initial + COALESCE(net, 0) - desired AS mismatch, (initial + COALESCE(net, 0) - desired) * 100 / NULLIF(desired, 0) AS mp FROM ar LEFT JOIN {name}f AS f ON f.region = ar.region AND f.lulc = ar.lulc)"""


_ROUND = f"""tr AS {_REF}, ar AS (SELECT region, lulc, initial, expected AS desired FROM {_EXPECT}), {_mismatch_sql("m0", "tr")},
 g AS (SELECT tr.region, from_v, to_v, amount, amount + CASE WHEN a.mp > 2 AND b.mp < -2 THEN CASE WHEN abs(a.mp) >= abs(b.mp) THEN abs(b.mismatch) ELSE abs(a.mismatch) END ELSE 0 END AS more FROM tr JOIN m0 AS a ON a.region = tr.region AND a.lulc = from_v JOIN m0 AS b ON b.region = tr.region AND b.lulc = to_v),
 gr AS (SELECT region, from_v, to_v, more AS amount FROM g), {_mismatch_sql("m1", "gr")},
 bt AS (SELECT x.region, round(y.s, 9) < round(x.s, 9) AS better FROM (SELECT region, SUM(abs(mp)) AS s FROM m0 GROUP BY 1) AS x JOIN (SELECT region, SUM(abs(mp)) AS s FROM m1 GROUP BY 1) AS y ON y.region = x.region),
 t1 AS (SELECT g.region, from_v, to_v, CASE WHEN better THEN more ELSE amount END AS amount FROM g JOIN bt ON bt.region = g.region), {_mismatch_sql("m2", "t1")},
 h AS (SELECT t1.region, from_v, to_v, abs(a.mismatch) AS ga, abs(b.mismatch) AS gb, abs(a.mp) AS qa, abs(b.mp) AS qb, a.mp > 2 AS ov, b.mp < -2 AS un FROM t1 JOIN m2 AS a ON a.region = t1.region AND a.lulc = from_v JOIN m2 AS b ON b.region = t1.region AND b.lulc = to_v),
 u AS (SELECT region, from_v, to_v, to_v AS cls, gb AS gap, qb AS perc, qa AS opp FROM h WHERE un UNION ALL SELECT region, from_v, to_v, from_v, ga, qa, qb FROM h WHERE ov),
 fa AS (SELECT *, COALESCE(SUM(opp) OVER (PARTITION BY region, cls) / NULLIF(opp, 0), 0) AS factor FROM u),
 ad AS (SELECT *, gap * COALESCE(factor / NULLIF(SUM(factor) OVER (PARTITION BY region, cls), 0), 1.0 / COUNT(*) OVER (PARTITION BY region, cls)) AS add FROM fa),
 la AS (SELECT * FROM ad QUALIFY row_number() OVER (PARTITION BY region, from_v, to_v ORDER BY perc, cls DESC) = 1)"""


@query("r11_improve_round", f"WITH {_ROUND} SELECT t1.region, t1.from_v, t1.to_v, round(amount + COALESCE(add, 0), 6) AS amount FROM t1 LEFT JOIN la ON la.region = t1.region AND la.from_v = t1.from_v AND la.to_v = t1.to_v")
def _(t):
    return R.improve_round(_reference(t), _expect(t).withColumnRenamed("expected", "desired"), ["region"], 2.0)


_STEPS_AR = "(SELECT a.region, a.period, lulc, n AS initial, n * (100 + lulc % 7 * 3 - 9) / 100.0::DOUBLE AS desired FROM areas AS x JOIN (SELECT DISTINCT region, period FROM pair_counts) AS a ON a.region = x.region)"


@query("r10_stepwise_totals", f"""WITH tr AS (SELECT region, period, from_v, to_v, n::DOUBLE AS amount FROM pair_counts WHERE from_v <> to_v), ar AS {_STEPS_AR}, fl AS (SELECT region, period, lulc, SUM(d) AS net FROM (SELECT region, period, to_v AS lulc, amount AS d FROM tr UNION ALL SELECT region, period, from_v, -amount FROM tr) GROUP BY 1, 2, 3),
 mm AS (SELECT ar.region, ar.period, initial + COALESCE(net, 0) - desired AS d, (initial + COALESCE(net, 0) - desired) * 100 / NULLIF(desired, 0) AS q FROM ar LEFT JOIN fl ON fl.region = ar.region AND fl.period = ar.period AND fl.lulc = ar.lulc)
 SELECT region, period, round(SUM(abs(d)), 6) AS total_area, round(SUM(abs(q)), 6) AS total_perc, round(SUM(greatest(-q, 0)), 6) AS undersized, round(SUM(greatest(q, 0)), 6) AS oversized FROM mm GROUP BY 1, 2""")
def _(t):
    keys = ["region", "period"]
    trans = t.pair_counts.filter("from_v <> to_v").select(*keys, "from_v", "to_v", F.col("n").cast("double").alias("amount"))
    areas = t.areas.join(t.pair_counts.select(*keys).distinct(), "region").select(*keys, "lulc", F.col("n").alias("initial"), (F.col("n") * (91 + F.col("lulc") % 7 * 3) / 100).alias("desired"))
    return R.total_mismatch(R.area_mismatch(trans, areas, keys), keys)


@query("r12_best_sweep", "WITH s AS (SELECT scenario, lulc AS threshold, id % 5 AS repetition, SUM(abs(slider_value)) AS total FROM demand GROUP BY 1, 2, 3) SELECT scenario, threshold, repetition, round(total, 6) AS total FROM s QUALIFY row_number() OVER (PARTITION BY scenario ORDER BY total, threshold, repetition) = 1")
def _(t):
    return R.best_sweep(t.demand.groupBy("scenario", F.col("lulc").alias("threshold"), (F.col("id") % 5).alias("repetition")).agg(F.sum(F.abs("slider_value")).alias("total")), "scenario", "total")


@query("r13_areas_to_rates", "WITH a AS (SELECT region, lulc, CAST(floor(year / 4.0) AS INT) AS step, COUNT(*) AS area FROM long_cells GROUP BY ALL) SELECT p.region, a.step + 1 AS step, from_v, to_v, round(p.n / a.area::DOUBLE, 6) AS rate FROM pair_counts AS p JOIN a ON a.region = p.region AND a.lulc = from_v AND a.step + 1 = CAST(split_part(period, '_', 2)::INT // 4 AS INT)")
def _(t):
    step = lambda c: F.floor(c / 4).cast("int")
    areas = t.long_cells.groupBy("region", "lulc", step(F.col("year")).alias("step")).agg(F.count("*").alias("area"))
    trans = t.pair_counts.select("region", F.floor(F.split_part("period", F.lit("_"), F.lit(2)).cast("int") / 4).cast("int").alias("step"), "from_v", "to_v", F.col("n").alias("amount"))
    return R.areas_to_rates(trans, areas, ["region"])


_RESP = "rs AS (SELECT c.region, c.lulc_2018 || '-105' AS task, cell_id, CAST(lulc_2022 = 105 AS INT) AS response FROM cells AS c WHERE lulc_2018 <> 105)"


def _response(t):
    return t.cells.filter("lulc_2018 <> 105").select("region", F.concat_ws("-", "lulc_2018", F.lit("105")).alias("task"), "cell_id", (F.col("lulc_2022") == 105).cast("int").alias("response"))


_KEYS = ["region", "task"]


@query("m1_load_response", f"WITH {_RESP} SELECT region, task, cell_id, response FROM rs")
def _(t):
    both = _response(t)
    return M.load_response(both.unionByName(both.filter("cell_id % 9 = 0").withColumn("response", F.lit(None).cast("int"))), _KEYS)


@query("m2_thin_majority", f"""WITH {_RESP}, k AS (SELECT *, SUM(response) OVER w AS n1, SUM(1 - response) OVER w AS n0, row_number() OVER (PARTITION BY region, task, response ORDER BY cell_id) AS rn FROM rs WINDOW w AS (PARTITION BY region, task))
 SELECT region, task, cell_id, response FROM k WHERE response = 1 OR n0 <= n1 * 1.5 OR (rn - 1) % CAST(ceil(n0 / greatest(ceil(n1 * 1.5), 1)::DOUBLE) AS BIGINT) = 0""")
def _(t):
    return M.thin_majority(_response(t), _KEYS)


@query("m3_class_weights", f"WITH {_RESP}, n AS (SELECT region, task, response, COUNT(*) AS n FROM rs GROUP BY ALL) SELECT *, round(MAX(n) OVER (PARTITION BY region, task) / n::DOUBLE, 6) AS weight FROM n")
def _(t):
    return M.class_weights(_response(t), _KEYS)


@query("m4_task_status", f"WITH {_RESP}, n AS (SELECT region, task, COUNT(*) AS n_observations, CAST(SUM(response) AS BIGINT) AS n_transitions FROM rs GROUP BY 1, 2) SELECT *, CASE WHEN n_transitions = 0 THEN 'no_transition_data' WHEN n_observations < 460 THEN 'insufficient_observations' WHEN n_transitions < 14 THEN 'insufficient_transitions' ELSE 'eligible' END AS status FROM n")
def _(t):
    return M.task_status(_response(t), _KEYS, 460, 14)


@query("m19_needs_downsampling", f"WITH {_RESP}, n AS (SELECT region, task, CAST(SUM(response) AS BIGINT) AS n1, CAST(SUM(1 - response) AS BIGINT) AS n0 FROM rs GROUP BY 1, 2) SELECT *, round(n1::DOUBLE / NULLIF(n0, 0), 6) AS ratio, COALESCE(n1::DOUBLE / NULLIF(n0, 0) <= 0.03 OR n1::DOUBLE / NULLIF(n0, 0) >= 60, FALSE) AS downsample FROM n")
def _(t):
    return M.needs_downsampling(_response(t), _KEYS, 0.03, 60.0)


def _samples(t):
    return _response(t).join(t.predictors.drop("region"), "cell_id")


@query("m5_univariate_pvalues")
def _(t):
    rows = _samples(t).withColumns({"task": F.concat_ws(":", "region", "task")})
    long = rows.unpivot(["task", "response"], ["x1", "x2", "x4", "x5"], "predictor", "x").select("task", "predictor", "x", F.col("response").cast("double").alias("y"), F.lit(1.0).alias("w"))
    return M.univariate_pvalues(long)


@query("m6_correlations", "SELECT a, b, round(r, 6) AS r FROM (SELECT unnest(['x1', 'x1', 'x1', 'x3', 'x3', 'x5']) AS a, unnest(['x3', 'x5', 'x6', 'x5', 'x6', 'x6']) AS b, unnest([corr(x1, x3), corr(x1, x5), NULL, corr(x3, x5), NULL, NULL]) AS r FROM predictors)")
def _(t):
    return M.correlations(t.predictors, ["x1", "x3", "x5", "x6"])


@query("m6_collinearity_filter", "SELECT round(AVG(x3), 6) AS x3, round(AVG(x2), 6) AS x2, round(AVG(x4), 6) AS x4, round(AVG(x5), 6) AS x5 FROM predictors HAVING abs(corr(x3, x1)) > 0.7 AND abs(corr(x3, x2)) <= 0.7 AND abs(corr(x4, x5)) <= 0.7")
def _(t):
    kept = M.collinearity_filter(t.predictors, {"terrain": ["x3", "x1", "x2"], "other": ["x4", "x5", "x6"]}, 0.7)
    return t.predictors.agg(*(F.avg(c).alias(c) for c in kept if c != "x6"))


@query("m7_guided_selection")
def _(t):
    return B.guided_selections(_samples(t), _KEYS, ["x1", "x2", "x3", "x4", "x5", "x6"], balanced=True)


_BALANCED = "n AS (SELECT region, task, response, COUNT(*) AS n, MIN(COUNT(*)) OVER (PARTITION BY region, task) AS lo FROM rs GROUP BY region, task, response)"


@query("m8_balance", f"WITH {_RESP}, {_BALANCED} SELECT region, task, response, CASE WHEN n = lo THEN n ELSE least(n, lo * 2) END AS n FROM n")
def _(t):
    return M.balance(_response(t), _KEYS, 2.0).groupBy(*_KEYS, "response").agg(F.count("*").alias("n"))


@query("m8_balance_proportion", f"WITH {_RESP}, {_BALANCED} SELECT region, task, response, CASE WHEN n = lo THEN n ELSE least(n, CAST(floor(lo * 3 + 1e-9) AS BIGINT)) END AS n FROM n")
def _(t):
    return M.balance(_response(t), _KEYS, proportion=0.25).groupBy(*_KEYS, "response").agg(F.count("*").alias("n"))


@query("m9_stratified_split", f"WITH {_RESP}, n AS (SELECT region, task, response, COUNT(*) AS n FROM rs GROUP BY ALL) SELECT region, task, response, part, CASE WHEN part = 'train' THEN CAST(round(n * 0.75) AS BIGINT) ELSE n - CAST(round(n * 0.75) AS BIGINT) END AS n FROM n, (VALUES ('train'), ('test')) AS p(part) WHERE CASE WHEN part = 'train' THEN CAST(round(n * 0.75) AS BIGINT) ELSE n - CAST(round(n * 0.75) AS BIGINT) END > 0")
def _(t):
    return M.stratified_split(_response(t), _KEYS).groupBy(*_KEYS, "response", "part").agg(F.count("*").alias("n"))


@query("m9_stratified_folds", f"WITH {_RESP}, n AS (SELECT region, task, response, COUNT(*) AS n FROM rs GROUP BY ALL) SELECT region, task, response, CAST(f AS INT) AS fold, COUNT(*) AS n FROM (SELECT region, task, response, unnest(range(1, n + 1)) % 5 AS f FROM n) GROUP BY ALL")
def _(t):
    return M.stratified_folds(_response(t), _KEYS).groupBy(*_KEYS, "response", "fold").agg(F.count("*").alias("n"))


@query("m10_final_sample", f"WITH {_RESP}, {_BALANCED} SELECT region, task, response, CASE WHEN n = lo THEN n ELSE least(n, 300 - lo) END AS n FROM n WHERE n = lo OR lo < 300")
def _(t):
    return M.final_sample(_response(t), _KEYS, 300).groupBy(*_KEYS, "response").agg(F.count("*").alias("n"))


#: Settings that are compared for each task, by family.
_GRID = [{"penalty": p, "mixture": m} for p in (0.001, 0.1) for m in (0.0, 1.0)]
_SPECS = {"glm": _GRID[:2], "rf": [{"trees": 5, "min_n": 5}]}
_X = ["x1", "x2", "x4"]


def _moves(t):
    """Moves of 2018 to 2022 as responses of transitions: each cell of a class for every class that cells of it in its region went to."""
    cells = t.cells.select("cell_id", "region", F.col("lulc_2018").alias("from_v"), F.col("lulc_2022").alias("now"))
    pairs = cells.filter("from_v <> now").select("region", "from_v", F.col("now").alias("to_v")).distinct()
    both = cells.join(pairs, ["region", "from_v"]).withColumn("response", (F.col("now") == F.col("to_v")).cast("int"))
    return both.join(t.predictors.select("cell_id", *_X), "cell_id").select("region", "from_v", "to_v", "cell_id", "response", *_X)


_MOVES = """c AS (SELECT region, lulc_2018 AS from_v, lulc_2022 AS now FROM cells), pr AS (SELECT DISTINCT region, from_v, now AS to_v FROM c WHERE from_v <> now),
 mv AS (SELECT c.region, c.from_v, to_v, CAST(now = to_v AS INT) AS response FROM c JOIN pr ON pr.region = c.region AND pr.from_v = c.from_v)"""


@query("m11_m15_fit_and_score")
def _(t):
    rows = _moves(t)
    keys = ["region", "from_v", "to_v"]
    parts = M.stratified_split(rows, keys)
    table = B.fit_glm(parts.filter("part = 'train'"), keys, _X, [{"penalty": 0.001, "mixture": 0.5}])
    pred = B.score_glm(parts.filter("part = 'test'"), keys, table.select(*keys, "intercept", "coefficients"), _X)
    return M.classification_metrics(pred.withColumn("predicted", (F.col("p") >= 0.5).cast("int")), keys)


# the intercept is free, so a fit that has converged gives each task as many moves as were seen
@query("m11_fitted_totals", f"WITH {_MOVES} SELECT region, from_v, to_v, COUNT(*) AS n, SUM(response) AS moved, SUM(response)::DOUBLE AS fitted, TRUE AS converged FROM mv GROUP BY 1, 2, 3 HAVING SUM(response) < COUNT(*)", digits=3)
def _(t):
    rows, keys = _moves(t), ["region", "from_v", "to_v"]
    table = B.fit_glm(rows, keys, _X, [{"penalty": 0.01, "mixture": 0.5}])
    pred = B.score_glm(rows, keys, table.select(*keys, "intercept", "coefficients", "converged"), _X)
    return pred.groupBy(*keys).agg(F.count("*").alias("n"), F.sum("response").alias("moved"), F.sum("p").alias("fitted"), F.bool_and("converged").alias("converged"))


@query("m12_tune")
def _(t):
    tuned = B.tune_glm(_moves(t), ["region", "from_v", "to_v"], _X, _GRID)
    return tuned.groupBy("region", "from_v", "to_v", "penalty", "mixture").agg(F.avg("roc_auc").alias("roc_auc"), F.count("*").alias("n_fits"))


@query("m14_m15_models_by_task")
def _(t):
    from landweave.queries.sources import _path

    rows = _response(t).join(t.predictors.drop("region"), "cell_id")
    return B.choose_models(rows, ["region"], _X, _SPECS, _path(t, "models"))


@query("t1_potential_by_models")
def _(t):
    keys = ["region", "from_v", "to_v"]
    table = B.fit_glm(_moves(t), keys, _X, _GRID[:1]).select(*keys, "intercept", "coefficients")
    cells = t.cells.select("cell_id", "region", F.col("lulc_2022").alias("from_v")).join(t.predictors.select("cell_id", *_X), "cell_id")
    scored = B.score_glm(cells, ["region", "from_v"], table, _X).select("cell_id", "from_v", "to_v", "p")
    return T.transition_potential(scored, t.orders.select((F.col("o_orderkey") + 1).alias("cell_id")), [(t.mask, T.PRESETS["densification"])])


_PRED = "pr AS (SELECT region, CAST(lulc_2022 = 105 AS INT) AS response, (cell_id * 7 % 11)::DOUBLE / 10 AS p FROM cells)"


@query("m13_metrics", f"""WITH {_PRED}, rk AS (SELECT region, response, AVG(rn) OVER (PARTITION BY region, p) AS r FROM (SELECT *, row_number() OVER (PARTITION BY region ORDER BY p) AS rn FROM pr)),
 au AS (SELECT region, (SUM(r) FILTER (response = 1) - SUM(response) * (SUM(response) + 1) / 2.0::DOUBLE) / (SUM(response) * SUM(1 - response)) AS auc FROM rk GROUP BY 1),
 c AS (SELECT region, SUM(CAST(response = 1 AND p >= 0.5 AS INT))::DOUBLE AS tp, SUM(CAST(response = 0 AND p < 0.5 AS INT))::DOUBLE AS tn, SUM(CAST(response = 0 AND p >= 0.5 AS INT))::DOUBLE AS fp, SUM(CAST(response = 1 AND p < 0.5 AS INT))::DOUBLE AS fn FROM pr GROUP BY 1),
 d AS (SELECT *, tp + tn + fp + fn AS t, (tp + tn) / (tp + tn + fp + fn) AS acc, ((tp + fp) * (tp + fn) + (tn + fn) * (tn + fp)) / pow(tp + tn + fp + fn, 2) AS ch FROM c)
 SELECT d.region, round(auc, 6) AS roc_auc, round(acc, 6) AS accuracy, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall, round(2 * tp / (2 * tp + fp + fn), 6) AS f_meas, round((acc - ch) / (1 - ch), 6) AS kap, round((tp * tn - fp * fn) / sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)), 6) AS mcc, round(tn / (tn + fp), 6) AS specificity FROM d JOIN au ON au.region = d.region""")
def _(t):
    pred = t.cells.select("region", (F.col("lulc_2022") == 105).cast("int").alias("response"), ((F.col("cell_id") * 7 % 11).cast("double") / 10).alias("p"))
    return M.classification_metrics(pred.withColumn("predicted", (F.col("p") >= 0.5).cast("int")), ["region"])


@query("m14_select_best", """WITH r AS (SELECT scenario AS task, curve_type AS model, id % 3 AS replicate, AVG(slider_value) AS v FROM demand GROUP BY 1, 2, 3), m AS (SELECT task, model, AVG(v) AS mean FROM r GROUP BY 1, 2), b AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY task ORDER BY mean DESC, model) = 1)
 SELECT b.task, b.model, round(b.mean, 6) AS mean, r.replicate FROM b JOIN r ON r.task = b.task AND r.model = b.model QUALIFY row_number() OVER (PARTITION BY b.task ORDER BY v DESC, replicate) = 1""")
def _(t):
    rows = t.demand.groupBy(F.col("scenario").alias("task"), F.col("curve_type").alias("model"), (F.col("id") % 3).alias("replicate")).agg(F.avg("slider_value").alias("value")).withColumn("metric", F.lit("roc_auc"))
    return M.select_best(rows, ["task"])


@query("m16_focal_lookup", "SELECT DISTINCT '2018' AS period, 'nhood_n' || (p_partkey % 50) || '_x' AS predictor, 'n' || (p_partkey % 50) || '_' AS layer, p_partkey % 50 AS matrix_id FROM part WHERE p_partkey % 50 BETWEEN 10 AND 49")
def _(t):
    k = F.col("p_partkey") % 50
    sel = t.part.filter(k >= 10).select(F.lit("2018").alias("period"), F.concat(F.lit("nhood_n"), k, F.lit("_x")).alias("predictor")).unionByName(t.part.select(F.lit("2018").alias("period"), F.concat(F.lit("soil_n"), k, F.lit("_x")).alias("predictor")))
    return M.focal_lookup(sel.distinct(), t.part.select(F.concat(F.lit("n"), k, F.lit("_")).alias("layer"), F.lit("2018").alias("layer_period"), k.alias("matrix_id")).distinct())


@query("m17_model_lookup", "SELECT 'r' || region || '.' || from_v || '-' || to_v || '.rds' AS file, 'r' || region AS region_name, from_v, to_v, CASE WHEN to_v <> 107 THEN from_v * 1000 + to_v END AS transition_id FROM pair_counts WHERE period = '2018_2022' AND from_v <> to_v")
def _(t):
    own = t.pair_counts.filter("period = '2018_2022'")
    files = own.select(F.concat(F.lit("r"), "region", F.lit("."), "from_v", F.lit("-"), "to_v", F.lit(".rds")).alias("file"))
    ids = own.filter("to_v <> 107").select("from_v", "to_v", (F.col("from_v") * 1000 + F.col("to_v")).alias("transition_id")).distinct()
    return M.model_lookup(files, ids)


@query("m18_load_predictors", "SELECT COALESCE(s.cell_id, d.cell_id) AS cell_id, round(x1, 6) AS x1, x4 FROM (SELECT cell_id, x1 FROM predictors WHERE region = 2 AND cell_id % 7 <> 0) AS s FULL JOIN (SELECT cell_id, x4 FROM predictors WHERE region = 2 AND cell_id % 3 = 1) AS d ON d.cell_id = s.cell_id")
def _(t):
    scenario = F.when(F.col("cell_id") % 3 == 1, "BAU").otherwise("NAT").alias("scenario")
    return M.load_predictors(t.predictors.filter("cell_id % 7 <> 0").select("cell_id", "region", "x1"), t.predictors.select("cell_id", "region", "x4", scenario, F.lit("2018").alias("period")), ["x1", "x4"], 2, "BAU", "2018")
