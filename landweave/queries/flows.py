"""Queries of whole flows."""

from __future__ import annotations

from pyspark.sql import functions as F

from landweave.fixtures import YEARS
from landweave.operators.potential import PRESETS
from landweave.plans import identify_transitions, time_step
from landweave.queries.base import query
from landweave.queries.rates import PERIODS
from landweave.queries.scenarios import _NORM, _WHOLE

_PARTS = ", ".join(f"round(MAX(rate) FILTER (p = '{p}'), 6) AS rate_{p}" for p, _, _ in PERIODS)
_ALL = " UNION ALL ".join(f"SELECT '{a}_{b}' AS p, lulc_{a} AS from_v, lulc_{b} AS to_v, COUNT(*) AS n FROM cells GROUP BY 2, 3" for a, b in zip(YEARS, YEARS[1:], strict=False))


@query("l1_identify_transitions", f"""WITH n AS ({_ALL}), r AS (SELECT *, n / SUM(n::DOUBLE) OVER (PARTITION BY p, from_v) AS rate FROM n), w AS (SELECT from_v, to_v, {_PARTS} FROM r WHERE from_v <> to_v GROUP BY 1, 2)
 SELECT *, lpad(CAST(row_number() OVER (ORDER BY from_v, to_v) AS VARCHAR), 3, '0') AS trans_id FROM w""")
def _(t):
    return identify_transitions(t.cells, PERIODS)


@query("l3_time_step", f"""WITH {_NORM}, {_WHOLE}, a AS (SELECT cell_id, from_v, to_v, CASE WHEN cell_id IN (SELECT cell_id FROM mask) AND p > 0 AND to_v = 105 THEN 1 ELSE p END AS p FROM nm), b AS (SELECT *, round(SUM(p) OVER (PARTITION BY cell_id), 12) AS s FROM a),
 f AS (SELECT b.cell_id, b.from_v, b.to_v, CASE WHEN s > 1 THEN p / s ELSE p END AS p, n FROM b JOIN qn ON qn.from_v = b.from_v AND qn.to_v = b.to_v)
 SELECT cell_id, from_v, to_v, round(p, 9) AS p FROM f WHERE p > 0 QUALIFY row_number() OVER (PARTITION BY from_v, to_v ORDER BY round(p, 12) DESC, cell_id) <= n""", digits=9)
def _(t):
    none = t.spark.createDataFrame([], "from_v int, to_v int, perc_expander double")
    scored = t.probs.select("cell_id", "from_v", "to_v", "p")
    return time_step(t.cells, "lulc_2018", "lulc_2022", scored, [(t.mask, PRESETS["densification"])], none, 1.0).select("cell_id", "from_v", "to_v", F.col("p"))
