"""Stand-ins for maps and tables, derived from the star-schema tables; the same SQL text runs in Spark and in the oracle."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

#: Class values with names and whether they count as neighbourhood classes: fixed values.
CLASSES = ((101, "water", False), (102, "forest", False), (103, "cropland", True), (104, "grassland", True), (105, "urban", True), (106, "bare", False), (107, "glacier", False))
YEARS = (2010, 2014, 2018, 2022)

SQL = {
    "cells0": """SELECT o_orderkey + 1 AS cell_id, CAST(FLOOR(o_orderkey / 100.0) AS INT) + 1 AS row, CAST(o_orderkey % 100 AS INT) + 1 AS col,
       CAST(1 + 2 * (CAST(FLOOR(o_orderkey / 800.0) AS INT) % 2) + FLOOR((o_orderkey % 100) / 50.0) AS INT) AS region,
       CAST(o_custkey % 10 <> 0 AS INT) AS valid, o_custkey, o_orderpriority, o_totalprice,
       CAST(CASE WHEN o_custkey % 5 = 1 THEN 101 + o_custkey % 7
            ELSE 101 + (CAST(FLOOR(o_orderkey / 600.0) AS INT) + 2 * CAST(FLOOR((o_orderkey % 100) / 7.0) AS INT)) % 7 END AS INT) AS l0 FROM orders""",
    "cells1": "SELECT *, CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(101 + (l0 - 101 + 1 + o_custkey % 2) % 7 AS INT) ELSE l0 END AS l1 FROM cells0",
    "cells2": "SELECT *, CASE WHEN o_orderpriority = '2-HIGH' THEN CAST(101 + (l1 - 101 + 1 + o_custkey % 2) % 7 AS INT) ELSE l1 END AS l2 FROM cells1",
    "cells3": "SELECT *, CASE WHEN o_orderpriority = '3-MEDIUM' THEN CAST(101 + (l2 - 101 + 1 + o_custkey % 2) % 7 AS INT) ELSE l2 END AS l3 FROM cells2",
    "cells": "SELECT cell_id, row, col, region, o_totalprice AS elevation, l0 AS lulc_2010, l1 AS lulc_2014, l2 AS lulc_2018, l3 AS lulc_2022 FROM cells3 WHERE valid = 1",
    "mask": "SELECT cell_id, row, col, 1 AS zone FROM cells WHERE (CAST(FLOOR(row / 20.0) AS INT) + CAST(FLOOR(col / 20.0) AS INT)) % 3 = 0",
    "predictors": """SELECT g.cell_id, g.region, g.elevation AS x1, CAST(c.c_acctbal AS DOUBLE) AS x2,
       g.elevation * CAST(0.9 AS DOUBLE) + CAST((o.o_custkey % 13) * 1000 AS DOUBLE) AS x3, CAST(o.o_custkey % 97 AS DOUBLE) AS x4,
       CAST(NULLIF(o.o_custkey % 11, 3) AS DOUBLE) AS x5, CAST(1 AS DOUBLE) AS x6
       FROM cells AS g JOIN orders AS o ON o.o_orderkey = g.cell_id - 1 JOIN customer AS c ON c.c_custkey = o.o_custkey""",
    "probs": """SELECT g.cell_id, g.region, g.lulc_2022 AS from_v, k.to_v, CAST((g.cell_id * 31 + k.to_v * 17) % 997 AS DOUBLE) / 997 AS p
       FROM cells AS g CROSS JOIN (SELECT DISTINCT lulc_2022 AS to_v FROM cells) AS k WHERE k.to_v <> g.lulc_2022""",
    "climate": """SELECT CAST(l_partkey % n_cells AS INT) + 1 AS cell_id, concat('gcm', CAST(l_suppkey % 5 AS VARCHAR(4))) AS gcm, l_returnflag AS ssp,
       CAST(EXTRACT(MONTH FROM l_shipdate) AS INT) AS month, AVG(l_quantity) - 10 AS tasmin, AVG(l_quantity) + 5 AS tasmax,
       AVG(l_extendedprice) / 10000 AS pr, 100 + AVG(l_tax) * 1000 AS rsds FROM lineitem CROSS JOIN (SELECT GREATEST(1, FLOOR(COUNT(*) / 40.0)) AS n_cells FROM part) AS k GROUP BY 1, 2, 3, 4""",
    "demand": """SELECT user_id AS id, CAST(user_id % 4 AS INT) + 1 AS region, CASE event_id % 3 WHEN 0 THEN 'BAU' WHEN 1 THEN 'NAT' ELSE 'SOC' END AS scenario,
       CAST(101 + event_id % 7 AS INT) AS lulc, value - 10 AS slider_value, CAST(1 + event_id % 9 AS DOUBLE) / 10 AS confidence_factor,
       CAST((event_id % 21) - 10 AS DOUBLE) / 10 AS initial_rate,
       CASE event_type WHEN 'click' THEN 'Instant growth' WHEN 'view' THEN 'Delayed growth' WHEN 'signup' THEN 'Instant decline'
         WHEN 'purchase' THEN 'Delayed decline' ELSE 'Constant change' END AS curve_type FROM events""",
    "points": "SELECT c_custkey AS id_coord, CAST(c_custkey * 37 % 1000 AS DOUBLE) / 10 AS lon, CAST(c_custkey * 61 % 997 AS DOUBLE) / 10 AS lat FROM customer",
    "polygons": """SELECT n.n_nationkey AS poly_id, n.n_regionkey AS parent_id, v.seq, CAST((n.n_nationkey % 5) * 20 + v.dx AS DOUBLE) AS x,
       CAST(CAST(FLOOR(n.n_nationkey / 5.0) AS INT) * 30 + v.dy AS DOUBLE) AS y FROM nation AS n CROSS JOIN
       (SELECT 1 AS seq, 2 AS dx, 1 AS dy UNION ALL SELECT 2, 18, 3 UNION ALL SELECT 3, 16, 27 UNION ALL SELECT 4, 4, 24) AS v""",
    "classes": "SELECT * FROM (VALUES " + ", ".join(f"({v}, '{n}', {str(b).upper()})" for v, n, b in CLASSES) + ") AS c(value, class_name, nhood_class)",
    "long_cells": " UNION ALL ".join(f"SELECT cell_id, region, {y} AS year, lulc_{y} AS lulc FROM cells" for y in YEARS),
    "areas": "SELECT region, lulc_2022 AS lulc, COUNT(*) AS n FROM cells GROUP BY region, lulc_2022",
    "pair_counts": " UNION ALL ".join(f"SELECT region, '{a}_{b}' AS period, lulc_{a} AS from_v, lulc_{b} AS to_v, COUNT(*) AS n FROM cells GROUP BY region, lulc_{a}, lulc_{b}" for a, b in zip(YEARS, YEARS[1:], strict=False)),
    "rates": """SELECT region, period, from_v, to_v, CAST(n AS DOUBLE) / total AS rate FROM
       (SELECT *, SUM(n) OVER (PARTITION BY region, period, from_v) AS total FROM pair_counts) AS q WHERE from_v <> to_v""",
}


def needed(text: str) -> list[str]:
    """Fixtures that text and the fixtures it uses refer to, in the order of SQL."""
    found: set[str] = set()

    def look(t: str) -> None:
        for name in SQL:
            if name not in found and re.search(rf"\b(FROM|JOIN)\s+{name}\b", t):
                found.add(name)
                look(SQL[name])

    look(text)
    return [n for n in SQL if n in found]


def with_fixtures(text: str) -> str:
    """text, a query with or without WITH, on top of the fixtures it uses."""
    head = [f"{n} AS ({SQL[n]})" for n in needed(text)]
    body = re.sub(r"^\s*WITH\s+(RECURSIVE\s+)?", "", text)
    if body != text:
        return "WITH RECURSIVE " + ", ".join([*head, body])
    return ("WITH RECURSIVE " + ", ".join(head) + " " + text) if head else text


class Tables:
    """Tables of a folder and the fixtures derived from them, as DataFrames: t.orders, t.cells and so on."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in BASE:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        if name not in SQL:
            raise AttributeError(name)
        text = with_fixtures(f"SELECT * FROM {name}").replace("WITH RECURSIVE", "WITH", 1)
        used = [b for b in BASE if re.search(rf"\b(FROM|JOIN)\s+{b}\b", text)]
        for b in used:
            text = re.sub(rf"\b(FROM|JOIN)\s+{b}\b", rf"\1 {{{b}}}", text)
        return self.spark.sql(text, **{b: getattr(self, b) for b in used})
