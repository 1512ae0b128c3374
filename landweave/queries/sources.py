"""Queries that write a table and read it back."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from landweave.fixtures import Tables
from landweave.queries.base import query
from landweave.sources import catalog as S
from landweave.sources import io


def _path(t: Tables, name: str) -> str:
    """A new path in the folder that all machines share."""
    base = t.spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not t.spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="landweave-")
    return f"{base}/{name}-{uuid.uuid4().hex}"


@query("s1_s3_write_static", "SELECT cell_id, region, round(x1, 6) AS x1, x5 FROM predictors WHERE region = 2")
def _(t):
    path = _path(t, "static")
    io.write_static(t.predictors.select("cell_id", "region", "x1", "x5"), path)
    return io.read_cells(t.spark, path, T.StructType.fromDDL("cell_id long, x1 double, x5 double, region int")).filter("region = 2")


@query("s4_write_dynamic", "SELECT '2018' AS period, CASE WHEN cell_id % 2 = 0 THEN 'BAU' ELSE 'NAT' END AS scenario, region, COUNT(*) AS n, round(SUM(x4), 3) AS total FROM predictors GROUP BY ALL")
def _(t):
    path = _path(t, "dynamic")
    io.write_dynamic(t.predictors.select("cell_id", "region", "x4", F.lit("2018").alias("period"), F.when(F.col("cell_id") % 2 == 0, "BAU").otherwise("NAT").alias("scenario")), path)
    back = io.read_cells(t.spark, path, T.StructType.fromDDL("cell_id long, x4 double, period string, scenario string, region int"))
    return back.groupBy("period", "scenario", "region").agg(F.count("*").alias("n"), F.round(F.sum("x4"), 3).alias("total"))


@query("s5_write_transitions", "SELECT cell_id, region, CAST(lulc_2022 = 105 AS INT) AS response FROM cells WHERE lulc_2018 = 103")
def _(t):
    from landweave.operators.grid import transition_response

    path = _path(t, "transitions")
    rows = transition_response(t.cells, t.spark.createDataFrame([(103, 105)], "from_v int, to_v int"), "lulc_2018", "lulc_2022")
    io.write_transitions(rows.drop("from_v", "to_v"), path)
    return io.read_cells(t.spark, path, T.StructType.fromDDL("cell_id long, response int, region int"))


@query("s6_csv_dialects", "SELECT c_custkey, round(c_acctbal, 2) AS c_acctbal, c_mktsegment FROM customer")
def _(t):
    path, schema = _path(t, "csv"), T.StructType.fromDDL("c_custkey long, c_acctbal double, c_mktsegment string")
    comma = F.regexp_replace(F.round("c_acctbal", 2).cast("string"), r"\.", ",")
    t.customer.select("c_custkey", comma.alias("c_acctbal"), "c_mktsegment").write.option("header", True).option("sep", ";").csv(path)
    back, again = io.read_csv(t.spark, path, schema, "semicolon"), path + "-gz"
    io.write_csv(back, again, gzip=True)
    return io.read_csv(t.spark, again, schema)


@query("s7_read_class_schema", "SELECT lulc_2022 * 10 + k AS old, lulc_2022 AS new, class_name FROM (SELECT DISTINCT lulc_2022, class_name FROM cells JOIN classes ON value = lulc_2022), (VALUES (1), (2)) AS v(k) UNION ALL SELECT 0, NULL, NULL")
def _(t):
    path = _path(t, "classes")
    own = t.cells.select(F.col("lulc_2022").alias("value")).distinct().join(t.classes, "value")
    old = F.array(*(F.struct((F.col("value") * 10 + k).alias("value"), F.lit("x").alias("name")) for k in (1, 2)))
    own.select("class_name", F.col("class_name").alias("clean_name"), F.lit("#fff").alias("colour"), "value", "nhood_class", old.alias("original_classes")).write.json(path)
    return S.read_class_schema(t.spark, path)


@query("s12_list_files")
def _(t):
    path = _path(t, "static")
    io.write_static(t.predictors.select("cell_id", "region", "x1"), path)
    return io.list_files(t.spark, path)


@query("s12_total_is_sum", "SELECT COUNT(DISTINCT region) AS n_folders, TRUE AS adds_up FROM predictors")
def _(t):
    path = _path(t, "static")
    io.write_static(t.predictors.select("cell_id", "region", "x1"), path)
    own = F.col("file") != "total"
    found = io.list_files(t.spark, path).agg(F.countDistinct(F.when(own, F.regexp_extract("file", "region=([^/]*)", 1))).alias("n_folders"), F.sum(F.when(own, F.col("bytes"))).alias("bytes"), F.sum(F.when(~own, F.col("bytes"))).alias("total"))
    return found.select("n_folders", (F.col("bytes") == F.col("total")).alias("adds_up"))
