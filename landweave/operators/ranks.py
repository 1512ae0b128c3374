"""Ranks, running sums and exact percentiles of large groups, whatever their values: no group is ordered in one task.

Rows are ranged by key and order, with splitters that Spark draws from a sample, so crowded values get parts of their own
and a group may be many parts. Sums within a part are added to the sums of the parts before it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def kept(df: DataFrame) -> DataFrame:
    """df computed once: a table in the session's checkpoint folder; in local mode without one, cached.

    On a cluster that folder must be set: what only executors cache is lost with them.
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir():
        path = f"{sc.getCheckpointDir()}/kept-{uuid.uuid4().hex}"
        df.write.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    df = df.cache()
    df.count()
    return df


def running(df: DataFrame, keys: list[str], order: list[Column], values: dict[str, Column]) -> DataFrame:
    """df with, for each name of values, the sum over the rows of the same keys before the row (in order), and name + "_all", the keys' total.

    order should tell rows apart, or rows that it doesn't may come in any order. Values are whole numbers or doubles.
    """
    spark = df.sparkSession
    key = F.to_json(F.struct(*(F.col(k) for k in keys)), {"ignoreNullFields": "false"}) if keys else F.lit("")
    rows = df.withColumns({"__key": key, **{f"__{v}": c for v, c in values.items()}})
    rows = rows.withColumns({f"__{v}": F.col(f"__{v}").cast("double" if rows.schema[f"__{v}"].dataType.typeName() in ("double", "float", "decimal") else "long") for v in values})
    by = [*(F.col(k) for k in keys), *order]
    ranged = rows.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *by).sortWithinPartitions(*by)
    names, added = ranged.columns, [f"__{v}" for v in values]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, last = TaskContext.get().partitionId(), None
        seen = dict.fromkeys(added, 0)
        for batch in batches:
            if not batch.num_rows:
                continue
            own = batch.column("__key")
            first = np.r_[own[0].as_py() != last, pc.not_equal(own[1:], own[:-1]).to_numpy(zero_copy_only=False)]
            start = np.maximum.accumulate(np.where(first, np.arange(len(own)), -1))
            out = []
            for c in added:
                v = batch.column(c).fill_null(0).to_numpy(zero_copy_only=False)
                upto = np.r_[v[:0], np.cumsum(v)]
                before = upto - v
                sums = np.where(start < 0, seen[c] + before, before - before[np.maximum(start, 0)])
                seen[c] = sums[-1] + v[-1]
                out.append(pa.array(sums))
            last = own[-1].as_py()
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(np.full(len(own), part)), *out], names=[*names, "__part", *(f"{c}_before" for c in added)])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranged.schema)
    more = ", ".join(f"`{c}_before` {ranged.schema[c].dataType.simpleString()}" for c in added)
    numbered = kept(ranged.mapInArrow(run, f"{fields}, __part long, {more}"))
    sizes = numbered.groupBy("__key", "__part").agg(*(F.sum(c).alias(c) for c in added))
    own = Window.partitionBy("__key")
    upto = own.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("__key", "__part", *(F.coalesce(F.sum(c).over(upto), F.lit(0)).alias(f"{c}_base") for c in added), *(F.sum(c).over(own).alias(f"{c}_all") for c in added))
    out = numbered.join(bases, ["__key", "__part"])
    return out.select(*df.columns, *(x for v in values for x in ((F.col(f"__{v}_base") + F.col(f"__{v}_before")).alias(v), F.col(f"__{v}_all").alias(f"{v}_all"))))


def ranked(df: DataFrame, keys: list[str], order: list[Column], name: str = "__rn") -> DataFrame:
    """df with its rank (from 1) among the rows of keys, and with __n of them."""
    out = running(df, keys, order, {name: F.lit(1).cast("long")})
    return out.withColumn(name, F.col(name) + 1).withColumnRenamed(f"{name}_all", "__n")


#: Rank error of the percentile sketch is at most a group's size over this.
ACCURACY = 10_000


def percentiles(df: DataFrame, keys: list[str], value: str, share: float | Column, among: list[float] | None = None) -> DataFrame:
    """keys and q: the exact percentile (linear between neighbours); null values don't count.

    share: a number, or a column of the keys whose values are those of among. A sketch brackets each group's percentile;
    values in the bracket are counted by value and put in order, those below it only counted. df is read twice,
    so it should be a table or kept.
    """
    rows = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("__v"), (share if isinstance(share, Column) else F.lit(float(share))).alias("__share"))
    shares = sorted(set(among or [share]))
    near = [min(1.0, max(0.0, s + d * 3 / ACCURACY)) for s in shares for d in (-1, 1)]
    sketch = F.percentile_approx("__v", near, ACCURACY)
    n = rows.groupBy(*keys).agg(F.count("*").alias("__n"), F.max("__share").alias("__s"), sketch.alias("__near"))
    pick = lambda d: F.coalesce(*(F.when(F.col("__s") == F.lit(float(s)), F.get("__near", 2 * i + d)) for i, s in enumerate(shares)))
    n = n.select(*(F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)), "__n", (F.col("__s") * (F.col("__n") - 1)).alias("__at"), pick(0).alias("__lo"), pick(1).alias("__hi"))
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    met = (rows.join(n, same) if keys else rows.crossJoin(F.broadcast(n))).drop("__share", *(f"__k{i}" for i in range(len(keys))))
    # what lies below or above a bracket is one row, with a count and the value next to the bracket; the rest a row for each value
    side = F.when(F.col("__v") < F.col("__lo"), -1).when(F.col("__v") > F.col("__hi"), 1).otherwise(0)
    met = met.withColumn("__side", side).groupBy(*keys, "__side", F.when(side == 0, F.col("__v")).alias("__own"))
    met = met.agg(F.max("__v").alias("__max"), F.min("__v").alias("__min"), F.count("*").alias("__c"), F.first("__at").alias("__at"), F.first("__n").alias("__n"))
    met = met.withColumn("__to", F.sum("__c").over(Window.partitionBy(*keys).orderBy("__side", "__own")))
    met = met.withColumn("__v", F.when(F.col("__side") < 0, F.col("__max")).otherwise(F.col("__min")))
    low = F.floor("__at")
    first = F.when(F.col("__side") < 0, F.col("__to") - 1).otherwise(F.col("__to") - F.col("__c"))
    last = F.when(F.col("__side") > 0, F.col("__to") - F.col("__c")).otherwise(F.col("__to") - 1)
    holds = lambda k: F.max(F.when((first <= k) & (last >= k), F.col("__v")))
    a, b, part = holds(low), holds(F.least(low + 1, F.col("__n") - 1)), F.max("__at") - F.floor(F.max("__at"))
    q = a + (F.coalesce(b, a) - a) * part
    missed = a.isNull() | (b.isNull() & (part > 0))
    return met.groupBy(*keys).agg(F.when(F.count("*") > 0, F.when(missed, F.raise_error(F.lit("the percentile lies outside its bracket"))).otherwise(q)).alias("q")).filter("q IS NOT NULL")
