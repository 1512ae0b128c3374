"""Checks and profiles of cell tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """NULLs of each column, how many and what share, most first; one pass for all columns."""
    one = df.agg(F.count("*").alias("n"), *(F.sum(F.col(c).isNull().cast("long")).alias(c) for c in cols))
    rows = one.unpivot(["n"], cols, "column_name", "n_null")
    return rows.select("column_name", "n_null", F.try_divide(F.col("n_null").cast("double"), F.col("n")).alias("share")).orderBy(F.col("share").desc(), "column_name")


def sanity_summary(df: DataFrame, region: str, key: str, cols: list[str]) -> DataFrame:
    """By region: rows, different keys, keys that occur twice and more, and NULLs in all cols."""
    per = df.groupBy(region, key).agg(F.count("*").alias("k"), F.sum(sum((F.col(c).isNull().cast("long") for c in cols), F.lit(0))).alias("nulls"))
    return per.groupBy(region).agg(F.sum("k").alias("n_rows"), F.count("*").alias("n_keys"), F.sum((F.col("k") > 1).cast("long")).alias("n_duplicates"), F.sum("nulls").alias("n_nulls"))


def verify_alignment(cells: DataFrame, mask: DataFrame, col: str, one_in: int = 1, seed: int = 123) -> DataFrame:
    """Cells compared, mismatches and cells the mask lacks; one_in > 1 looks at a seeded sample of that rate."""
    some = cells if one_in == 1 else cells.filter(F.pmod(F.xxhash64("cell_id", F.lit(seed)), F.lit(one_in)) == 0)
    both = some.join(mask.select("cell_id", F.col(col).alias("__m")), "cell_id", "left")
    return both.agg(F.count("*").alias("n"), F.sum((F.col(col) != F.col("__m")).cast("long")).alias("n_mismatch"), F.sum(F.col("__m").isNull().cast("long")).alias("n_missing"))


def overlap_counts(static: DataFrame, dynamic: DataFrame, trans: DataFrame) -> DataFrame:
    """By region: cells in each of three tables and in their overlaps."""
    flag = lambda df, n: df.select("region", "cell_id").distinct().withColumn(n, F.lit(1))
    both = flag(static, "s").join(flag(dynamic, "d"), ["region", "cell_id"], "full").join(flag(trans, "t"), ["region", "cell_id"], "full")
    n = lambda *c: F.sum(F.when(sum((F.coalesce(x, F.lit(0)) for x in c), F.lit(0)) == len(c), 1).otherwise(0)).alias("n_" + "".join(c))
    return both.groupBy("region").agg(n("s"), n("d"), n("t"), n("s", "d"), n("s", "t"), n("d", "t"), n("s", "d", "t"))


def set_mismatch(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys that only one side has."""
    one = lambda x, y, side: x.select(key).subtract(y.select(key)).withColumn("only_in", F.lit(side))
    return one(a, b, "a").unionByName(one(b, a, "b"))


def completeness(df: DataFrame, by: list[str], col: str, required: list) -> DataFrame:
    """By group: whether all required values are there, and the missing ones in order."""
    need = F.array(*map(F.lit, required))
    missing = F.array_except(need, F.collect_set(F.when(F.col(col).isin(*required), F.col(col))))
    return df.groupBy(*by).agg((F.size(missing) == 0).alias("complete"), F.array_join(F.array_sort(missing), ",").alias("missing"))


def zonal(df: DataFrame, zone: list[str], aggs: dict[str, Column]) -> DataFrame:
    return df.groupBy(*zone).agg(*(c.alias(n) for n, c in aggs.items()))


def zonal_fold(df: DataFrame, zone: list[str], value: str, partial: Callable[[np.ndarray], Sequence[float]], finish: Callable[[np.ndarray], float], name: str = "value") -> DataFrame:
    """(zone, name): a statistic of the user's own. partial: numbers that add up (always as many) from an array of values
    of one zone; finish: the statistic from their sums.

    partial sees what a batch holds of a zone; only its sums leave the task, and they are added up by zone and place, so no
    zone meets in one task. Nulls don't count.
    """
    key = F.to_json(F.struct(*(F.col(c) for c in zone)), {"ignoreNullFields": "false"})
    rows = df.filter(F.col(value).isNotNull()).select(key.alias("key"), F.col(value).cast("double").alias("v"))

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [(k, place, float(x)) for k, v in pdf.groupby("key")["v"] for place, x in enumerate(partial(v.to_numpy()))]
            yield pd.DataFrame(found, columns=["key", "place", "x"])

    def end(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"key": pdf["key"], "x": [float(finish(np.array([p["x"] for p in sorted(own, key=lambda p: p["place"])]))) for own in pdf["all"]]})

    sums = rows.mapInPandas(add, "key string, place int, x double").groupBy("key", "place").agg(F.sum("x").alias("x"))
    whole = sums.groupBy("key").agg(F.collect_list(F.struct("place", "x")).alias("all"))
    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in zone)
    return whole.mapInPandas(end, "key string, x double").withColumn("k", F.from_json("key", schema)).select(*(F.col(f"k.`{c}`").alias(c) for c in zone), F.col("x").alias(name))


def share_of_parent(df: DataFrame, unit: str, parent: str, value: str) -> DataFrame:
    """A unit's value as percent of its parent's; 0 where the parent has none."""
    from pyspark.sql import Window

    n = df.groupBy(parent, unit).agg(F.sum(value).alias("value"))
    return n.withColumn("perc", F.coalesce(F.try_divide(F.col("value") * 100.0, F.sum("value").over(Window.partitionBy(parent))), F.lit(0.0)))


def allocate_population(shares: DataFrame, projections: DataFrame, cells: DataFrame, unit: str, parent: str) -> DataFrame:
    """Projected totals of the parents split by their units' shares (rescaled to 1; 0/0 is 0), given to the units' cells."""
    from pyspark.sql import Window

    w = F.coalesce(F.try_divide(F.col("perc"), F.sum("perc").over(Window.partitionBy(parent))), F.lit(0.0))
    pop = shares.withColumn("w", w).join(projections, parent).select(unit, parent, "year", (F.col("w") * F.col("total")).alias("population"))
    return cells.join(pop, [unit, parent]).select("cell_id", "year", "population")
