"""Joins and windows with a rule of their own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landweave.operators.ranks import ranked

#: Spans that are broadcast.
FEW = 10_000


def nearest_value(wanted: DataFrame, known: DataFrame, a: str, b: str) -> DataFrame:
    """For each wanted value the nearest known one, the smaller of two as near.

    Both sides are lists of years (different values only), so the neighbours come from one ordered pass over them.
    """
    marks = wanted.select(F.col(a).alias("__v"), F.lit(True).alias("__w")).union(known.select(F.col(b).alias("__v"), F.lit(False))).distinct()
    w, own = Window.orderBy("__v"), F.when(~F.col("__w"), F.col("__v"))
    low, high = F.last(own, ignorenulls=True).over(w.rangeBetween(Window.unboundedPreceding, 0)), F.first(own, ignorenulls=True).over(w.rangeBetween(0, Window.unboundedFollowing))
    near = marks.withColumns({"__low": low, "__high": high}).filter("__w")
    nearest = F.when(F.col("__high").isNull() | (F.col("__v") - F.col("__low") <= F.col("__high") - F.col("__v")), F.col("__low")).otherwise(F.col("__high"))
    return near.select(F.col("__v").alias(a), nearest.alias(b))


def interval_join(rows: DataFrame, spans: DataFrame, at: str, low: str, high: str, closed: bool = False) -> DataFrame:
    """Rows with the spans that hold them, (low, high] or [low, high].

    Up to FEW spans (periods) are broadcast. Beyond that rows and spans meet in bins as wide as the mean span.
    """
    start = (F.col(at) >= F.col(low)) if closed else (F.col(at) > F.col(low))
    inside = start & (F.col(at) <= F.col(high))
    n, wide = spans.agg(F.count("*"), F.avg(F.col(high) - F.col(low))).first()
    if n <= FEW:
        return rows.join(F.broadcast(spans), inside)
    bin_of = lambda c: F.floor(F.col(c) / max(float(wide), 1e-9)).cast("long")
    cut = spans.withColumn("__bin", F.explode(F.sequence(bin_of(low), bin_of(high))))
    return rows.withColumn("__bin", bin_of(at)).join(cut, "__bin").filter(inside).drop("__bin")


def carry_forward(df: DataFrame, by: list[str], order: str, value: str) -> DataFrame:
    """NULLs take the last value before them, leading ones the first value after."""
    w = Window.partitionBy(*by).orderBy(order)
    back = F.last(value, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    ahead = F.first(value, ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))
    return df.withColumn(value, F.coalesce(back, ahead))


def thin_evenly(df: DataFrame, by: list[str], order: str, target: Column) -> DataFrame:
    """Every k-th row in order (of a number), k = ceil(n / target), so rather fewer than target."""
    rows = ranked(df, by, [F.col(order)])
    return rows.filter((F.col("__rn") - 1) % F.ceil(F.col("__n") / target) == 0).drop("__rn", "__n")
