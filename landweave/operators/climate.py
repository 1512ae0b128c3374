"""Climate tables keyed by cell, model and month."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landweave.functions import days_in_month
from landweave.operators.quality import completeness


def full_ensembles(df: DataFrame, by: list[str], gcms: list[str]) -> DataFrame:
    """Rows of groups that have all models; the rest is for missing_gcms to report."""
    ok = completeness(df, by, "gcm", gcms).filter("complete").select(*by)
    return df.join(ok, by, "left_semi")


def missing_gcms(df: DataFrame, by: list[str], gcms: list[str]) -> DataFrame:
    return completeness(df, by, "gcm", gcms).filter("NOT complete").select(*by, "missing")


def ensemble_yearly(df: DataFrame, gcms: list[str]) -> DataFrame:
    """By cell and scenario, all models present: temperatures as mean of months and models, precipitation as sum of months and mean of models."""
    own = full_ensembles(df, ["cell_id", "ssp"], gcms)
    per = own.groupBy("cell_id", "ssp", "gcm").agg(F.avg("tasmin").alias("tasmin"), F.avg("tasmax").alias("tasmax"), F.sum("pr").alias("pr"), F.avg("rsds").alias("rsds"))
    return per.groupBy("cell_id", "ssp").agg(*(F.avg(c).alias(c) for c in ("tasmin", "tasmax", "pr", "rsds")))


def ensemble_monthly(df: DataFrame, gcms: list[str], year: int = 2001) -> DataFrame:
    """By cell, scenario and month, twelve months present: temperature as model mean, precipitation per day times days of the month."""
    own = full_ensembles(df, ["cell_id", "ssp", "month"], gcms)
    out = own.groupBy("cell_id", "ssp", "month").agg(F.avg("tasmin").alias("tasmin"), F.avg("tasmax").alias("tasmax"), (F.avg("pr") * F.first(days_in_month(F.lit(year), F.col("month")))).alias("pr"))
    full = out.groupBy("cell_id", "ssp").agg(F.countDistinct("month").alias("m")).filter("m = 12").select("cell_id", "ssp")
    return out.join(full, ["cell_id", "ssp"], "left_semi")


def monthly_precipitation(df: DataFrame, gcms: list[str], first_year: int = 2001) -> DataFrame:
    """(cell_id, ssp, month, pr): 360 bands are days' rates of 30 years, times the days of each month (leap years
    too) and averaged over years and models; 12 bands are months' sums, averaged over models.

    df: cell_id, ssp, gcm, band (from 1), pr. Series of other lengths don't count, nor do months without all models.
    """
    n = df.groupBy("cell_id", "ssp", "gcm").agg(F.countDistinct("band").alias("bands")).filter("bands IN (12, 360)")
    month, year = (F.col("band") - 1) % 12 + 1, F.lit(first_year) + F.floor((F.col("band") - 1) / 12)
    rows = df.join(n, ["cell_id", "ssp", "gcm"]).withColumns({"month": month.cast("int"), "days": days_in_month(year.cast("int"), month.cast("int"))})
    per = rows.groupBy("cell_id", "ssp", "gcm", "month").agg(F.avg(F.when(F.col("bands") == 360, F.col("pr") * F.col("days")).otherwise(F.col("pr"))).alias("pr"))
    return full_ensembles(per, ["cell_id", "ssp", "month"], gcms).groupBy("cell_id", "ssp", "month").agg(F.avg("pr").alias("pr"))


def historic_layers(df: DataFrame) -> DataFrame:
    """Long (cell_id, variable, value): twelve bands as mean (temperatures) or sum (precipitation); a single band passes through.

    Other numbers of bands are no layer.
    """
    long = df.unpivot(["cell_id", "month"], ["tasmin", "tasmax", "pr", "rsds"], "variable", "value").filter("value IS NOT NULL")
    n = long.groupBy("cell_id", "variable").agg(F.countDistinct("month").alias("bands"), F.when(F.col("variable") == "pr", F.sum("value")).otherwise(F.avg("value")).alias("value"))
    return n.filter("bands IN (1, 12)").drop("bands")


def monthly_climatology(df: DataFrame, value: str, file: str, least: int = 2) -> DataFrame:
    """Mean over files of each cell and month. All files must have the same cells; fewer than least of them are no climatology."""
    shapes = df.groupBy(file).agg(F.countDistinct("cell_id").alias("n"), F.sum_distinct("cell_id").alias("sum"), F.min("cell_id").alias("low"), F.max("cell_id").alias("high"))
    if shapes.select("n", "sum", "low", "high").distinct().count() > 1:
        raise ValueError("files differ in their cells")
    return df.groupBy("cell_id", "month").agg(F.avg(value).alias(value), F.countDistinct(file).alias("n_files")).filter(F.col("n_files") >= least)


def et0_turc(df: DataFrame) -> DataFrame:
    """Annual Turc evapotranspiration of cells with all twelve months (tasmin, tasmax, rsds; a year of 365 days)."""
    mean = (F.col("tasmin") + F.col("tasmax")) / 2
    ratio = F.when(mean > 0, mean / (mean + 15)).otherwise(0.0)
    monthly = df.withColumn("et0", ratio * (0.3107 * F.col("rsds") + 0.65) * days_in_month(F.lit(2001), F.col("month")))
    return monthly.groupBy("cell_id").agg(F.sum("et0").alias("et0"), F.countDistinct("month").alias("m")).filter("m = 12").drop("m")


def quick_stats(df: DataFrame, by: list[str], value: str) -> DataFrame:
    return df.groupBy(*by).agg(F.min(value).alias("min"), F.avg(value).alias("mean"), F.max(value).alias("max"))
