"""Class areas, transitions and their rates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landweave.operators.ranks import kept


def class_area(long_cells: DataFrame, years: list[int], require_all: bool = False) -> DataFrame:
    """Cells of each class by year, one column a year; require_all drops classes that are absent in a year."""
    out = long_cells.groupBy("lulc").pivot("year", years).agg(F.count("cell_id"))
    out = out.select("lulc", *(F.col(str(y)).alias(f"n_{y}") for y in years))
    return out.na.drop() if require_all else out.na.fill(0)


def crosstab(df: DataFrame, a: str, b: str, by: list[str] | None = None) -> DataFrame:
    """Counts of (a, b) pairs; NULL is a value of its own."""
    return df.groupBy(*(by or []), F.col(a).alias("from_v"), F.col(b).alias("to_v")).agg(F.count("*").alias("n"))


def transition_rates(df: DataFrame, a: str, b: str, by: list[str] | None = None, pairs: DataFrame | None = None) -> DataFrame:
    """Net rates n(i to j) / sum over j. Without pairs persistence goes; with pairs (from_v, to_v) only these and persistence stay."""
    by = by or []
    n = crosstab(df, a, b, by).withColumn("rate", F.col("n") / F.sum("n").over(Window.partitionBy(*by, "from_v")))
    if pairs is None:
        return n.filter("from_v <> to_v").drop("n")
    stay = n.filter("from_v = to_v")
    return stay.unionByName(n.filter("from_v <> to_v").join(pairs.select("from_v", "to_v").distinct(), ["from_v", "to_v"], "left_semi")).drop("n")


def persistence(rates: DataFrame, by: list[str]) -> DataFrame:
    """rates with a row (i, i) of what the others leave."""
    stay = rates.groupBy(*by, "from_v").agg((1 - F.sum("rate")).alias("rate")).withColumn("to_v", F.col("from_v"))
    return rates.unionByName(stay)


def viable_table(cells: DataFrame, periods: list[tuple[str, str, str]]) -> DataFrame:
    """Rates of the whole map and of every region by period, one column a period, NULL where a pair is absent.

    periods: (name, from column, to column). Both levels come from one grouping-sets pass for each period.
    """
    parts = []
    for name, a, b in periods:
        pairs = cells.select("region", F.col(a).alias("from_v"), F.col(b).alias("to_v"))
        n = pairs.groupingSets([["region", "from_v", "to_v"], ["from_v", "to_v"]], "region", "from_v", "to_v").agg(F.grouping("region").alias("whole"), F.count("*").alias("n"))
        n = n.withColumn("rate", F.col("n") / F.sum("n").over(Window.partitionBy("whole", "region", "from_v"))).filter("from_v <> to_v")
        where = F.when(F.col("whole") == 1, "whole_map").otherwise(F.concat(F.lit("region_"), F.col("region")))
        rates = n.select(where.alias("region_name"), "from_v", "to_v", "rate")
        parts.append(persistence(rates, ["region_name"]).withColumn("period", F.lit(name)))
    rows = reduce(DataFrame.unionByName, parts)
    names = [p[0] for p in periods]
    out = rows.groupBy("region_name", "from_v", "to_v").pivot("period", names).agg(F.first("rate"))
    return out.select("region_name", "from_v", "to_v", *(F.col(n).alias(f"rate_{n}") for n in names))


def region_class_area(cells: DataFrame, col: str, regions: DataFrame, classes: DataFrame) -> DataFrame:
    """Cells by region label and class name; what has no label goes."""
    n = cells.groupBy("region", F.col(col).alias("value")).agg(F.count("*").alias("initial_amount"))
    named = n.join(regions, "region").join(classes.select("value", "class_name"), "value")
    return named.select(F.col("label").alias("region_name"), F.col("class_name").alias("lulc_name"), "initial_amount")


def class_counts_filled(long_cells: DataFrame, mapping: DataFrame, years: list[int]) -> DataFrame:
    """Counts of target classes for the whole area and each region, zero where a class is absent in a year, one column a year."""
    # cells are counted before they meet the mapping, so that no class's cells go to one task
    few = kept(long_cells.groupBy("region", "year", F.col("lulc").alias("old")).agg(F.count("*").alias("n")))
    rows = few.join(mapping, "old").select(F.col("region").cast("string").alias("area"), "year", F.col("new").alias("lulc"), "n")
    rows = rows.unionByName(rows.withColumn("area", F.lit("all")))
    n = rows.groupBy("area", "lulc", "year").agg(F.sum("n").alias("n"))
    grid = rows.select("area").distinct().crossJoin(mapping.filter("new IS NOT NULL").select(F.col("new").alias("lulc")).distinct())
    wide = n.groupBy("area", "lulc").pivot("year", years).agg(F.first("n"))
    return grid.join(wide, ["area", "lulc"], "left").select("area", "lulc", *(F.coalesce(F.col(str(y)), F.lit(0)).alias(f"n_{y}") for y in years))


def rate_bounds(rates: DataFrame, by: list[str]) -> DataFrame:
    """Least, greatest and mean rate over periods, clipped to [0, 1]; without any rate 0, 1 and 0."""
    clip = lambda c: F.least(F.lit(1.0), F.greatest(F.lit(0.0), c))
    low, high, mean = (clip(F.coalesce(f("rate"), F.lit(d))) for f, d in ((F.min, 0.0), (F.max, 1.0), (F.avg, 0.0)))
    out = rates.groupBy(*by).agg(low.alias("min_rate"), high.alias("max_rate"), mean.alias("mean_rate"))
    return out.withColumn("max_rate", F.greatest("min_rate", "max_rate"))


def extrapolate(rates: DataFrame, keys: list[str], years: DataFrame) -> DataFrame:
    """A least-squares line of rate over year for each key, taken at the years asked for; one year alone gives its mean."""
    fit = rates.groupBy(*keys).agg(F.regr_slope("rate", "year").alias("slope"), F.avg("rate").alias("mean"), F.avg("year").alias("mid"))
    value = F.col("mean") + F.coalesce("slope", F.lit(0.0)) * (F.col("target_year") - F.col("mid"))
    return fit.crossJoin(F.broadcast(years.select(F.col("year").alias("target_year")))).select(*keys, F.col("target_year").alias("year"), F.greatest(F.lit(0.0), value).alias("rate"))


def change_table(long_cells: DataFrame, years: list[int], without: list[int], ends: bool = True) -> DataFrame:
    """Changed cells with percent of all and percent of the from-class, for consecutive years and the ends; classes in without don't count."""
    pairs = [*zip(years, years[1:], strict=False), *([(years[0], years[-1])] if ends and len(years) > 2 else [])]
    w = long_cells.filter(~F.col("lulc").isin(*without)).select("cell_id", "year", "lulc")
    wide = w.groupBy("cell_id").pivot("year", years).agg(F.first("lulc"))
    stacked = wide.select(F.explode(F.array(*(F.struct(F.lit(a).alias("y0"), F.lit(b).alias("y1"), F.col(str(a)).alias("from_v"), F.col(str(b)).alias("to_v")) for a, b in pairs))).alias("p")).select("p.*")
    n = stacked.filter("from_v IS NOT NULL AND to_v IS NOT NULL").groupBy("y0", "y1", "from_v", "to_v").agg(F.count("*").alias("n"))
    own = Window.partitionBy("y0", "y1")
    n = n.withColumns({"perc_total": F.col("n") * 100.0 / F.sum("n").over(own), "perc_class": F.col("n") * 100.0 / F.sum("n").over(own.partitionBy("y0", "y1", "from_v"))})
    return n.filter("from_v <> to_v")


def trajectory_counts(cells: DataFrame, cols: list[str], constant: bool = True) -> DataFrame:
    """Cells for each path of classes over the columns; constant=False leaves out paths that never change."""
    n = cells.groupBy(*cols).agg(F.count("*").alias("n"))
    return n if constant else n.filter(F.size(F.array_distinct(F.array(*cols))) > 1)


def trajectory_long(paths: DataFrame, cols: list[str]) -> DataFrame:
    """path_id (by class order), step and class; the window runs over different paths, at most classes ** years of them."""
    rows = paths.withColumn("path_id", F.row_number().over(Window.orderBy(*cols)))
    return rows.select("path_id", "n", F.posexplode(F.array(*cols)).alias("step", "lulc"))


def zone_relative_change(cells: DataFrame, zone: DataFrame, start: str, end: str) -> DataFrame:
    """By class, a zone's change as percent of the map's: joined by class, with NULL where the map doesn't change."""
    rows = cells.join(zone.select("cell_id", "zone"), "cell_id", "left")
    both = rows.select(F.explode(F.array(F.struct(F.col(start).alias("lulc"), F.lit(-1).alias("w")), F.struct(F.col(end).alias("lulc"), F.lit(1).alias("w")))).alias("x"), "zone").select("x.*", "zone")
    n = both.groupBy("lulc").agg(F.sum("w").alias("map_change"), F.coalesce(F.sum(F.when(F.col("zone").isNotNull(), F.col("w"))), F.lit(0)).alias("zone_change"))
    return n.withColumn("perc", F.try_divide(F.col("zone_change") * 100.0, F.col("map_change")))


def area_share(long_cells: DataFrame, by: list[str]) -> DataFrame:
    """Cells of each class, percent of all cells of its group, and percent change against the year before."""
    n = long_cells.groupBy(*by, "year", "lulc").agg(F.count("*").alias("n"))
    before = F.lag("n").over(Window.partitionBy(*by, "lulc").orderBy("year"))
    return n.withColumns({"perc": F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy(*by, "year")), "perc_change": F.try_divide((F.col("n") - before) * 100.0, before)})


def series_step_change(rows: DataFrame, key: str, year: str, value: str) -> DataFrame:
    """Sum by key and year with the difference to the year before."""
    n = rows.groupBy(key, year).agg(F.sum(value).alias("area"))
    return n.withColumn("step_change", F.col("area") - F.lag("area").over(Window.partitionBy(key).orderBy(year)))


def key_counts(sources: dict[str, DataFrame], key: str) -> DataFrame:
    """Different keys in each source, most first."""
    rows = reduce(DataFrame.unionByName, (df.select(F.lit(name).alias("source"), F.col(key).alias("key")) for name, df in sources.items()))
    return rows.groupBy("source").agg(F.countDistinct("key").alias("n_keys")).orderBy(F.col("n_keys").desc(), "source")


def complete_params(wanted: DataFrame, observed: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """All wanted transitions with observed parameters, 0 where none were observed."""
    return wanted.select(*keys).distinct().join(observed.select(*keys, *values), keys, "left").na.fill(0, values)


def pick_shape(rows: DataFrame, keys: list[str], label: str, constant: str = "Constant change") -> DataFrame:
    """The most frequent label; a tie goes to one that isn't constant, then to the first by alphabet."""
    n = rows.groupBy(*keys, label).agg(F.count("*").alias("n"))
    order = F.struct((-F.col("n")).alias("n"), (F.col(label) == constant).alias("c"), F.col(label).alias("l"))
    return n.groupBy(*keys).agg(F.min_by(label, order).alias(label), F.max("n").alias("n"))


#: Curve labels that fit a growing and a shrinking class: fixed values.
CONSTANT = "Constant change"
SHAPES = {1: (CONSTANT, "Instant growth", "Delayed growth"), -1: (CONSTANT, "Instant decline", "Delayed decline")}


def curve_shape(rows: DataFrame, areas: DataFrame, keys: list[str], label: str) -> DataFrame:
    """keys, label and direction for each row of areas (keys, initial, final): the most frequent label among those
    that fit the class's growth or decline; constant change where none fits or the area stays."""
    way = areas.select(*keys, F.signum(F.col("final") - F.col("initial")).cast("int").alias("direction"))
    fits = F.lit(False)
    for d, labels in SHAPES.items():
        fits = fits | ((F.col("direction") == d) & F.col(label).isin(*labels))
    picked = pick_shape(rows.join(way, keys).filter(fits), keys, label).drop("n")
    return way.join(picked, keys, "left").withColumn(label, F.coalesce(label, F.lit(CONSTANT)))


def share(value: str, by: list[str]) -> Column:
    """A value's share of its group's sum; NULL where that is 0."""
    return F.try_divide(F.col(value), F.sum(value).over(Window.partitionBy(*by)))
