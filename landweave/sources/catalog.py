"""Catalogues, periods, interventions and control tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Schema of the class file.
CLASS_SCHEMA = T.ArrayType(T.StructType([T.StructField("clean_name", T.StringType()), T.StructField("class_name", T.StringType()), T.StructField("colour", T.StringType()), T.StructField("value", T.IntegerType()), T.StructField("nhood_class", T.BooleanType()), T.StructField("original_classes", T.ArrayType(T.StructType([T.StructField("value", T.IntegerType()), T.StructField("name", T.StringType())])))]))


def read_class_schema(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """(old, new, class_name): a row for each source class of a class file (one object a line, or with multi_line one array), and 0 to NULL."""
    rows = spark.read.schema(CLASS_SCHEMA.elementType).option("multiLine", multi_line).json(path)
    out = rows.select(F.explode("original_classes").alias("o"), F.col("value").alias("new"), "class_name").select(F.col("o.value").alias("old"), "new", "class_name")
    return out.unionByName(spark.createDataFrame([(0, None, None)], "old int, new int, class_name string"))


def periods(years: DataFrame) -> DataFrame:
    """Consecutive years; there is a row for each mapped year, so the window is small."""
    out = years.select(F.col("year").alias("year_from"), F.lead("year").over(Window.orderBy("year")).alias("year_to"))
    return out.filter("year_to IS NOT NULL").withColumn("period", F.concat_ws("_", "year_from", "year_to"))


def pre_period_years(years: DataFrame, k: int) -> DataFrame:
    return years.select("year", F.explode(F.sequence(F.col("year") - k, F.col("year") - 1)).alias("before")).distinct()


def timesteps(ctrl: DataFrame) -> DataFrame:
    """(run, from, to) steps of each run from start, end and step length."""
    s = F.sequence("scenario_start", "scenario_end", "step_length")
    rows = ctrl.select("run", F.explode(F.zip_with(s, F.slice(s, 2, 100000), lambda a, b: F.struct(a.alias("step_from"), b.alias("step_to")))).alias("p")).select("run", "p.*")
    return rows.filter("step_to IS NOT NULL")


def read_interventions(df: DataFrame) -> DataFrame:
    """Comma lists of years, target classes and from-classes (where there is such a column) as arrays, blanks gone."""
    items = lambda c: F.split(F.regexp_replace(c, " ", ""), ",")
    lists = {c: items(c) for c in ("target_classes", "from_lulc_filter") if c in df.columns}
    return df.withColumns({"time_step": F.transform(items("time_step"), lambda x: x.try_cast("int")), **lists})


def ingest_year_table(df: DataFrame, keys: list[str], years: list[int]) -> DataFrame:
    """A survey table wide by year as (keys, year, value).

    A leading X goes from names, names are trimmed; missing keys or years are an error; columns without any
    value go (found in one pass); keys are lower-cased and trimmed; blanks and what is no number are NULL.
    """
    df = df.select(*(F.col(f"`{c}`").alias(c.strip().removeprefix("X")) for c in df.columns))
    if missing := [c for c in (*keys, *map(str, years)) if c not in df.columns]:
        raise ValueError(f"columns are missing: {missing}")
    filled = df.agg(*(F.count(F.nullif(F.trim(F.col(str(y)).cast("string")), F.lit(""))).alias(str(y)) for y in years)).first().asDict()
    wide = df.select(*(F.lower(F.trim(k)).alias(k.lower()) for k in keys), *(F.trim(F.col(str(y)).cast("string")).try_cast("double").alias(str(y)) for y in years if filled[str(y)]))
    return wide.unpivot([k.lower() for k in keys], [str(y) for y in years if filled[str(y)]], "year", "value").withColumn("year", F.col("year").cast("int"))


def dataset_metadata(catalog: DataFrame) -> DataFrame:
    """A row for each type and period: variables, how many, and how the table is partitioned."""
    out = catalog.groupBy("type", "period").agg(F.countDistinct("name").alias("n_variables"), F.concat_ws(",", F.sort_array(F.collect_set("name"))).alias("variables"))
    return out.withColumn("partitioning", F.when(F.col("type") == "static", "region").otherwise("scenario,region"))


def pending(todo: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Wanted outputs that aren't there; NULL keys match NULL."""
    on = [todo[k].eqNullSafe(done[k]) for k in keys]
    return todo.join(done, on, "left_anti")


def upsert_catalog(old: DataFrame, new: DataFrame, key: str, version: str) -> DataFrame:
    """The last version of each key."""
    rows = old.unionByName(new, allowMissingColumns=True)
    return rows.withColumn("__n", F.row_number().over(Window.partitionBy(key).orderBy(F.col(version).desc()))).filter("__n = 1").drop("__n")


def mark_done(ctrl: DataFrame, run: int, ok: bool) -> DataFrame:
    return ctrl.withColumn("completed", F.when(F.col("run") == run, "Y" if ok else "ERROR").otherwise(F.col("completed")))


def remaining(ctrl: DataFrame) -> DataFrame:
    return ctrl.filter("completed = 'N'")


def static_layers(catalog: DataFrame) -> DataFrame:
    """Static layers by base name or key; of soil only the 100-200 cm layer; no path, no layer. A name twice is an error."""
    own = catalog.filter((F.col("static_or_dynamic") == "static") & F.col("path").isNotNull() & ((F.coalesce("grouping", F.lit("")) != "soil") | F.contains("key", F.lit("100_200"))))
    out = own.select(F.coalesce("base_name", "key").alias("name"), "path")
    if twice := [r[0] for r in out.groupBy("name").count().filter("count > 1").limit(20).collect()]:
        raise ValueError(f"names occur twice: {twice}")
    return out


def dynamic_layers(catalog: DataFrame) -> DataFrame:
    return catalog.filter("static_or_dynamic = 'dynamic'").select("period", F.coalesce("scenario_variant", F.lit("baseline")).alias("scenario"), F.coalesce("base_name", "key").alias("name"), "path")


def categorize(catalog: DataFrame, classes: DataFrame) -> DataFrame:
    """(key, category): soil by prefix, neighbourhood by the class it names, else the catalogue's own."""
    c = F.broadcast(classes.select("class_name"))
    hit = catalog.join(c, F.contains("key", F.col("class_name")) & (F.col("pred_category") == "neighbourhood"), "left")
    prefix = F.regexp_extract("key", "^[^_]+", 0)
    return hit.select("key", F.when(F.col("class_name").isNotNull(), F.concat(F.lit("nhood_"), "class_name")).when(F.col("grouping") == "soil", prefix).otherwise(F.col("pred_category")).alias("category"))


def write_rates(df: DataFrame, allowed: DataFrame | None, path: str | None) -> DataFrame:
    """(scenario, region_name, year, From, To, Rate), one CSV folder for each of the first three; allowed: transitions by period (year_from, year_to]."""
    if allowed is not None:
        a = allowed
        df = df.join(a, (df["from_v"] == a["a_from"]) & (df["to_v"] == a["a_to"]) & (df["year"] > a["year_from"]) & (df["year"] <= a["year_to"]), "left_semi")
    out = df.select("scenario", "region_name", "year", F.col("from_v").alias("From"), F.col("to_v").alias("To"), F.col("rate").alias("Rate"))
    if path:
        out.repartition("scenario", "region_name", "year").write.mode("overwrite").partitionBy("scenario", "region_name", "year").option("header", True).csv(path)
    return out
