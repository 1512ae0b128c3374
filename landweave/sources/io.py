"""Reading and writing cell tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_cells(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A cell table with pinned types, partition keys included; filters on these read only their folders."""
    return spark.read.schema(schema).parquet(path)


def _write(df: DataFrame, path: str, keys: list[str], overwrite_all: bool) -> None:
    # one task may hold a whole partition's rows: several by cell keep a large region from one writer
    spread = df.repartition(*keys, F.pmod(F.col("cell_id"), F.lit(16))) if "cell_id" in df.columns else df.repartition(*keys)
    spread.sortWithinPartitions(*keys, *(["cell_id"] if "cell_id" in df.columns else [])).write.mode("overwrite").option("partitionOverwriteMode", "static" if overwrite_all else "dynamic").option("compression", "zstd").partitionBy(*keys).parquet(path)


def write_static(df: DataFrame, path: str) -> None:
    """Static predictors by region, zstd."""
    _write(df, path, ["region"], True)


def write_dynamic(df: DataFrame, path: str) -> None:
    """Dynamic predictors by period, scenario and region in one schema; folders that df has no rows for stay."""
    _write(df, path, ["period", "scenario", "region"], False)


def write_transitions(df: DataFrame, path: str) -> None:
    _write(df, path, ["region"], True)


def decimal_comma(c: Column) -> Column:
    return F.regexp_replace(c, ",", ".").try_cast("double")


def read_csv(spark: SparkSession, path: str, schema: T.StructType, dialect: str = "comma") -> DataFrame:
    """CSV with a header, plain or gzip; dialect semicolon reads decimal commas."""
    if dialect == "comma":
        return spark.read.schema(schema).option("header", True).csv(path)
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    raw = spark.read.schema(text).option("header", True).option("sep", ";").csv(path)
    return raw.select(*(decimal_comma(F.col(f.name)).alias(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema))


def write_csv(df: DataFrame, path: str, gzip: bool = False) -> None:
    df.write.mode("overwrite").option("header", True).option("compression", "gzip" if gzip else "none").csv(path)


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Files of a Parquet table with sizes, and a row `total`."""
    files = spark.read.parquet(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes")).distinct()
    return files.unionByName(files.agg(F.lit("total").alias("file"), F.sum("bytes").alias("bytes")))
