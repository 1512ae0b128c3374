"""What several corpus operators share: the shared folder, tables written to it, and text helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters between words: space, tab, newline, vertical tab, form feed, carriage return.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; in local mode one of our own where that is unset."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="landweave-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """df written once to the shared folder and read back: later steps don't repeat it and outlive lost executors."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def parts_for(df: DataFrame, col: str, each: int) -> int:
    """How many parts of about so many bytes col has; spark.sql.shuffle.partitions at least."""
    total = df.agg(F.sum(F.octet_length(col))).first()[0] or 0
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // each))


class Scratch:
    """Tables and folders of one job in the shared folder, each deleted once what was made of it is written itself.

    Lineages end at written tables, so no task that is run again needs a deleted one.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def path(self, name: str) -> str:
        self.paths[name] = scratch(self.spark, name)
        return self.paths[name]

    def saved(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        context = self.spark.sparkContext
        for name in names:
            path = context._jvm.org.apache.hadoop.fs.Path(self.paths.pop(name))
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(c: Column) -> Column:
    """A-Z to a-z; other letters stay."""
    return F.translate(c, UPPER, LOWER)
