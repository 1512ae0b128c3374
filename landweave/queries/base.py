"""The registry: a query's function gets the tables, its SQL sees the same fixtures."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landweave.fixtures import Tables, with_fixtures

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, so that sums in another order give the same rows."""
    return df.select(*(F.round(f"`{c}`", digits).alias(c) if t in ("double", "float") else F.col(f"`{c}`") for c, t in df.dtypes))


def query(name: str, sql: str | None = None, digits: int | None = 6):
    """Register f(tables) -> DataFrame as name; sql: the oracle's text over tables and fixtures; digits None: f rounds."""

    def register(f: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir)) if digits is None else rounded(f(Tables(spark, sf_dir)), digits)
        if sql:
            ORACLES[name] = with_fixtures(sql)
        return f

    return register
