"""Mixing sources to target weights by capped water-filling, with DataFrame operations only.

Targets share a total by weight; a source stops at a number of epochs of its own size, and what it can't
take is shared again by weight until none is above its cap. A source's rate (target / size) is then
sampled: every document is taken the whole number of times, and a seeded choice of documents once more.
Documents are ordered by a seeded hash in bins, bins below the rate's remainder are taken, and of the one
bin that straddles it a seeded share.

Defined results: null text has size 0; a null source is a source of its own; sources without words get
target 0; rows of one doc_id share their hash, so they are taken alike; very long texts count whole; an empty
table gives no rows; other columns pass through untouched where documents are asked for, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from landweave.llm.common import WORD, saved, table

BINS = 1024


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def water_fill(sources: DataFrame, total: float, epochs: float) -> DataFrame:
    """sources (source, source_size, weight) with target. Every round is one sum over the sources; the level only rises.

    Every round but the last clamps a source more, so there are at most as many rounds as sources, and one.
    """
    cap = F.col("source_size") * F.lit(float(epochs))
    level = 0.0
    for _ in range(sources.count() + 2):
        full = cap <= F.col("weight") * F.lit(level)
        capped, open_weight = sources.agg(F.sum(F.when(full, cap)), F.sum(F.when(~full, F.col("weight")))).first()
        now = (total - (capped or 0.0)) / open_weight if open_weight else level
        if now <= level:
            return sources.withColumn("target", F.least(cap, F.col("weight") * F.lit(level)))
        level = now
    raise RuntimeError("water level did not settle")


def mix(sized: DataFrame, sources: DataFrame, seed: int = 17) -> DataFrame:
    """sized (doc_id, source, size and any others) with source_size, target and times (how often the mix takes the document).

    sized is read twice.
    sources: source, source_size, target. The window runs over at most BINS sums for each source.
    """
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rates = sources.select(F.col("source").alias("__s"), "source_size", "target", F.floor(rate + 1e-9).cast("int").alias("__whole"), (F.col("target") - F.floor(rate + 1e-9) * F.col("source_size")).alias("__more"))
    rows = sized.withColumn("__bin", F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(BINS)).cast("int"))
    bins = rows.groupBy("source", "__bin").agg(F.sum("size").alias("__mass"), F.count("*").alias("__docs"))
    below = F.sum("__mass").over(Window.partitionBy("source").orderBy("__bin")) - F.col("__mass")
    edge = bins.withColumn("__below", below).join(rates, F.col("source").eqNullSafe(F.col("__s")))
    edge = edge.filter((F.col("__below") < F.col("__more")) & (F.col("__below") + F.col("__mass") >= F.col("__more")))
    share = (F.col("__more") - F.col("__below")) / F.col("__mass")
    edge = edge.select("__s", F.col("__bin").alias("__edge"), F.when(F.col("__docs") == 1, F.round(share)).otherwise(share).alias("__share"))
    # written, so that Spark knows how small it is before it plans the join with the documents
    rates = saved(rates.join(edge.withColumnRenamed("__s", "__e"), F.col("__s").eqNullSafe(F.col("__e")), "left").drop("__e"), "rates")
    coin = F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    extra = (F.col("__bin") < F.col("__edge")) | ((F.col("__bin") == F.col("__edge")) & (coin < F.col("__share")))
    times = F.col("__whole") + F.coalesce(extra, F.lit(False)).cast("int")
    out = rows.join(rates, F.col("source").eqNullSafe(F.col("__s")))
    return out.withColumn("times", times).select(*sized.columns, "source_size", "target", "times")


def source_targets(sized: DataFrame, weights: tuple[float, ...], share: float, epochs: float) -> DataFrame:
    """source, source_size, weight and target; sources by code point, null last, take the weights in turn.

    There is a row for each source, as there is a weight for each: a table that people configure.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    sources = saved(sources.withColumn("weight", F.element_at(F.array(*map(F.lit, map(float, weights))), turn + 1)), "sources")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    return water_fill(sources, share * total, epochs)


def mixed_sizes(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, epochs: float = 2.0, seed: int = 17) -> DataFrame:
    """doc_id, source, size, source_size, target and times of every document."""
    sized = saved(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "sizes")
    return mix(sized, source_targets(sized, weights, share, epochs), seed)


def mixed_documents(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, epochs: float = 2.0, seed: int = 17) -> DataFrame:
    """docs with every row as often as the mix takes it, and the columns they had."""
    sized = saved(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "sizes")
    targets = saved(source_targets(sized, weights, share, epochs), "targets")
    own = docs.select(*(F.col(f"`{c}`").alias(f"__{i}") for i, c in enumerate(docs.columns)), "doc_id", "source", word_count(F.col("text")).alias("size"))
    taken = mix(own, targets, seed).filter("times > 0").withColumn("times", F.explode(F.sequence(F.lit(1), "times")))
    return taken.select(*(F.col(f"__{i}").alias(c) for i, c in enumerate(docs.columns)))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixed_sizes(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"), "source", "times")
