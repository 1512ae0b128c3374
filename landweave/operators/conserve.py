"""Protected areas: coverage gaps, candidate patches, selection to a budget and phasing."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landweave.operators.distance import distance_to
from landweave.operators.ranks import kept, percentiles, ranked, running


def steps_by_rank(df: DataFrame, by: list[str], order: list[Column], k: int) -> DataFrame:
    """step 1 to k by rank: groups of ceil(n / k) rows, so the last may be smaller."""
    rows = ranked(df, by, order, "__rank")
    return rows.withColumn("step", (F.floor((F.col("__rank") - 1) / F.ceil(F.col("__n") / F.lit(k))) + 1).cast("int")).drop("__rank", "__n")


def polygon_areas(vertices: DataFrame) -> DataFrame:
    """Shoelace area of each polygon from its vertices in order (poly_id, seq, x, y)."""
    w = Window.partitionBy("poly_id").orderBy("seq")
    nxt = lambda c: F.coalesce(F.lead(c).over(w), F.first(c).over(w))
    return vertices.withColumn("cross", F.col("x") * nxt("y") - nxt("x") * F.col("y")).groupBy("poly_id").agg((F.abs(F.sum("cross")) / 2).alias("area"))


def coverage_gap(areas: DataFrame, computed: DataFrame, country_area: float, targets: DataFrame, cell_area: float) -> DataFrame:
    """Protected share (missing areas as computed) and, by target share, the cells still needed."""
    have = areas.join(computed.withColumnRenamed("area", "computed"), "poly_id", "left").agg(F.sum(F.coalesce("area", "computed")).alias("protected"))
    share = F.col("protected") / country_area
    need = F.greatest(F.lit(0.0), F.col("target") - share)
    return targets.crossJoin(F.broadcast(have)).select("scenario", "target", share.alias("share"), F.ceil(need * country_area / cell_area).alias("cells_needed"))


def combine_protected(typed: DataFrame, types: list, extra: DataFrame) -> DataFrame:
    """Cells of listed types and of the extra areas, once each."""
    return typed.filter(F.col("type").isin(*types)).select("cell_id").union(extra.select("cell_id")).distinct()


def candidate_priority(priority: DataFrame, excluded: list[DataFrame]) -> DataFrame:
    """Priority cells outside all excluded cells."""
    for e in excluded:
        priority = priority.join(e.select("cell_id"), "cell_id", "left_anti")
    return priority


def top_bins_for_target(df: DataFrame, value: str, width: float, target: int) -> DataFrame:
    """Histogram bins with a running count from the top, and whether a bin is needed to reach target."""
    low = df.agg(F.min(value).alias("low"))
    n = df.crossJoin(F.broadcast(low)).groupBy(F.floor((F.col(value) - F.col("low")) / width).alias("bin")).agg(F.count("*").alias("n"))
    up = F.sum("n").over(Window.orderBy(F.col("bin").desc()))
    return n.withColumn("n_above", up).withColumn("needed", F.col("n_above") - F.col("n") < target)


def candidate_patches(cells: DataFrame, labels: DataFrame, value: str, least: int = 3) -> DataFrame:
    """Patches (patch) of labelled cells: size and median priority, small ones dropped."""
    rows = kept(labels.join(cells.select("cell_id", F.col(value).cast("double").alias("__value")), "cell_id").select("patch", "__value"))
    sizes = rows.groupBy("patch").agg(F.count("*").alias("n")).filter(F.col("n") >= least)
    return sizes.join(percentiles(rows, ["patch"], "__value", 0.5).withColumnRenamed("q", "priority"), "patch", "left")


#: Orders for choosing patches: fixed values. Connectivity takes patches by their gap to what is protected already.
PREFERENCES = {"priority": ("priority", "n"), "large": ("n", "priority"), "small": ("-n", "priority"), "connectivity": ("-gap", "priority")}


def patch_gaps(labels: DataFrame, existing: DataFrame) -> DataFrame:
    """(patch, gap): cells from each labelled patch to the nearest existing area; NULL without any."""
    near = distance_to(labels, existing)
    return labels.join(near, "cell_id", "left").groupBy("patch").agg(F.min("distance").alias("gap"))


#: So many undecided patches are chosen from in one task, in order; with more a round of sums comes first.
FEW = 200_000


def select_to_budget(patches: DataFrame, target: int, prefer: str = "priority", few: int = FEW) -> DataFrame:
    """(patch, n, priority, rank, chosen) by first fit: patches in order of preference, each chosen if its cells fit what is left of target.

    In rounds: of the undecided patches the longest run that fits is chosen by running sums, the next one is
    out, and so is every later one larger than the room that is left. Each round drops what can no longer fit, so few are soon
    left; those pass one task in order, with one number as its state. Ties go to the smaller patch.
    """
    order = [F.col(c.lstrip("-")).asc_nulls_last() if c[0] == "-" else F.col(c).desc() for c in PREFERENCES[prefer]]
    rows = patches.select("patch", F.col("n").cast("long").alias("n"), F.col("priority").cast("double").alias("priority"), *(["gap"] if prefer == "connectivity" else []))
    rows = kept(ranked(rows, [], [*order, F.col("patch")], "rank").select("patch", "n", "priority", F.col("rank").cast("int").alias("rank")))
    left, room = rows.select("rank", "n").filter(F.col("n") <= target), target
    taken = rows.select("rank").limit(0)
    while left.count() > few:
        sums = kept(running(left, [], [F.col("rank")], {"before": F.col("n")}).withColumn("fits", F.col("before") + F.col("n") <= room))
        end = sums.filter("NOT fits").agg(F.min("rank")).first()[0]
        run = sums.filter("fits") if end is None else sums.filter(F.col("fits") & (F.col("rank") < end))
        taken, room = taken.unionByName(run.select("rank")), room - (run.agg(F.sum("n")).first()[0] or 0)
        if end is None:
            left = rows.select("rank", "n").limit(0)
            break
        left = kept(sums.filter((F.col("rank") > end) & (F.col("n") <= room)).select("rank", "n"))

    def choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        free = room
        for pdf in batches:
            chosen = []
            for n in pdf["n"].tolist():
                chosen.append(n <= free)
                free -= n * chosen[-1]
            yield pdf.loc[chosen, ["rank"]]

    last = left.repartition(1).sortWithinPartitions("rank").mapInPandas(choose, "rank int")
    taken = taken.unionByName(last).withColumn("chosen", F.lit(True))
    return rows.join(taken, "rank", "left").select("patch", "n", "priority", "rank", F.coalesce("chosen", F.lit(False)).alias("chosen"))


def phase_in(chosen: DataFrame, years: list[int], pace: str = "Steady", end: int | None = None) -> DataFrame:
    """(patch, year) cumulative over time steps: Steady by equal groups, Rapid in the first half of the steps, Lagged in the second.

    Patches start at end at the latest and stay for the years after it.
    """
    years = sorted(years)
    until = [y for y in years if end is None or y <= end]
    half = max(1, len(until) // 2)
    own = {"Steady": until, "Rapid": until[:half], "Lagged": until[-half:]}[pace]
    steps = steps_by_rank(chosen, [], [F.col("rank")], len(own))
    start = F.element_at(F.array(*map(F.lit, own)), F.col("step"))
    return steps.withColumn("start", start).select("patch", F.explode(F.filter(F.array(*map(F.lit, years)), lambda y: y >= F.col("start"))).alias("year"))


def protected_cells(phased: DataFrame, labels: DataFrame, existing: DataFrame, years: list[int]) -> DataFrame:
    """(cell_id, year): cells of existing areas in every year, and those of patches from their start on."""
    old = existing.select("cell_id", F.explode(F.array(*map(F.lit, years))).alias("year"))
    return old.unionByName(phased.join(labels.select("patch", "cell_id"), "patch").select("cell_id", "year")).distinct()
