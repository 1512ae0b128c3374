"""Fuzzy similarity of observed and simulated change."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landweave.operators.grid import change_map
from landweave.operators.tiles import Patch, on_tiles


def similarity_of_differences(cells: DataFrame, initial: str, observed: str, simulated: str, window: int = 11, divisor: float = 2.0) -> DataFrame:
    """Mean over change cells of one map of 2 ** (-d / divisor) to the nearest cell of the other with the same class in the
    window (0 if none), both ways, and the lesser of the two. One pass over tiles with a halo of half a window."""
    half = window // 2
    steps = sorted(((2.0 ** (-np.hypot(i, j) / divisor), i, j) for i in range(-half, half + 1) for j in range(-half, half + 1)), reverse=True)

    def best(p: Patch, own: np.ndarray, grid: np.ndarray) -> tuple[float, int]:
        at = np.flatnonzero(~np.isnan(own))
        found, left = 0.0, at
        for s, i, j in steps:  # nearest first, so a cell's first hit is its best
            hit = grid[p.at[0][left] + i, p.at[1][left] + j] == own[left]
            found += s * int(hit.sum())
            left = left[~hit]
            if not len(left):
                break
        return found, len(at)

    def work(p: Patch) -> list[pd.DataFrame]:
        a, b = (p.grid(p.rows[c].to_numpy(np.float64), np.nan) for c in ("a", "b"))
        f, n = best(p, a[p.at], b)
        g, m = best(p, b[p.at], a)
        return [pd.DataFrame({"f": [f], "n": [n], "g": [g], "m": [m]})]

    change = lambda c: change_map(F.col(initial), F.col(c)).cast("double")
    spots = cells.select(F.col("row").cast("int").alias("row"), F.col("col").cast("int").alias("col"), change(observed).alias("a"), change(simulated).alias("b")).filter("a IS NOT NULL OR b IS NOT NULL")
    sums = on_tiles(spots, half, work, "f double, n long, g double, m long").agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in "fngm"))
    out = sums.select(F.try_divide("f", "n").alias("observed_in_simulated"), F.col("n").alias("n_observed"), F.try_divide("g", "m").alias("simulated_in_observed"), F.col("m").alias("n_simulated"))
    return out.withColumn("similarity", F.least("observed_in_simulated", "simulated_in_observed"))
