"""Neighbourhood operators: terrain, kernels, focal sums and radius joins."""

from __future__ import annotations

import math
import random
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landweave.operators.ranks import kept
from landweave.operators.tiles import Patch, on_tiles


def terrain(df: DataFrame, value: str, res: float) -> DataFrame:
    """Slope and aspect in degrees (Horn's differences), position index, ruggedness and roughness of 3 x 3 windows; edges NULL."""

    def work(p: Patch) -> list[pd.DataFrame]:
        g = p.grid(p.rows["z"].to_numpy(np.float64), np.nan)
        z = {(dr, dc): p.shifted(g, dr, dc) for dr in (-1, 0, 1) for dc in (-1, 0, 1)}
        dx = ((z[-1, 1] + 2 * z[0, 1] + z[1, 1]) - (z[-1, -1] + 2 * z[0, -1] + z[1, -1])) / (8 * res)
        dy = ((z[1, -1] + 2 * z[1, 0] + z[1, 1]) - (z[-1, -1] + 2 * z[-1, 0] + z[-1, 1])) / (8 * res)
        mid, rim = z[0, 0], [v for k, v in z.items() if k != (0, 0)]
        # degrees clockwise from north; rows run south, so dy is already downhill to the north
        turn = np.degrees(np.arctan2(dy, -dx))
        aspect = np.where((dx == 0) & (dy == 0), np.nan, np.where(turn > 90, 450 - turn, 90 - turn))
        known = ~np.isnan(np.sum(list(z.values()), axis=0))
        out = {"slope": np.degrees(np.arctan(np.hypot(dx, dy))), "aspect": aspect, "tpi": mid - np.mean(rim, axis=0), "tri": np.mean([np.abs(v - mid) for v in rim], axis=0), "roughness": np.max(list(z.values()), axis=0) - np.min(list(z.values()), axis=0)}
        return [pd.DataFrame({"row": p.own["row"], "col": p.own["col"], **{k: np.where(known, v, np.nan) for k, v in out.items()}})]

    cells = df.select(F.col("row").cast("int").alias("row"), F.col("col").cast("int").alias("col"), F.col(value).cast("double").alias("z"))
    return on_tiles(cells, 1, work, "row int, col int, slope double, aspect double, tpi double, tri double, roughness double")


def kernel(spark: SparkSession, size: int, mid: float, drop: float, interp: bool = False, matrix_id: str = "k") -> DataFrame:
    """(matrix_id, dr, dc, w): w = mid / drop ** distance, or mid * 0.1 ** k linearly between whole distances k."""
    if size % 2 == 0:
        raise ValueError("kernels have odd sizes")
    half = size // 2
    grid = spark.range(size * size).select((F.floor(F.col("id") / size) - half).cast("int").alias("dr"), (F.col("id") % size - half).cast("int").alias("dc"))
    return grid.select(F.lit(matrix_id).alias("matrix_id"), "dr", "dc", decay(F.sqrt((F.col("dr") * F.col("dr") + F.col("dc") * F.col("dc")).cast("double")), mid, drop, interp).alias("w"))


def decay(d: Column, mid: float, drop: float, interp: bool) -> Column:
    if not interp:
        return F.pow(F.lit(1.0 / drop), d) * mid
    low, part = F.floor(d), d - F.floor(d)
    return mid * (F.pow(F.lit(0.1), low) * (1 - part) + F.pow(F.lit(0.1), low + 1) * part)


def kernel_family(spark: SparkSession, sizes: list[int], n: int, seed: int | None = 68, drops: tuple[float, ...] = (3, 6, 12, 24, 48), mid: float = 10.0) -> DataFrame:
    """Kernels of several sizes: n seeded draws of mid in [5, 50] and drop in [1, mid] each, or with seed None one for each of drops."""
    draw, out = random.Random(seed), None
    for size in sizes:
        params = [(m, draw.uniform(1, m)) for m in (draw.uniform(5, 50) for _ in range(n))] if seed is not None else [(mid, d) for d in drops]
        for k, (m, d) in enumerate(params, 1):
            one = kernel(spark, size, m, d, matrix_id=f"n{size}_{k}")
            out = one if out is None else out.unionByName(one)
    return out


def decay_profile(spark: SparkSession, mid: float, drop: float, interp: bool = False) -> DataFrame:
    """Weight by radius, 0 to mid by 0.1."""
    steps = spark.range(int(mid * 10) + 1).select((F.col("id") / 10).alias("radius"))
    return steps.withColumn("w", decay(F.col("radius"), mid, drop, interp))


def focal_sum(df: DataFrame, col: str, classes: list[int], kernels: DataFrame) -> DataFrame:
    """(cell_id, row, col, class, matrix_id, value): weighted sum of cells of each class around each cell; outside counts 0.

    Kernels are a table of code-fixed size; their reach is the tiles' halo. All classes and kernels in one pass.
    """
    by_matrix: dict[str, list[tuple[int, int, float]]] = {}
    for k in kernels.collect():
        by_matrix.setdefault(k["matrix_id"], []).append((k["dr"], k["dc"], k["w"]))
    halo = max((max(abs(dr), abs(dc)) for own in by_matrix.values() for dr, dc, _ in own), default=0)

    def work(p: Patch) -> Iterator[pd.DataFrame]:
        values = p.rows["v"].to_numpy(np.float64)
        for c in classes:
            g = p.grid(values == c, 0.0)
            for m, own in by_matrix.items():
                total = np.zeros((p.side, p.side))
                for dr, dc, w in own:
                    total += w * p.moved(g, dr, dc)
                yield pd.DataFrame({"cell_id": p.own["cell_id"], "row": p.own["row"], "col": p.own["col"], "class": c, "matrix_id": m, "value": p.middle(total)})

    cells = df.select("cell_id", F.col("row").cast("int").alias("row"), F.col("col").cast("int").alias("col"), F.col(col).cast("int").alias("v"))
    return on_tiles(cells, halo, work, "cell_id long, row int, col int, class int, matrix_id string, value double")


def neighbour_count(df: DataFrame, col: str) -> DataFrame:
    """(cell_id, class, n): the other cells of the class in the 3 x 3 window of each cell, for classes that occur there."""

    def work(p: Patch) -> list[pd.DataFrame]:
        known = p.rows["v"].notna().to_numpy()
        kinds, number = np.unique(p.rows["v"].to_numpy()[known], return_inverse=True)
        given = np.full(len(p.rows), -1)
        given[known] = number
        g = p.grid(given, -1, np.int64)
        near = np.stack([p.shifted(g, dr, dc) for dr in (-1, 0, 1) for dc in (-1, 0, 1) if dr or dc], axis=1)
        at, _ = np.nonzero(near >= 0)
        met, n = np.unique(at * max(len(kinds), 1) + near[near >= 0], return_counts=True)
        return [pd.DataFrame({"cell_id": p.own["cell_id"].to_numpy()[met // len(kinds)], "class": kinds[met % len(kinds)], "n": n})] if len(met) else []

    cells = df.select("cell_id", F.col("row").cast("int").alias("row"), F.col("col").cast("int").alias("col"), F.col(col).alias("v"))
    return on_tiles(cells, 1, work, f"cell_id long, class {cells.schema['v'].dataType.simpleString()}, n long")


#: Points of a square that one group holds (its neighbours are dealt to groups of FAR times as many), and pairs of points that a task looks at.
GROUP, FAR, PAIRS = 2_000, 16, 20_000_000
#: Distances that numpy works out at once, neighbours in a stretch, and neighbours of a batch.
AT_ONCE, STRETCH, BATCH = 1_000_000, 256, 50_000


def neighbours_within(points: DataFrame, d: float) -> DataFrame:
    """All pairs of points at most d apart, both ways, no point with itself. Points meet in squares of side d.

    The pairs to look at are counted first, since they and not the points are the work: tasks are as many as these pairs
    need, and the points of a crowded square and those around it are dealt to groups that meet apart. A place's points share
    their neighbours, which are found once and written in stretches, each for all points of the place: columns of neighbours
    and distances repeat themselves then, and one of origins is runs, so that files of pairs grow less than the pairs.
    """
    spark, kind = points.sparkSession, points.schema["id_coord"].dataType.simpleString()
    finite = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    at = points.select(F.col("id_coord").alias("id"), F.col("lon").cast("double").alias("x"), F.col("lat").cast("double").alias("y"))
    at = at.filter(F.col("id").isNotNull() & finite("x") & finite("y")).withColumns({"bx": F.floor(F.col("x") / d), "by": F.floor(F.col("y") / d)})
    nine = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)))
    reach = lambda df, *more: df.withColumn("o", F.explode(nine)).select(*more, (F.col("bx") + F.col("o.i")).alias("bx"), (F.col("by") + F.col("o.j")).alias("by"))
    own = at.groupBy("bx", "by", "x", "y").agg(F.count("*").alias("n")).groupBy("bx", "by").agg(F.sum("n").alias("n"), F.max("n").alias("place"))
    met = reach(own, "n", "place").groupBy("bx", "by").agg(F.sum("n").alias("near"), F.max("place").alias("place"))
    parts = lambda c, size: F.ceil(F.col(c) / size)
    squares = kept(own.drop("place").join(met, ["bx", "by"]).select("bx", "by", "near", "n", parts("n", GROUP).alias("groups"), parts("near", FAR * GROUP).alias("others"), parts("place", GROUP).alias("shares")))
    pairs = squares.agg(F.sum(F.col("n").cast("double") * F.col("near"))).first()[0] or 0.0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(pairs / PAIRS))
    groups = squares.select("bx", "by", "groups", "others", "shares")
    # a place stays in one group, unless its points alone are more than one group holds
    dealt = F.xxhash64("x", "y", F.pmod(F.xxhash64("id"), "shares"))
    every = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
    names = ["bx", "by", "g", "h", "far", "x", "y", "id"]
    here = at.join(groups, ["bx", "by"]).withColumns({"g": F.pmod(dealt, "groups"), "far": F.lit(False)}).withColumn("h", every("others"))
    there = reach(at, "id", "x", "y").join(groups, ["bx", "by"]).withColumns({"h": F.pmod(dealt, "others"), "far": F.lit(True)}).withColumn("g", every("groups"))
    # a number of tasks that is asked for stays, while what Spark would choose goes by bytes read
    both = here.select(names).unionByName(there.select(names)).repartition(tasks, *names[:4]).sortWithinPartitions(*names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _with_equal(batches, names[:4]):
            n = pc.sum(pc.invert(rows["far"])).as_py()
            if 0 < n < len(rows):
                yield from _stretches(rows["x"].to_numpy(), rows["y"].to_numpy(), rows["id"].combine_chunks(), n, d)

    found = both.mapInArrow(work, f"origins array<{kind}>, neighbours array<{kind}>, distances array<double>")
    found = found.select(F.explode("origins").alias("id_coord_origin"), "neighbours", "distances").select("id_coord_origin", "distances", F.posexplode("neighbours").alias("k", "id_coord_neighbor"))
    return found.filter(F.col("id_coord_origin") != F.col("id_coord_neighbor")).select("id_coord_origin", "id_coord_neighbor", F.get("distances", F.col("k")).alias("distance"))


def _with_equal(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each key, out of batches in order of whole-numbered keys."""
    held, last = [], None
    for batch in (b for b in batches if b.num_rows):
        k = np.stack([batch.column(c).to_numpy() for c in keys], axis=1)
        cuts = np.r_[0, np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1, len(k)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if held and (k[a] != last).any():
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            held.append(batch.slice(a, b - a))
            last = k[a]
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _spread(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """first[k], first[k] + 1, ... of each k, n[k] numbers."""
    return np.arange(n.sum()) + np.repeat(first - (np.cumsum(n) - n), n)


def _stretches(x: np.ndarray, y: np.ndarray, ids: pa.Array, n: int, d: float) -> Iterator[pa.RecordBatch]:
    """For each place of the first n rows its points, and those of the rest at most d away in stretches; both in order of places."""
    new = np.r_[True, (x[1:] != x[:-1]) | (y[1:] != y[:-1])]
    new[n] = True
    place = np.flatnonzero(new)
    size = np.diff(np.r_[place, len(x)])
    own = np.searchsorted(place, n)
    there, many = place[own:], size[own:]
    lists = lambda ends, values: pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), values)
    step = max(1, AT_ONCE // (len(x) - n))
    for a in range(0, own, step):
        here, points = place[a : min(a + step, own)], size[a : min(a + step, own)]
        sq = np.square(x[here][:, None] - x[there]) + np.square(y[here][:, None] - y[there])
        i, j = np.nonzero(sq <= d * d)
        neighbour, distance = _spread(there[j], many[j]), np.repeat(np.sqrt(sq[i, j]), many[j])
        each = np.bincount(i, many[j], len(here)).astype(int)
        cut = -(-each // STRETCH)
        of = np.repeat(np.arange(len(here)), cut)
        length = np.minimum(STRETCH, each[of] - _spread(np.zeros(len(here), int), cut) * STRETCH)
        ends, first = np.cumsum(length), 0
        while first < len(of):
            last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + BATCH, "right")))
            k, start = of[first:last], ends[first] - length[first]
            origins = lists(np.cumsum(points[k]), ids.take(pa.array(_spread(here[k], points[k]))))
            upto, own_ends = slice(start, ends[last - 1]), ends[first:last] - start
            yield pa.RecordBatch.from_arrays([origins, lists(own_ends, ids.take(pa.array(neighbour[upto]))), lists(own_ends, pa.array(distance[upto]))], ["origins", "neighbours", "distances"])
            first = last
