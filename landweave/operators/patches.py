"""Connected patches of classes and what is measured on them."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landweave.operators.distance import nearest_other
from landweave.operators.ranks import kept
from landweave.operators.tiles import Patch, on_tiles

TILE = 256


def _tile_labels(directions: int, tile: int):
    def run(pdf):
        pdf = pdf.sort_values("cell_id")
        r, c, k = pdf["row"].to_numpy(), pdf["col"].to_numpy(), pdf["k"].to_numpy()
        grid = np.full((tile + 2, tile + 2), -1, np.int64)
        at = np.arange(len(pdf))
        rr, cc = (r - 1) % tile + 1, (c - 1) % tile + 1
        grid[rr, cc] = at
        steps = [(0, 1), (1, 0), *([(1, 1), (1, -1)] if directions == 8 else [])]
        pairs = []
        for dr, dc in steps:
            to = grid[rr + dr, cc + dc]
            ok = to >= 0
            ok[ok] = k[at[ok]] == k[to[ok]]
            pairs.append((at[ok], to[ok]))
        a, b = (np.concatenate([p[i] for p in pairs]) for i in (0, 1))
        owner = at.copy()
        while (owner[a] != owner[b]).any():  # owners of neighbours join, then every path goes straight to its end
            low = np.minimum(owner[a], owner[b])
            np.minimum.at(owner, owner[a], low)
            np.minimum.at(owner, owner[b], low)
            while (owner[owner] != owner).any():
                owner = owner[owner]
        return pdf[["cell_id", "row", "col", "k"]].assign(part=pdf["cell_id"].to_numpy()[owner])

    return run


def patches(df: DataFrame, col: str, directions: int = 8, tile: int = TILE, max_rounds: int = 60) -> DataFrame:
    """(cell_id, row, col, class, patch): cells of one class that touch (4 or 8 ways) share patch, their least cell_id.

    Tiles are labelled on their own; then only the links across tile borders are contracted, between tile labels.
    """
    rows = df.select("cell_id", "row", "col", F.col(col).alias("k")).filter("k IS NOT NULL")
    t = lambda c: F.floor((F.col(c) - 1) / tile)
    parts = rows.groupBy(t("row").alias("tr"), t("col").alias("tc")).applyInPandas(_tile_labels(directions, tile), "cell_id long, row int, col int, k int, part long")
    parts = kept(parts)
    edge = parts.filter(((F.col("row") - 1) % tile).isin(0, tile - 1) | ((F.col("col") - 1) % tile).isin(0, tile - 1))
    ways = [(0, 1), (1, 0), *([(1, 1), (1, -1)] if directions == 8 else [])]
    sent = edge.select("k", "part", F.explode(F.array(*(F.struct((F.col("row") + dr).alias("row"), (F.col("col") + dc).alias("col")) for dr, dc in ways))).alias("o")).select("k", "o.row", "o.col", F.col("part").alias("b"))
    links = edge.select("k", "row", "col", F.col("part").alias("a")).join(sent, ["k", "row", "col"]).filter("a <> b").select("a", "b").distinct()
    label = stars(links, max_rounds).select(F.col("node").alias("part"), F.col("root").alias("patch"))
    return parts.join(label, "part", "left").select("cell_id", "row", "col", F.col("k").alias("class"), F.coalesce("patch", "part").alias("patch"))


def stars(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) of the nodes of links (a, b) that aren't their component's least, by alternating contractions.

    Large stars link a node's greater neighbours to its least one, small stars its lesser neighbours and itself; depths
    shrink by a factor each round, so that rounds grow with the logarithm of the longest path. Edges never outnumber the
    links. An error tells if max_rounds were too few.
    """
    state = lambda e: e.agg(F.count("*"), F.coalesce(F.sum(F.pmod(F.xxhash64("hi", "lo"), F.lit(1 << 31))), F.lit(0))).first()[:]
    edges = kept(links.filter("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct())
    before = state(edges)
    for _ in range(max_rounds):
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = kept(both.filter("v > u").join(least, "u").filter("v <> m").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct())
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        own = large.join(least, "hi").select("hi", "lo", "m")
        small = own.filter("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo")).union(least.select("hi", F.col("m").alias("lo")))
        edges = kept(small.distinct())
        now = state(edges)
        if now == before:
            return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
        before = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def like_edges(df: DataFrame, col: str, by: list[str] | None = None) -> DataFrame:
    """(by, class, other, n): sides that cells of class share with cells of other; both directions, so like sides count twice."""
    four = F.array(*(F.struct(F.lit(a).alias("dr"), F.lit(b).alias("dc")) for a, b in ((0, 1), (1, 0), (0, -1), (-1, 0))))
    sent = df.select(*(by or []), F.col(col).alias("other"), "row", "col", F.explode(four).alias("o"))
    sent = sent.select(*(by or []), "other", (F.col("row") + F.col("o.dr")).alias("row"), (F.col("col") + F.col("o.dc")).alias("col"))
    return df.select(*(by or []), F.col(col).alias("class"), "row", "col").join(sent, [*(by or []), "row", "col"]).groupBy(*(by or []), "class", "other").agg(F.count("*").alias("n"))


def max_like_edges(a):
    """Most sides that a class of a cells can share with itself: a square as large as fits, plus the rest."""
    n = F.floor(F.sqrt(a.cast("double")))
    m = a - n * n
    return 2 * n * (n - 1) + F.when(m == 0, 0).when(m <= n, 2 * m - 1).otherwise(2 * m - 2)


def class_stats(labelled: DataFrame, cell_area: float = 1.0, by: list[str] | None = None) -> DataFrame:
    """By class: mean and sample SD of patch areas (SD NULL for one patch) and aggregation index in percent (0 where no side can be shared)."""
    by = by or []
    sizes = labelled.groupBy(*by, "class", "patch").agg(F.count("*").alias("n"))
    stats = sizes.groupBy(*by, "class").agg((F.avg("n") * cell_area).alias("mean_patch_area"), (F.stddev_samp("n") * cell_area).alias("sd_patch_area"), F.count("*").alias("n_patches"), F.sum("n").alias("n_cells"))
    like = like_edges(labelled, "class", by).filter("class = other").select(*by, "class", (F.col("n") / 2).alias("like"))
    ai = F.coalesce(F.try_divide(F.col("like") * 100.0, max_like_edges(F.col("n_cells"))), F.lit(0.0))
    return stats.join(like, [*by, "class"], "left").withColumn("like", F.coalesce("like", F.lit(0.0))).withColumn("aggregation_index", ai)


def allocation_params(cells: DataFrame, a: str, b: str, region: str = "region", directions: int = 8) -> DataFrame:
    """By region and transition: mean and SD of patch size of new cells, isometry (aggregation index / 70), percent expander and patcher.

    Regions are maps of their own. A new cell is an expander if another cell of its class is next to it afterwards.
    """
    keys = cells.select(region, F.col(a).alias("from_v"), F.col(b).alias("to_v")).distinct()
    # one number for each region and transition, and each region and class: tables of the classes' size
    keys = keys.withColumns({"t": F.dense_rank().over(Window.orderBy(region, "from_v", "to_v")), "c": F.dense_rank().over(Window.orderBy(region, "to_v"))})
    own = cells.select("cell_id", "row", "col", region, F.col(a).alias("from_v"), F.col(b).alias("to_v")).join(F.broadcast(keys), [region, "from_v", "to_v"])
    new = own.filter("from_v <> to_v")
    stats = class_stats(patches(new, "t", directions)).withColumnRenamed("class", "t")

    def grows(p: Patch) -> list[pd.DataFrame]:
        g = p.grid(p.rows["c"].to_numpy(), -1, np.int64)
        beside = np.logical_or.reduce([p.shifted(g, dr, dc) == g[p.at] for dr in (-1, 0, 1) for dc in (-1, 0, 1) if dr or dc])
        moved = p.own["t"].notna().to_numpy()
        t, place = np.unique(p.own["t"].to_numpy()[moved], return_inverse=True)
        return [pd.DataFrame({"t": t.astype(np.int64), "n": np.bincount(place, minlength=len(t)), "grown": np.bincount(place[beside[moved]], minlength=len(t))})] if len(t) else []

    # a tile counts its own new cells and expanders, so that no row a cell and class near it is joined
    marked = own.select(F.col("row").cast("int").alias("row"), F.col("col").cast("int").alias("col"), "c", F.when(F.col("from_v") != F.col("to_v"), F.col("t")).alias("t"))
    grown = on_tiles(marked, 1, grows, "t int, n long, grown long").groupBy("t").agg((F.sum("grown") * 100.0 / F.sum("n")).alias("perc_expander"))
    out = stats.join(grown, "t").join(keys.drop("c"), "t")
    return out.select(region, "from_v", "to_v", "mean_patch_area", "sd_patch_area", (F.col("aggregation_index") / 70).alias("isometry"), "perc_expander", (100 - F.col("perc_expander")).alias("perc_patcher"))


#: Square metres of a hectare, and hectares for which patch density counts: fixed values.
HECTARE, PER = 10_000.0, 100.0


def _perimeters(labelled: DataFrame, by: list[str]) -> DataFrame:
    """(by, class, patch, n, perim): cells and outer sides of each patch."""
    own = labelled.select(*by, "class", "patch", "row", "col")
    four = F.array(*(F.struct(F.lit(a).alias("dr"), F.lit(b).alias("dc")) for a, b in ((0, 1), (1, 0), (0, -1), (-1, 0))))
    moved = own.select(*by, "patch", "class", (F.col("row")).alias("r"), F.col("col").alias("c"), F.explode(four).alias("o")).select(*by, "class", (F.col("r") + F.col("o.dr")).alias("row"), (F.col("c") + F.col("o.dc")).alias("col"))
    inner = own.join(moved, [*by, "class", "row", "col"]).groupBy(*by, "class", "patch").agg(F.count("*").alias("inner"))
    sizes = labelled.groupBy(*by, "class", "patch").agg(F.count("*").alias("n"))
    return sizes.join(inner, [*by, "class", "patch"], "left").withColumn("perim", 4 * F.col("n") - F.coalesce("inner", F.lit(0))).drop("inner")


def _map_rim(labelled: DataFrame, by: list[str]) -> DataFrame:
    """(by, rim_cells, rim_sides): cells of the map with a side to its outside, and those sides."""
    four = F.array(*(F.struct(F.lit(a).alias("dr"), F.lit(b).alias("dc")) for a, b in ((0, 1), (1, 0), (0, -1), (-1, 0))))
    sent = labelled.select(*by, "row", "col", F.explode(four).alias("o")).select(*by, (F.col("row") + F.col("o.dr")).alias("row"), (F.col("col") + F.col("o.dc")).alias("col"))
    near = sent.groupBy(*by, "row", "col").agg(F.count("*").alias("near"))
    own = labelled.select(*by, "row", "col").join(near, [*by, "row", "col"], "left").withColumn("open", 4 - F.coalesce("near", F.lit(0)))
    return own.groupBy(*by).agg(F.sum((F.col("open") > 0).cast("long")).alias("rim_cells"), F.sum("open").alias("rim_sides"))


def least_perimeter(a):
    """Least outer sides of a cells."""
    n = F.floor(F.sqrt(a.cast("double")))
    return F.when(a == n * n, 4 * n).when(a <= n * (n + 1), 4 * n + 2).otherwise(4 * n + 4)


def greatest_perimeter(a, total, rim_cells, rim_sides):
    """Most sides that a class of a cells can have on a map of total cells, rim_cells of them with rim_sides to its outside."""
    even = total % 2 == 0
    middle = F.when(even, 0.5 * total + 0.5 * rim_cells).otherwise(0.5 * total + 0.5 * rim_cells + 0.5)
    return F.when(2 * a <= total, 4 * a).when(a <= middle, 3 * total - 2 * a + F.when(even, 0).otherwise(3)).otherwise(rim_sides + 4 * (total - a))


def landscape_metrics(labelled: DataFrame, res: float = 1.0, by: list[str] | None = None) -> DataFrame:
    """Class-level metrics after the FRAGSTATS definitions: ai, clumpy, cohesion, division, iji, lsi, mesh (hectares), nlsi,
    np, pd (patches per 100 hectares), pladj, split; enn by enn_metrics. res: side of a cell in metres."""
    by = by or []
    area = res * res
    edges = like_edges(labelled, "class", by)
    like = edges.groupBy(*by, "class").agg(F.sum(F.when(F.col("class") == F.col("other"), F.col("n")).otherwise(0)).alias("like"), F.sum(F.when(F.col("class") != F.col("other"), F.col("n")).otherwise(0)).alias("unlike"))
    mix = edges.filter("class <> other").join(like.select(*by, "class", "unlike"), [*by, "class"])
    p = F.col("n") / F.col("unlike")
    iji = mix.groupBy(*by, "class").agg((-F.sum(p * F.ln(p))).alias("entropy"))
    per = _perimeters(labelled, by)
    total = labelled.groupBy(*by).agg(F.count("*").alias("total"), F.countDistinct("class").alias("m"))
    rim = _map_rim(labelled, by)
    total = total.join(rim, by) if by else total.crossJoin(F.broadcast(rim))
    base = per.groupBy(*by, "class").agg(F.count("*").alias("np"), F.sum("n").alias("a"), F.sum(F.col("n") * F.col("n")).cast("double").alias("sq"), F.sum("perim").alias("p"), F.sum(F.col("perim") * F.sqrt(F.col("n").cast("double"))).alias("ps"))
    out = base.join(total, by) if by else base.crossJoin(F.broadcast(total))
    out = out.join(like, [*by, "class"], "left").join(iji, [*by, "class"], "left").na.fill(0, ["like", "unlike"])
    a, t = F.col("a"), F.col("total")
    g = F.try_divide(F.col("like") / 2.0, max_like_edges(a))
    share = a / t
    least, most = least_perimeter(a), greatest_perimeter(a, t, F.col("rim_cells"), F.col("rim_sides"))
    # like sides count from both cells; a class as compact as can be has all but its least perimeter
    fold = F.try_divide(F.col("like") * 1.0, 4.0 * a - least)
    clumpy = F.when((fold < share) & (share < 0.5), F.try_divide(fold - share, share)).otherwise(F.try_divide(fold - share, 1 - share))
    return out.select(*by, "class", F.coalesce(g * 100, F.lit(0.0)).alias("ai"), clumpy.alias("clumpy"), _cohesion(t).alias("cohesion"), (1 - F.col("sq") / (t * t.cast("double"))).alias("division"), F.when(F.col("m") > 2, F.col("entropy") / F.ln((F.col("m") - 1).cast("double")) * 100).alias("iji"), (F.col("p") / least).alias("lsi"), (F.col("sq") / t * area / HECTARE).alias("mesh"), F.try_divide((F.col("p") - least) * 1.0, most - least).alias("nlsi"), "np", (F.col("np") / (t * area) * HECTARE * PER).alias("pd"), (F.col("like") * 100.0 / (4.0 * a)).alias("pladj"), (t * t.cast("double") / F.col("sq")).alias("split"))


def _cohesion(total):
    return (1 - F.try_divide(F.col("p"), F.col("ps"))) * F.try_divide(F.lit(100.0), 1 - 1 / F.sqrt(total.cast("double")))


def landscape_level(labelled: DataFrame, res: float = 1.0) -> DataFrame:
    """Whole-map ai, cohesion, contag, division, iji, lsi, mesh (hectares), np, pd (per 100 hectares), pladj and split."""
    per = _perimeters(labelled, [])
    total = per.agg(F.sum("n").alias("t"), F.count("*").alias("np"), F.sum(F.col("n") * F.col("n")).cast("double").alias("sq"), F.countDistinct("class").alias("m"), F.sum("perim").alias("p"), F.sum(F.col("perim") * F.sqrt(F.col("n").cast("double"))).alias("ps"))
    cls = per.groupBy("class").agg(F.sum("n").alias("a"))
    e = like_edges(labelled, "class").join(cls, "class").crossJoin(F.broadcast(total.select("t")))
    own = F.col("class") == F.col("other")
    q = F.col("a") / F.col("t") * F.col("n") / F.sum("n").over(Window.partitionBy("class"))
    ai = F.when(own, F.coalesce(F.try_divide(F.col("n") / 2.0, max_like_edges(F.col("a"))), F.lit(0.0)) * F.col("a") / F.col("t"))
    x = F.when(~own, F.col("n"))
    con = e.select(q.alias("q"), "n", own.alias("like"), ai.alias("ai"), x.alias("x")).agg(F.sum(F.col("q") * F.ln("q")).alias("h"), F.sum(F.when(F.col("like"), F.col("n")).otherwise(0)).alias("like"), F.sum("ai").alias("ai"), F.sum("x").alias("x"), F.sum(F.col("x") * F.ln(F.col("x").cast("double"))).alias("xlnx"))
    t, m = F.col("t"), F.col("m").cast("double")
    # both directions are in x, so a pair's share of all unlike sides is 2 n / x and counts half each time
    iji = F.when((F.col("m") > 2) & (F.col("x") > 0), (F.ln(F.col("x").cast("double")) - F.ln(F.lit(2.0)) - F.col("xlnx") / F.col("x")) / F.ln(0.5 * m * (m - 1)) * 100)
    rim = _map_rim(labelled, [])
    edge = F.coalesce("x", F.lit(0)) / 2 + F.col("rim_sides")
    return total.crossJoin(F.broadcast(con)).crossJoin(F.broadcast(rim)).select((F.col("ai") * 100).alias("ai"), _cohesion(t).alias("cohesion"), F.when(F.col("m") > 1, (1 + F.col("h") / (2 * F.ln(m))) * 100).alias("contag"), (1 - F.col("sq") / (t * t.cast("double"))).alias("division"), iji.alias("iji"), (edge / least_perimeter(t)).alias("lsi"), (F.col("sq") / t * res * res / HECTARE).alias("mesh"), "np", (F.col("np") / (t * res * res) * HECTARE * PER).alias("pd"), (F.col("like") * 100.0 / (4 * t)).alias("pladj"), (t * t.cast("double") / F.col("sq")).alias("split"))


def enn_metrics(labelled: DataFrame, res: float = 1.0, level: str = "class") -> DataFrame:
    """Mean, SD and CV of the distance (times res) between the nearest cells of patches of a class, by class or over all patches.

    One two-label transform finds for each rim cell the nearest cell of another patch, however far it is.
    """

    def outer(p: Patch) -> list[pd.DataFrame]:
        kinds, number = np.unique(p.rows["patch"].to_numpy(), return_inverse=True)
        g = p.grid(number, -1, np.int64)
        own = g[p.at]
        inside = np.logical_and.reduce([p.shifted(g, dr, dc) == own for dr, dc in ((0, 1), (1, 0), (0, -1), (-1, 0))])
        return [p.own[["cell_id", "row", "col", "class", "patch"]][~inside]]

    cells = labelled.select("cell_id", F.col("row").cast("int").alias("row"), F.col("col").cast("int").alias("col"), "class", "patch")
    rim = kept(on_tiles(cells, 1, outer, f"cell_id long, row int, col int, class {cells.schema['class'].dataType.simpleString()}, patch long"))
    near = nearest_other(rim, "patch", res, ["class"])
    near = near.groupBy("class", "patch").agg(F.min("distance").alias("enn"))
    stats = [F.count("*").alias("n"), F.avg("enn").alias("enn_mn"), F.stddev_pop("enn").alias("enn_sd"), (F.stddev_pop("enn") / F.avg("enn") * 100).alias("enn_cv")]
    return near.groupBy("class").agg(*stats) if level == "class" else near.agg(*stats)
