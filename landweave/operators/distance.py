"""Exact distances to the nearest feature cell, with its label, by two one-dimensional passes (G14-G16, A24 enn).

Down the columns each cell learns the nearest feature above and below it; along the rows a cell takes the least of
(c - c') ** 2 + g(c') ** 2 over the columns c'. The best column never moves left as c moves right, so the rows are solved
by halving: cells in the middle first, then those between two solved cells among the columns between their answers. That
takes width * log(width) steps a row, whatever the distances, in numpy over all rows of a band.

Labels ride along in the low digits of the costs, so ties go to the smaller label. The nearest feature of another
label than a cell's own differs from it in some bit of the label's number: one pass over the features with that bit set and
one over those without, for each bit, and the least of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landweave.operators.ranks import kept

#: Map rows of a band at most, cells of a band (rows times width) at most unless a row has more, and costs looked at at once.
BAND, BAND_CELLS, AT_ONCE = 64, 1 << 22, 1 << 22
NONE = 1 << 61


def least_costs(h: np.ndarray, cand: np.ndarray, row: np.ndarray, col: np.ndarray, unit: int) -> np.ndarray:
    """For each cell (row, col) the least of (col - cand[k]) ** 2 * unit + h[row, k] over k; cand ascending."""
    out = np.empty(len(row), np.int64)
    order = np.lexsort((col, row))
    row, col = row[order], col[order]
    starts = np.flatnonzero(np.r_[True, np.diff(row) != 0]) if len(row) else np.zeros(0, np.int64)
    sizes = np.diff(np.r_[starts, len(row)])
    each = max(1, AT_ONCE // (len(cand) + int(sizes.max(initial=1))))
    for k in range(0, len(starts), each):
        a, b = int(starts[k]), int(starts[k : k + each][-1] + sizes[k : k + each][-1])
        n, at = np.repeat(sizes[k : k + each], sizes[k : k + each]), np.arange(a, b) - np.repeat(starts[k : k + each], sizes[k : k + each])
        r, c, best = row[a:b], col[a:b], np.zeros(b - a, np.int64)
        stride = 1 << int(n.max() - 1).bit_length()
        todo = at == 0
        while stride:
            q = np.flatnonzero(todo)
            if len(q):
                low = np.where(at[q] >= stride, best[np.maximum(q - stride, 0)], 0)
                high = np.where(at[q] + stride < n[q], best[np.minimum(q + stride, b - a - 1)], len(cand) - 1)
                lens = high - low + 1
                ends = np.cumsum(lens)
                pos = np.arange(ends[-1]) - np.repeat(ends - lens - low, lens)
                cost = (cand[pos] - np.repeat(c[q], lens)) ** 2 * unit + h[np.repeat(r[q], lens), pos]
                least = np.minimum.reduceat(cost, ends - lens)
                hit = np.flatnonzero(cost == np.repeat(least, lens))
                seg = np.searchsorted(ends, hit, "right")
                best[q] = pos[hit[np.r_[True, np.diff(seg) > 0]]]
                out[order[a + q]] = least
            stride //= 2
            todo = at % (2 * stride) == stride if stride else todo
    return out


@dataclass
class Columns:
    """What a layer's features look like from each row of a band, column by column: candidates with their rows and labels' numbers."""

    cols: np.ndarray
    seen: list[tuple[np.ndarray, np.ndarray]]  # (distance along the column or -1, label's number) of shape (rows, columns)

    @classmethod
    def of(cls, part: pd.DataFrame, first: int, height: int, number: dict, two: bool) -> Columns:
        cols = np.sort(part["col"].unique())
        at = np.searchsorted(cols, part["col"].to_numpy())
        rows, labels = np.full((height, len(cols)), -1, np.int64), np.full((height, len(cols)), -1, np.int64)
        inside = part["rows"].notna().to_numpy()
        if inside.any():
            lens = [len(x) for x in part["rows"][inside]]
            r, k = np.concatenate(part["rows"][inside].to_list()).astype(np.int64) - first, np.repeat(at[inside], lens)
            n = np.array([number[x] for xs in part["labels"][inside] for x in xs], np.int64)
            order = np.argsort(-n, kind="stable")  # of several labels on a cell the smallest is written last
            rows[r[order], k[order]], labels[r[order], k[order]] = r[order], n[order]
        seen = []
        for side, step in (("above", range(height)), ("below", range(height - 1, -1, -1))):
            r1, l1, r2, l2 = (np.full(len(cols), -1, np.int64) for _ in range(4))
            has1, has2 = np.zeros(len(cols), bool), np.zeros(len(cols), bool)
            for r, n, has, name in ((r1, l1, has1, side), (r2, l2, has2, side + "2")):
                own = part[f"{name}_row"].notna().to_numpy()
                r[at[own]] = part[f"{name}_row"].to_numpy()[own].astype(np.int64) - first
                n[at[own]] = [number[x] for x in part[f"{name}_label"][own]]
                has[at[own]] = True
            g1, g2 = np.full((height, len(cols)), -1, np.int64), np.full((height, len(cols)), -1, np.int64)
            n1, n2 = np.full((height, len(cols)), -1, np.int64), np.full((height, len(cols)), -1, np.int64)
            for i in step:
                here = labels[i] >= 0
                if two:
                    other = here & has1 & (l1 != labels[i])
                    r2, l2, has2 = np.where(other, r1, r2), np.where(other, l1, l2), has2 | other
                r1, l1, has1 = np.where(here, i, r1), np.where(here, labels[i], l1), has1 | here
                g1[i], n1[i] = np.where(has1, np.abs(r1 - i), -1), l1
                g2[i], n2[i] = np.where(has2, np.abs(r2 - i), -1), l2
            seen += [(g1, n1), (g2, n2)] if two else [(g1, n1)]
        return cls(cols, seen)

    def nearest(self, row: np.ndarray, col: np.ndarray, n_labels: int) -> tuple[np.ndarray, np.ndarray]:
        """Squared distance (-1: none) and label's number for cells."""
        span = max(int(np.abs(self.cols).max(initial=0)), int(np.abs(col).max(initial=0))) * 2
        most = max(int(g.max(initial=0)) for g, _ in self.seen)
        if (span * span + most * most) * n_labels >= NONE:
            raise OverflowError("distances times labels don't fit in 64 bits")
        h = np.minimum.reduce([np.where(g >= 0, g * g * n_labels + n, NONE) for g, n in self.seen])
        cost = least_costs(h, self.cols, row, col, n_labels)
        return np.where(cost < NONE, cost // n_labels, -1), cost % n_labels

    def nearest_other(self, row: np.ndarray, col: np.ndarray, own: np.ndarray, n_labels: int) -> np.ndarray:
        """Squared distance (-1: none) to the nearest feature whose label's number isn't own."""
        best = np.full(len(row), NONE, np.int64)
        for bit in range(max(1, (n_labels - 1).bit_length())):
            for value in (0, 1):
                ask = np.flatnonzero(own >> bit & 1 != value)
                use = [np.where((g >= 0) & (n >> bit & 1 == value), g * g, NONE) for g, n in self.seen]
                if len(ask):
                    best[ask] = np.minimum(best[ask], least_costs(np.minimum.reduce(use), self.cols, row[ask], col[ask], 1))
        return np.where(best < NONE, best, -1)


def _solved(cells: DataFrame, features: DataFrame, by: list[str], label: Column, other: Column | None = None) -> DataFrame:
    """(by, cell_id, sq, label): for each cell and layer (keys by) the nearest feature; with other, cells belong to layers
    themselves and only features of another label than other (their own) count, and label is their own.

    Bands of map rows are solved apart. A band needs the feature rows inside it and, for each column, the
    nearest one above and below it (two of different labels, with other): columns hand these on over the
    bands between two features.
    """
    size = cells.agg(F.min("row"), F.max("row"), F.min("col"), F.max("col")).crossJoin(features.agg(F.min("col"), F.max("col"))).first()
    width = max([1, *(size[k + 1] - size[k] + 1 for k in (2, 4) if size[k] is not None)])
    height = max(1, min(BAND, BAND_CELLS // width))
    band = F.floor(F.col("row") / height).cast("long")
    low, high = (size[0] // height, size[1] // height) if size[0] is not None else (0, -1)
    given = {"at_row": F.col("row").cast("long"), "at_col": F.col("col").cast("long"), "at_band": band}
    want = cells.select("cell_id", *([*(F.col(c).alias(f"at_{c}") for c in by), other.alias("own")] if other is not None else []), *(c.alias(n) for n, c in given.items()))
    spot = features.select(*by, F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"), label.alias("label"))
    kind = spot.schema["label"].dataType.simpleString()
    spots = spot.groupBy(*by, "col", band.alias("band")).agg(F.collect_list(F.struct("row", "label")).alias("all"))
    # of each column and band the last feature and the first one, and the last and first of another label than these
    last = lambda xs: F.array_min(F.transform(xs, lambda x: F.struct((-x["row"]).alias("k"), x["label"].alias("label"))))
    spots = spots.withColumns({"end": last("all"), "top": F.array_min("all")})
    spots = spots.withColumn("end", F.when(F.col("end").isNotNull(), F.struct((-F.col("end.k")).alias("row"), F.col("end.label").alias("label"))))
    w = Window.partitionBy(*by, "col").orderBy("band")
    beside = {"prev": F.lag("band").over(w), "next": F.lead("band").over(w)}
    if other is not None:
        end2 = last(F.filter("all", lambda x: x["label"] != F.col("end.label")))
        end2 = F.when(end2.isNotNull(), F.struct((-end2["k"]).alias("row"), end2["label"].alias("label")))
        # the features are read once more than their summaries, over which the windows run
        spots = kept(spots.withColumns({"end2": end2, "top2": F.array_min(F.filter("all", lambda x: x["label"] != F.col("top.label")))}))
        back = Window.partitionBy(*by, "col").orderBy(F.col("band").desc())

        def another(first: str, second: str, over):
            """second; without it the first of the band before, if its label is another one; else what that band has."""
            near = F.lag(first).over(over)
            return F.coalesce(second, F.when(near["label"] != F.col(f"{first}.label"), near)), over.rowsBetween(Window.unboundedPreceding, 0)

        (up, w_up), (down, w_down) = another("end", "end2", w), another("top", "top2", back)
        own = spots.drop("all").withColumns({**beside, "up": up}).withColumn("up", F.last("up", True).over(w_up))
        own = own.withColumn("down", down).withColumn("down", F.last("down", True).over(w_down))
    else:
        blank = F.lit(None).cast(f"struct<row: bigint, label: {kind}>")
        own = spots.withColumns({**beside, "up": blank, "down": blank})
    names = [f"{s}_{x}" for s in ("above", "above2", "below", "below2") for x in ("row", "label")]
    kinds = dict(zip(names, ["bigint", kind] * 4, strict=True))
    none = {n: F.lit(None).cast(k) for n, k in kinds.items()}

    def handed(first, last, side: str, from_: str, more: str) -> DataFrame:
        ends = own.withColumns({"a": F.greatest(first, F.lit(low)), "b": F.least(last, F.lit(high))}).filter("a <= b")
        held = none | {f"{side}_row": F.col(f"{from_}.row"), f"{side}_label": F.col(f"{from_}.label"), f"{side}2_row": F.col(f"{more}.row"), f"{side}2_label": F.col(f"{more}.label")}
        return ends.select(*by, "col", F.explode(F.sequence("a", "b")).alias("band"), *(c.alias(n) for n, c in held.items()), F.lit(None).cast("array<bigint>").alias("rows"), F.lit(None).cast(f"array<{kind}>").alias("labels"))

    inside = spots.filter(F.col("band").between(low, high)).select(*by, "col", "band", *(c.alias(n) for n, c in none.items()), F.col("all.row").alias("rows"), F.col("all.label").alias("labels"))
    down = handed(F.col("band") + 1, F.coalesce("next", F.lit(high)), "above", "end", "up")
    up = handed(F.coalesce("prev", F.lit(low)), F.col("band") - 1, "below", "top", "down")
    schema = ", ".join([*(f"`{k}` {features.schema[k].dataType.simpleString()}" for k in by), f"cell_id long, sq long, label {kind}"])
    names_out, two = [*by, "cell_id", "sq", "label"], other is not None

    def layers(key: int, left: pd.DataFrame, right: pd.DataFrame) -> Iterator[pd.DataFrame]:
        asked = dict(iter(right.groupby([f"at_{c}" for c in by]))) if two and by else {(): right}
        for k, part in left.groupby(by) if by else [((), left)]:
            cells = asked.get(k) if two and by else right
            if cells is None or not len(cells):
                continue
            found = [x for n in names if n.endswith("label") for x in part[n].dropna()] + [x for xs in part["labels"].dropna() for x in xs]
            known = sorted(set(found) | (set(cells["own"]) if two else set()))
            number = {x: i for i, x in enumerate(known)}
            columns = Columns.of(part, key * height, height, number, two)
            row, col = cells["at_row"].to_numpy() - key * height, cells["at_col"].to_numpy()
            if two:
                sq, to = columns.nearest_other(row, col, np.array([number[x] for x in cells["own"]], np.int64), len(known)), cells["own"].to_numpy()
            else:
                sq, n = columns.nearest(row, col, len(known))
                to = np.array(known, object)[n]
            got = pd.DataFrame({**dict(zip(by, k, strict=True)), "cell_id": cells["cell_id"].to_numpy(), "sq": sq, "label": to})
            yield got[got["sq"] >= 0]

    def solve(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = [x for x in layers(key[0], left, right) if len(x)] if len(left) and len(right) else []
        return pd.concat(out)[names_out] if out else pd.DataFrame(columns=names_out)

    return inside.unionByName(down).unionByName(up).groupBy("band").cogroup(want.groupBy("at_band")).applyInPandas(solve, schema)


def distance_to(cells: DataFrame, features: DataFrame, res: float = 1.0, by: list[str] | None = None) -> DataFrame:
    """(by, cell_id, distance) to the nearest feature cell of each layer (keys by), times the cell size; all layers in one
    pass over the bands. Cells of a layer without features don't appear."""
    by = by or []
    return _solved(cells, features, by, F.lit(0)).select(*by, "cell_id", (F.sqrt(F.col("sq").cast("double")) * res).alias("distance"))


def nearest_feature(cells: DataFrame, features: DataFrame, label: str, res: float = 1.0, by: list[str] | None = None) -> DataFrame:
    """(by, cell_id, label, distance): the label of the nearest feature cell of each layer; a tie goes to the smaller label."""
    by = by or []
    found = _solved(cells, features, by, F.col(label))
    return found.select(*by, "cell_id", F.col("label").alias(label), (F.sqrt(F.col("sq").cast("double")) * res).alias("distance"))


def nearest_other(cells: DataFrame, label: str, res: float = 1.0, by: list[str] | None = None) -> DataFrame:
    """(by, cell_id, label, distance) of each cell with its own label to the nearest cell of its layer with another one; cells without don't appear."""
    by = by or []
    found = _solved(cells, cells, by, F.col(label), F.col(label))
    return found.select(*by, "cell_id", F.col("label").alias(label), (F.sqrt(F.col("sq").cast("double")) * res).alias("distance"))


def fill_nearest(gaps: DataFrame, zones: DataFrame, zone: str) -> DataFrame:
    """Gap cells with their nearest zone; a tie goes to the smaller zone. One pass for all zones."""
    return nearest_feature(gaps, zones, zone)


def within_buffer(cells: DataFrame, zone: DataFrame, d: float, res: float = 1.0) -> DataFrame:
    """Cells at most d from the zone."""
    return distance_to(cells, zone, res).filter(F.col("distance") <= d).select("cell_id")
