"""Queries over whole tables against brute force on a small fixture."""

import math

import numpy as np
import pandas as pd
import pytest
from helpers import SF, rows_of
from pyspark.sql import functions as F

from landweave.queries import QUERIES

#: Map rows of the fixture: some bands of distances, most of them empty.
HEIGHT = 130


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    """A folder with the tables of SF, whose orders lie in the first and last rows of 130 map rows."""
    import os

    path = str(tmp_path_factory.mktemp("whole"))
    for f in os.listdir(SF):
        if f != "orders.parquet":
            os.symlink(f"{SF}/{f}", f"{path}/{f}")
    old = pd.read_parquet(f"{SF}/orders.parquet").head(900).copy()
    at = np.arange(len(old), dtype=np.int64)
    old["o_orderkey"] = np.where(at < 450, at, HEIGHT * 100 - 900 + at)
    spark.createDataFrame(old).write.parquet(f"{path}/orders.parquet")
    return path


@pytest.fixture(scope="module")
def maps(spark, small):
    from landweave.fixtures import Tables

    t = Tables(spark, small)
    gaps = t.orders.filter("o_custkey % 10 = 0").select((F.col("o_orderkey") + 1).alias("cell_id")).toPandas()
    gaps["row"], gaps["col"] = (gaps["cell_id"] - 1) // 100 + 1, (gaps["cell_id"] - 1) % 100 + 1
    return t.cells.toPandas(), t.mask.toPandas(), gaps


def squares(a, b):
    return (a["row"].to_numpy()[:, None] - b["row"].to_numpy()) ** 2 + (a["col"].to_numpy()[:, None] - b["col"].to_numpy()) ** 2


def same(spark, small, name, want):
    assert rows_of(QUERIES[name](spark, small).toPandas()) == rows_of(want)


def test_distance_and_buffer(spark, small, maps):
    cells = maps[0]
    sq = squares(cells, cells[cells["lulc_2022"] == 106]).min(1)
    same(spark, small, "g14_distance", pd.DataFrame({"cell_id": cells["cell_id"], "distance": np.round(np.sqrt(sq) * 30, 6)}))
    same(spark, small, "g16_within_buffer", cells[sq <= 9][["cell_id"]])


def test_fill_nearest(spark, small, maps):
    cells, _, gaps = maps
    sq, zone = squares(gaps, cells), cells["lulc_2022"].to_numpy()
    best = [min(zip(s.tolist(), zone.tolist(), strict=True)) for s in sq]
    same(spark, small, "g15_fill_nearest", pd.DataFrame({"cell_id": gaps["cell_id"], "zone": [z for _, z in best], "distance": [round(math.sqrt(s), 6) for s, _ in best]}))


def test_extend_trim_and_range(spark, small, maps):
    cells, mask, _ = maps
    assert mask["row"].max() > 100 and cells["cell_id"].max() > 5000
    value = dict(zip(cells["cell_id"], cells["lulc_2022"], strict=True))
    rows = [((r - 1) * 100 + c, r, c) for r in range(mask["row"].min(), mask["row"].max() + 1) for c in range(mask["col"].min(), mask["col"].max() + 1)]
    want = pd.DataFrame(rows, columns=["cell_id", "row", "col"])
    want["lulc_2022"] = [value.get(i) for i in want["cell_id"]]
    same(spark, small, "g3_extend_trim", want)
    same(spark, small, "p9_range_and_list", cells[cells["cell_id"].isin(mask["cell_id"])][["cell_id", "region"]])


def test_bilinear_past_row_40(spark, small, maps):
    cells = maps[0]
    value = {(r, c): v for r, c, v in zip(cells["row"], cells["col"], cells["elevation"], strict=True)}
    rows = []
    for r in range(1, 2 * cells["row"].max() + 1):
        for c in range(1, 201):
            y, x = (r - 0.5) / 2 + 0.5, (c - 0.5) / 2 + 0.5
            corners = [(a, b) for a in (math.floor(y), math.floor(y) + 1) for b in (math.floor(x), math.floor(x) + 1)]
            if all(k in value for k in corners):
                rows.append((r, c, round(sum((1 - abs(y - a)) * (1 - abs(x - b)) * float(value[a, b]) for a, b in corners), 6)))
    want = pd.DataFrame(rows, columns=["row", "col", "value"])
    assert want["row"].max() > 40
    same(spark, small, "g4_resample_bilinear", want)


def test_nearest_patches_at_any_distance(spark):
    from landweave.operators import patches

    spots = {1: [(1, 1), (1, 4), (1, 200), (90, 7), (91, 7)], 2: [(5, 5), (400, 5)], 3: [(9, 9)], 4: [(20, c) for c in range(1, 80)] + [(20, 150), (70, 40)]}
    rows = [(r * 1000 + c, r, c, v) for v, own in spots.items() for r, c in own]
    labelled = patches.patches(spark.createDataFrame(rows, "cell_id long, row int, col int, v int"), "v", 8)
    cells, want = labelled.toPandas(), []
    for v, own in cells.groupby("class"):
        near = []
        for p in own["patch"].unique():
            rest = own[own["patch"] != p]
            if len(rest):
                near.append(math.sqrt(squares(own[own["patch"] == p], rest).min()))
        if near:
            want.append((v, len(near), np.mean(near), np.std(near), np.std(near) / np.mean(near) * 100))
    assert {w[0] for w in want} == {1, 2, 4}
    got = patches.enn_metrics(labelled, 1.0).toPandas()
    assert rows_of(got.round(6)) == rows_of(pd.DataFrame(want, columns=got.columns).round(6))
