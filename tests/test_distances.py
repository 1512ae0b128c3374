"""Distances, nearest labels and nearest other labels against brute force; wide bands in time."""

import time

import numpy as np
import pandas as pd
import pytest

from landweave.operators import distance as D


def test_costs_by_halving():
    rnd = np.random.default_rng(1)
    for _ in range(60):
        n, k, rows = rnd.integers(1, 40), rnd.integers(1, 30), rnd.integers(1, 6)
        cand = np.sort(rnd.choice(200, k, replace=False))
        h = rnd.integers(0, 3000, (rows, k))
        h[rnd.random(h.shape) < 0.3] = D.NONE
        row, col = rnd.integers(0, rows, n), rnd.integers(0, 200, n)
        want = ((cand[None, :] - col[:, None]) ** 2 * 3 + h[row]).min(1)
        assert (D.least_costs(h, cand, row, col, 3) == want).all()


@pytest.mark.parametrize("features", ["one column", "all columns", "few"])
def test_wide_band_in_seconds(features):
    """64 rows of 50,000 columns."""
    rnd = np.random.default_rng(2)
    cols = {"one column": [7], "all columns": range(50_000), "few": rnd.choice(50_000, 300, replace=False)}[features]
    part = pd.DataFrame({"col": list(cols)})
    for side in ("above", "above2", "below", "below2"):
        part[f"{side}_row"], part[f"{side}_label"] = None, None
    part["rows"] = [np.array([int(x)]) for x in rnd.integers(0, 64, len(part))]
    part["labels"] = [np.array([0])] * len(part)
    began = time.time()
    row, col = np.divmod(np.arange(64 * 50_000), 50_000)
    sq, _ = D.Columns.of(part, 0, 64, {0: 0}, False).nearest(row, col, 1)
    assert time.time() - began < 10
    at = rnd.integers(0, len(row), 200)
    r, c = np.array([x[0] for x in part["rows"]]), part["col"].to_numpy()
    assert (sq[at] == ((row[at][:, None] - r) ** 2 + (col[at][:, None] - c) ** 2).min(1)).all()


@pytest.fixture(scope="module")
def spots():
    """Sparse labelled cells over many bands and columns, some cells with two labels."""
    rnd = np.random.default_rng(3)
    pdf = pd.DataFrame({"row": rnd.integers(1, 700, 160), "col": rnd.integers(1, 90, 160), "layer": rnd.integers(1, 4, 160), "label": rnd.integers(0, 6, 160)})
    return pdf.drop_duplicates(["row", "col", "layer", "label"])


@pytest.fixture(scope="module")
def asked():
    rnd = np.random.default_rng(4)
    pdf = pd.DataFrame({"row": rnd.integers(1, 700, 400), "col": rnd.integers(1, 90, 400)}).drop_duplicates()
    return pdf.assign(cell_id=range(len(pdf)))


def squares(a, b):
    return (a["row"].to_numpy()[:, None] - b["row"].to_numpy()) ** 2 + (a["col"].to_numpy()[:, None] - b["col"].to_numpy()) ** 2


@pytest.mark.parametrize("cells_a_band", [D.BAND_CELLS, 400])
def test_nearest_labels_of_layers(spark, spots, asked, cells_a_band, monkeypatch):
    monkeypatch.setattr(D, "BAND_CELLS", cells_a_band)
    got = D.nearest_feature(spark.createDataFrame(asked), spark.createDataFrame(spots), "label", 2.0, ["layer"]).toPandas()
    want = {}
    for layer, own in spots.groupby("layer"):
        sq = squares(asked, own)
        for i, s in zip(asked["cell_id"], sq, strict=True):
            want[layer, i] = min(zip(s.tolist(), own["label"].tolist(), strict=True))
    assert len(got) == len(want)
    for layer, i, label, d in got[["layer", "cell_id", "label", "distance"]].itertuples(index=False):
        assert (round((d / 2) ** 2), label) == want[layer, i]
    plain = D.distance_to(spark.createDataFrame(asked), spark.createDataFrame(spots)).toPandas().set_index("cell_id")["distance"]
    assert np.allclose(plain[asked["cell_id"]], np.sqrt(squares(asked, spots).min(1)))


def test_nearest_other_label(spark, spots):
    own = spots.drop_duplicates(["row", "col", "layer"]).assign(cell_id=lambda x: range(len(x)))
    own = pd.concat([own, pd.DataFrame({"row": [5, 6], "col": [5, 5], "layer": [9, 9], "label": [1, 1], "cell_id": [9000, 9001]})])
    got = D.nearest_other(spark.createDataFrame(own), "label", by=["layer"]).toPandas().set_index("cell_id")["distance"]
    want = {}
    for _, part in own.groupby("layer"):
        sq = squares(part, part).astype(float)
        sq[part["label"].to_numpy()[:, None] == part["label"].to_numpy()] = np.inf
        want |= {i: np.sqrt(s) for i, s in zip(part["cell_id"], sq.min(1), strict=True) if np.isfinite(s)}
    assert set(got.index) == set(want) and all(abs(got[i] - w) < 1e-9 for i, w in want.items())


def test_text_labels_and_nothing_to_find(spark, asked):
    cells = spark.createDataFrame(asked)
    zones = spark.createDataFrame([(10, 10, "b"), (10, 10, "a"), (600, 80, "c")], "row int, col int, zone string")
    got = D.fill_nearest(cells, zones, "zone").toPandas()
    assert len(got) == len(asked) and set(got["zone"]) == {"a", "c"}
    assert D.fill_nearest(cells, zones.limit(0), "zone").count() == 0
    assert D.distance_to(cells.limit(0), zones).count() == 0
