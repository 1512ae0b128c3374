"""Stencils on tiles with halos against whole arrays, on maps of many tiles with gaps."""

import numpy as np
import pandas as pd
import pytest

from landweave.operators import focal, tiles, validate


@pytest.fixture(scope="module")
def world(spark):
    rnd = np.random.default_rng(6)
    r, c = np.divmod(np.arange(70 * 55), 55)
    pdf = pd.DataFrame({"cell_id": np.arange(len(r)), "row": r + 1, "col": c + 1, "v": rnd.integers(1, 5, len(r)), "w": rnd.integers(1, 5, len(r)), "z": rnd.random(len(r)).round(3)})
    pdf["u"] = np.where(rnd.random(len(r)) < 0.6, pdf["v"], rnd.integers(1, 5, len(r)))
    pdf = pdf[rnd.random(len(pdf)) < 0.9]
    return pdf, spark.createDataFrame(pdf)


@pytest.fixture
def small_tiles(monkeypatch):
    monkeypatch.setattr(tiles, "TILE", 16)
    monkeypatch.setattr(tiles, "HALO_FACTOR", 2)


def grid(pdf, col, blank):
    g = np.full((90, 75), blank, float)
    g[pdf["row"] + 8, pdf["col"] + 8] = pdf[col]
    return g


def test_focal_sums(spark, world, small_tiles):
    pdf, df = world
    kernels = focal.kernel(spark, 5, 10.0, 2.0, matrix_id="five").unionByName(focal.kernel(spark, 11, 10.0, 3.0, matrix_id="eleven"))
    w = {m: own[["dr", "dc", "w"]].to_numpy() for m, own in kernels.toPandas().groupby("matrix_id")}
    got = focal.focal_sum(df, "v", [1, 3], kernels).toPandas()
    assert len(got) == 4 * len(pdf)
    g = grid(pdf, "v", 0)
    for (m, k), own in got.groupby(["matrix_id", "class"]):
        want = sum(x * (g[own["row"] + 8 + int(dr), own["col"] + 8 + int(dc)] == k) for dr, dc, x in w[m])
        assert np.allclose(own["value"], want)


def test_neighbours_and_terrain(world, small_tiles):
    pdf, df = world
    g, at = grid(pdf, "v", 0), {i: (r + 8, c + 8) for i, r, c in pdf[["cell_id", "row", "col"]].itertuples(index=False)}
    want = {}
    for i, (r, c) in at.items():
        for dr in (-1, 0, 1):
            for dc in (-1, 0, 1):
                k = g[r + dr, c + dc]
                if (dr or dc) and k:
                    want[i, int(k)] = want.get((i, int(k)), 0) + 1
    assert {(r["cell_id"], r["class"]): r["n"] for r in focal.neighbour_count(df, "v").collect()} == want
    z = grid(pdf, "z", np.nan)
    for r in focal.terrain(df, "z", 30.0).toPandas().itertuples():
        box = z[r.row + 7 : r.row + 10, r.col + 7 : r.col + 10]
        assert np.isnan(r.slope) == np.isnan(box).any()
        if not np.isnan(box).any():
            dx = ((box[:, 2] - box[:, 0]) * [1, 2, 1]).sum() / 240
            dy = ((box[2] - box[0]) * [1, 2, 1]).sum() / 240
            assert abs(r.slope - np.degrees(np.arctan(np.hypot(dx, dy)))) < 1e-9 and abs(r.tpi - (z[r.row + 8, r.col + 8] - (box.sum() - box[1, 1]) / 8)) < 1e-12
            assert abs(r.roughness - (box.max() - box.min())) < 1e-12


def test_similarity_both_ways(world, small_tiles):
    pdf, df = world
    got = validate.similarity_of_differences(df, "w", "v", "u", window=7).first()
    def one(a, b):
        rows, other = pdf[pdf[a] != pdf["w"]], pdf[pdf[b] != pdf["w"]]
        spots = {(r, c): k for r, c, k in other[["row", "col", b]].itertuples(index=False)}
        s = [max([2.0 ** (-np.hypot(i, j) / 2) for i in range(-3, 4) for j in range(-3, 4) if spots.get((r + i, c + j)) == k], default=0.0) for r, c, k in rows[["row", "col", a]].itertuples(index=False)]
        return np.mean(s), len(s)
    (f, n), (g, m) = one("v", "u"), one("u", "v")
    assert np.allclose([got["observed_in_simulated"], got["simulated_in_observed"], got["similarity"]], [f, g, min(f, g)]) and (got["n_observed"], got["n_simulated"]) == (n, m)
    none = validate.similarity_of_differences(df.limit(0), "w", "v", "u").first()
    assert none["similarity"] is None and none["n_observed"] == 0


@pytest.mark.parametrize("halo", [1, 5, 20])
def test_only_border_strips_are_sent_twice(world, halo, monkeypatch):
    """Rows sent are at most twice the map's, with tiles of the usual size."""
    pdf, df = world
    side = tiles.tile_side(halo)
    r, c = (np.arange(1, 2 * side + 1) for _ in range(2))
    copies = lambda x: np.array([len({(v + d) // side for d in (0, -halo, halo)}) for v in x])
    assert np.outer(copies(r), copies(c)).sum() <= 2 * len(r) * len(c)
    sizes = tiles.on_tiles(df, halo, lambda p: [pd.DataFrame({"own": [len(p.own)]})], "own long").toPandas()
    assert sizes["own"].sum() == len(pdf)
