"""Polygons as runs of columns: coverage of large polygons, groups joined by a sweep, edges that run through cells."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from landweave.operators import vector as V


def ring(poly, points):
    return [(poly, k, float(x), float(y)) for k, (x, y) in enumerate(points)]


def test_a_polygon_of_1e8_cells_is_few_rows(spark):
    big = spark.createDataFrame(ring(1, [(0, 0), (10_000, 0), (10_000, 10_000), (0, 10_000)]), "poly_id int, seq int, x double, y double")
    runs = V.runs_of(big)
    assert runs.count() == 10_000 and runs.agg(F.sum(F.col("b") - F.col("a") + 1)).first()[0] == 10**8
    cells = spark.createDataFrame([(k, 1 + k * 7 % 12_000, 1 + k * 13 % 12_000) for k in range(3000)], "cell_id long, row int, col int")
    got = {r["cell_id"] for r in V.cells_of(runs, cells).collect()}
    assert got == {k for k in range(3000) if 1 + k * 7 % 12_000 <= 10_000 and 1 + k * 13 % 12_000 <= 10_000}


def test_groups_of_polygons_against_points(spark):
    rnd = np.random.default_rng(3)
    rows, shapes = [], {}
    for p in range(12):
        cx, cy, n = rnd.uniform(20, 700), rnd.uniform(5, 60), rnd.integers(3, 9)
        turn = np.sort(rnd.uniform(0, 2 * np.pi, n))
        shapes[p] = np.stack([cx + rnd.uniform(20, 200) * np.cos(turn), cy + rnd.uniform(3, 30) * np.sin(turn)], 1)
        rows += ring(p, shapes[p])
    vertices = spark.createDataFrame(rows, "poly_id int, seq int, x double, y double")
    grid = pd.DataFrame([(r * 1000 + c, r, c) for r in range(1, 81) for c in range(1, 801, 3)], columns=["cell_id", "row", "col"])
    cells = spark.createDataFrame(grid)

    def holds(p, x, y):
        odd, pts = np.zeros(len(x), bool), shapes[p]
        for (x1, y1), (x2, y2) in zip(pts, np.roll(pts, -1, 0), strict=True):
            up = (y1 > y) != (y2 > y)
            odd ^= up & (x < x1 + (y - y1) * (x2 - x1) / np.where(y2 == y1, 1, y2 - y1))
        return odd

    inside = {p: set(grid["cell_id"][holds(p, grid["col"].to_numpy() - 0.5, grid["row"].to_numpy() - 0.5)]) for p in shapes}
    got = V.rasterize(vertices, cells).toPandas()
    assert {p: set(x) for p, x in got.groupby("poly_id")["cell_id"]} == {p: x for p, x in inside.items() if x} and not got.duplicated().any()
    more = V.rasterize(vertices, cells, touches=True).toPandas()
    assert not more.duplicated().any() and all(inside[p] <= set(x) for p, x in more.groupby("poly_id")["cell_id"]) and len(more) > len(got)
    groups = spark.createDataFrame([(p, p % 3) for p in shapes], "poly_id int, g int")
    joined = V.dissolve(vertices, cells, groups, "g").toPandas()
    assert not joined.duplicated().any() and {g: set(x) for g, x in joined.groupby("g")["cell_id"]} == {g: set().union(*(inside[p] for p in shapes if p % 3 == g)) for g in range(3)}
