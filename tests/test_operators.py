"""Hand-made grids and properties."""

import math
import random

import pytest
from pyspark.sql import functions as F

from landweave.operators import distance, focal, ml, patches, rates, scenario


def grid(spark, lines):
    """Cells from text lines: digits are classes, dots are absent; five columns."""
    rows = [(r * len(lines[0]) + c + 1, r + 1, c + 1, int(x)) for r, line in enumerate(lines) for c, x in enumerate(line) if x != "."]
    return spark.createDataFrame(rows, "cell_id long, row int, col int, v int")


def patch_sets(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["patch"], set()).add(r["cell_id"])
    return sorted(out.values(), key=min)


def test_diagonal_cells_are_one_patch_by_eight_and_two_by_four(spark):
    df = grid(spark, ["1....", ".1...", ".....", ".....", "....."])
    assert len(patch_sets(patches.patches(df, "v", 8))) == 1
    assert len(patch_sets(patches.patches(df, "v", 4))) == 2


def test_snake_across_tiles(spark):
    df = grid(spark, ["11111", "....1", "11111", "1....", "11111"])
    assert patch_sets(patches.patches(df, "v", 4, tile=2)) == [set(df.toPandas()["cell_id"])]


def test_patches_match_flood_fill(spark):
    rnd = random.Random(3)
    lines = ["".join(rnd.choice("112.") for _ in range(23)) for _ in range(19)]
    df = grid(spark, lines)
    cells = {(r, c): x for r, line in enumerate(lines) for c, x in enumerate(line) if x != "."}
    seen, want = set(), []
    for start in sorted(cells):
        if start in seen:
            continue
        todo, own = [start], set()
        while todo:
            at = todo.pop()
            if at in own:
                continue
            own.add(at)
            todo += [n for dr in (-1, 0, 1) for dc in (-1, 0, 1) if (n := (at[0] + dr, at[1] + dc)) in cells and cells[n] == cells[at]]
        seen |= own
        want.append({r * 23 + c + 1 for r, c in own})
    assert patch_sets(patches.patches(df, "v", 8, tile=5)) == sorted(want, key=min)


def test_distance_from_a_corner(spark):
    df = grid(spark, ["11111"] * 5)
    got = {r["cell_id"]: r["distance"] for r in distance.distance_to(df, df.filter("cell_id = 1")).collect()}
    assert all(abs(got[r * 5 + c + 1] - math.hypot(r, c)) < 1e-12 for r in range(5) for c in range(5))


def test_distance_matches_brute_force(spark):
    rnd = random.Random(5)
    df = grid(spark, ["".join(rnd.choice("12.") for _ in range(17)) for _ in range(13)])
    feats = [(r["row"], r["col"]) for r in df.filter("v = 2 AND cell_id % 5 = 0").collect()]
    for r in distance.distance_to(df, df.filter("v = 2 AND cell_id % 5 = 0")).join(df, "cell_id").collect():
        assert abs(r["distance"] - min(math.hypot(r["row"] - a, r["col"] - b) for a, b in feats)) < 1e-9


def test_plane_has_one_slope_and_no_position_index(spark):
    df = grid(spark, ["11111"] * 5).withColumn("z", 2.0 * F.col("col"))
    got = focal.terrain(df, "z", 1.0).filter("slope IS NOT NULL").collect()
    assert len(got) == 9
    assert all(abs(r["slope"] - math.degrees(math.atan(2))) < 1e-9 and abs(r["aspect"] - 270) < 1e-9 and abs(r["tpi"]) < 1e-12 for r in got)


def test_one_patch_has_no_sd_and_one_cell_no_index(spark):
    one = patches.class_stats(patches.patches(grid(spark, ["1....", ".....", "..22.", ".....", "....."]), "v", 8)).collect()
    by = {r["class"]: r for r in one}
    assert by[1]["sd_patch_area"] is None and by[1]["aggregation_index"] == 0 and by[2]["aggregation_index"] == 100


def test_radius_pairs_are_symmetric(spark):
    pts = spark.createDataFrame([(i, float(i % 7), float(i % 5)) for i in range(60)], "id_coord long, lon double, lat double")
    got = {(r[0], r[1]) for r in focal.neighbours_within(pts, 1.5).collect()}
    assert got == {(b, a) for a, b in got}
    assert got == {(i, j) for i in range(60) for j in range(60) if i != j and math.hypot(i % 7 - j % 7, i % 5 - j % 5) <= 1.5}


def test_rates_with_persistence_sum_to_one_and_projection_keeps_the_area(spark):
    df = spark.createDataFrame([(i, i % 3, (i * i) % 3) for i in range(50)], "cell_id long, a int, b int")
    r = rates.persistence(rates.transition_rates(df, "a", "b"), [])
    assert all(abs(x["s"] - 1) < 1e-12 for x in r.groupBy("from_v").agg(F.sum("rate").alias("s")).collect())
    areas = spark.createDataFrame([("k", 0, 10.0), ("k", 1, 20.0), ("k", 2, 30.0)], "key string, lulc int, area double")
    moves = rates.transition_rates(df, "a", "b").withColumn("key", F.lit("k"))
    out = scenario.project_areas(areas, moves, [0, 1, 2, 3], ["key"]).groupBy("step").agg(F.sum("area").alias("s")).collect()
    assert all(abs(x["s"] - 60) < 1e-9 for x in out)


def test_separable_data_has_auc_one_and_ties_count_half(spark):
    df = spark.createDataFrame([(0, 0.1, 0), (0, 0.2, 0), (1, 0.9, 1)], "response int, p double, predicted int")
    assert ml.classification_metrics(df, []).first()["roc_auc"] == 1.0
    tie = spark.createDataFrame([(0, 0.5, 1), (1, 0.5, 1)], "response int, p double, predicted int")
    assert ml.classification_metrics(tie, []).first()["roc_auc"] == 0.5


def test_batched_logistic_fits_match_mllib(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GeneralizedLinearRegression

    rnd = random.Random(1)
    data = [(x := rnd.choice([0.0, 1.0, 2.0, 3.0]), float(rnd.random() < 1 / (1 + math.exp(1 - 0.8 * x)))) for _ in range(400)]
    df = spark.createDataFrame(data, "x double, y double")
    got = ml.univariate_pvalues(df.select(F.lit("t").alias("task"), F.lit("p").alias("predictor"), "x", "y", F.lit(1.0).alias("w"))).first()
    glm = GeneralizedLinearRegression(family="binomial", labelCol="y").fit(VectorAssembler(inputCols=["x"], outputCol="features").transform(df))
    sd = df.select(F.stddev_pop("x")).first()[0]
    assert abs(got["b"][1] / sd - glm.coefficients[0]) < 1e-6


def test_csv_schema_errors(spark):
    from landweave.sources.catalog import ingest_year_table

    with pytest.raises(ValueError, match="missing"):
        ingest_year_table(spark.createDataFrame([("a", 1)], "k string, X2010 int"), ["k"], [2011])


def test_own_zonal_statistic(spark):
    """A spread over its mean, from sums that come in many parts; a zone without a name and one of nulls only."""
    import numpy as np

    from landweave.operators.quality import zonal_fold

    rnd = np.random.default_rng(2)
    rows = [(int(k) if k < 3 else None, float(v)) for k, v in zip(rnd.integers(0, 4, 3000), rnd.gamma(2, 3, 3000), strict=True)] + [(9, None)]
    df = spark.createDataFrame(rows, "zone int, v double").repartition(5)
    got = {r["zone"]: r["cv"] for r in zonal_fold(df, ["zone"], "v", lambda v: (v.sum(), (v * v).sum(), len(v)), lambda s: np.sqrt(s[1] / s[2] - (s[0] / s[2]) ** 2) / (s[0] / s[2]), "cv").collect()}
    assert set(got) == {0, 1, 2, None}
    for k, cv in got.items():
        own = np.array([v for z, v in rows if z == k and v is not None])
        assert abs(cv - own.std() / own.mean()) < 1e-9
