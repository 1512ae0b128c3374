"""What a task holds or does must not grow with one key, class or square: the steps named by the findings of round 3."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from landweave.operators import focal


def test_pairs_of_a_crowded_square_are_many_tasks(spark, monkeypatch):
    """Before, all pairs of a small table came from one task, since only its bytes were looked at."""
    monkeypatch.setattr(focal, "GROUP", 20, raising=False)
    monkeypatch.setattr(focal, "PAIRS", 5_000, raising=False)
    rnd = np.random.default_rng(5)
    xy = np.r_[rnd.uniform(0, 1, (150, 2)), rnd.uniform(-20, 20, (100, 2))]
    pts = spark.createDataFrame(pd.DataFrame({"id_coord": range(len(xy)), "lon": xy[:, 0], "lat": xy[:, 1]}))
    got = focal.neighbours_within(pts, 1.5).withColumn("task", F.spark_partition_id()).toPandas()
    sq = ((xy[:, None] - xy[None]) ** 2).sum(2)
    want = {(a, b) for a, b in zip(*np.nonzero(sq <= 2.25), strict=True) if a != b}
    assert len(got) == len(want) and set(zip(got["id_coord_origin"], got["id_coord_neighbor"], strict=True)) == want
    assert got["task"].nunique() >= 4 and got["task"].value_counts().iloc[0] < 0.6 * len(got)


def test_pairs_of_shared_places_are_small_files(spark, tmp_path):
    """Before, each point of a place brought its own list of neighbours, so files grew as the pairs did (F1 of round 4)."""
    import os

    xy = np.random.default_rng(3).uniform(0, 2, (60, 2)).round(1)[np.arange(1500) % 60]
    pts = spark.createDataFrame(pd.DataFrame({"id_coord": range(len(xy)), "lon": xy[:, 0], "lat": xy[:, 1]}))
    focal.neighbours_within(pts, 1.0).write.parquet(path := str(tmp_path / "pairs"))
    sq = np.square(xy[:, None] - xy[None]).sum(2)
    a, b = np.nonzero(sq <= 1)
    got = spark.read.parquet(path).toPandas().sort_values(["id_coord_origin", "id_coord_neighbor"])
    assert np.array_equal(got[["id_coord_origin", "id_coord_neighbor"]].to_numpy(), np.c_[a, b][a != b]) and np.allclose(got["distance"], np.sqrt(sq[a, b][a != b]))
    assert sum(os.path.getsize(f"{path}/{f}") for f in os.listdir(path) if f.endswith(".parquet")) < 0.6 * len(got)


def test_pairs_of_crowded_places_and_odd_rows(spark, monkeypatch):
    """Places with more points than a group holds, numbers that lie in two places, and rows without a number or a place."""
    monkeypatch.setattr(focal, "GROUP", 7)
    monkeypatch.setattr(focal, "FAR", 2)
    rows = [(i, float(i % 3), 0.5) for i in range(60)] + [(5, 1.0, 1.0), (5, -1.0, -0.5), (None, 1.0, 0.5), (70, None, 0.5), (71, 1.0, float("nan")), (72, float("inf"), 0.5), (73, 9.0, 9.0), (74, -0.0, 0.0), (75, 0.0, -0.0)]
    pts = spark.createDataFrame(rows, "id_coord long, lon double, lat double")
    got = sorted(tuple(r) for r in focal.neighbours_within(pts, 1.0).collect())
    known = [r for r in rows if None not in r and np.isfinite(r[1:]).all()]
    want = sorted((a, b, float(np.sqrt((x - u) ** 2 + (y - v) ** 2))) for a, x, y in known for b, u, v in known if a != b and (x - u) ** 2 + (y - v) ** 2 <= 1)
    assert got == want
    named = focal.neighbours_within(pts.withColumn("id_coord", F.concat(F.lit("p"), "id_coord")), 1.0)
    assert sorted(tuple(r) for r in named.collect()) == sorted((f"p{a}", f"p{b}", s) for a, b, s in want)


def test_nearest_other_runs_its_windows_over_bands(spark, monkeypatch):
    """Before, windows over whole columns held every cell of the rim; now they hold a row a column and band."""
    from landweave.operators import distance as D

    rnd = np.random.default_rng(8)
    pdf = pd.DataFrame({"row": rnd.integers(1, 600, 900), "col": rnd.integers(1, 6, 900), "label": rnd.choice([3, 3, 3, 3, 7, 9], 900)}).drop_duplicates(["row", "col"])
    pdf.loc[pdf["row"] < 400, "label"] = 3
    pdf = pdf.assign(cell_id=range(len(pdf)))
    held = []
    keep = D.kept if hasattr(D, "kept") else None
    monkeypatch.setattr(D, "kept", lambda df: held.append(keep(df)) or held[-1], raising=False)
    got = D.nearest_other(spark.createDataFrame(pdf), "label").toPandas().set_index("cell_id")
    sq = ((pdf[["row", "col"]].to_numpy()[:, None] - pdf[["row", "col"]].to_numpy()[None]) ** 2).sum(2).astype(float)
    sq[pdf["label"].to_numpy()[:, None] == pdf["label"].to_numpy()] = np.inf
    assert len(got) == len(pdf) and np.allclose(got["distance"].loc[pdf["cell_id"]], np.sqrt(sq.min(1)))
    assert (got["label"].loc[pdf["cell_id"]].to_numpy() == pdf["label"].to_numpy()).all()
    assert held[0].count() <= 5 * (600 // D.BAND + 1) < len(pdf)


def test_expanders_are_counted_in_tiles(spark):
    """Before, a row for each cell and class near it was sorted and joined; now tiles give a row a transition."""
    from landweave.operators import patches as P

    rnd = np.random.default_rng(9)
    pdf = pd.DataFrame([(r * 1000 + c, r, c, 1 + c // 200) for r in range(1, 31) for c in range(250, 281)], columns=["cell_id", "row", "col", "region"])
    pdf["region"] = 1 + (pdf["col"] > 262)
    pdf["a"], pdf["b"] = rnd.integers(1, 4, len(pdf)), rnd.integers(1, 6, len(pdf))
    cells = spark.createDataFrame(pdf.astype({"row": "int32", "col": "int32", "region": "int32", "a": "int32", "b": "int32"}))
    out = P.allocation_params(cells, "a", "b")
    got = {(r["region"], r["from_v"], r["to_v"]): r["perc_expander"] for r in out.collect()}
    at = {(r, c): (g, b) for r, c, g, b in pdf[["row", "col", "region", "b"]].itertuples(index=False)}
    hits: dict = {}
    for r, c, g, a, b in pdf[["row", "col", "region", "a", "b"]].itertuples(index=False):
        if a != b:
            near = any(at.get((r + i, c + j)) == (g, b) for i in (-1, 0, 1) for j in (-1, 0, 1) if i or j)
            hits.setdefault((g, a, b), []).append(100.0 * near)
    assert got.keys() == hits.keys() and all(abs(got[k] - np.mean(v)) < 1e-9 for k, v in hits.items())
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert not any("Join" in x and "cell_id" in x for x in plan.splitlines())


def test_classes_are_counted_before_they_are_mapped(spark, monkeypatch):
    """Before, every cell met the mapping, and the cells of a class lay in one task."""
    from landweave.operators import rates as R

    held = []
    keep = getattr(R, "kept", None)
    monkeypatch.setattr(R, "kept", lambda df: held.append(keep(df)) or held[-1], raising=False)
    long = spark.range(8000).select((F.col("id") % 2).cast("int").alias("region"), F.when(F.col("id") % 4 < 2, 2010).otherwise(2014).alias("year"), (F.col("id") % 5).cast("int").alias("lulc"))
    mapping = spark.createDataFrame([(0, 10), (1, 10), (1, 11), (2, 12), (9, 13)], "old int, new int")
    got = {(r["area"], r["lulc"]): (r["n_2010"], r["n_2014"]) for r in R.class_counts_filled(long, mapping, [2010, 2014]).collect()}
    assert held[0].count() == 20
    assert got["all", 10] == (1600, 1600) and got["all", 11] == (800, 800) and got["0", 12] == (400, 400) and got["1", 13] == (0, 0) and len(got) == 12


def test_semi_join_meets_different_pairs_only(spark):
    """Before, the right side was every cell and class, whose rows of a pair lay in one task."""
    from helpers import SF

    from landweave.queries import QUERIES

    plan = QUERIES["j6_semi"](spark, SF)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert any("LeftSemi" in x for x in plan) and any(x.lstrip(" :+-").startswith("Aggregate [from_v") for x in plan)


def test_auc_counts_crowded_probabilities_before_they_move(spark, monkeypatch):
    """Before, predictions were moved three times; now they move once, a crowded probability as a row a batch."""
    from landweave.operators import ml

    rnd = np.random.default_rng(6)
    pdf = pd.DataFrame({"a": rnd.integers(0, 3, 6000), "b": rnd.choice(["x", "y"], 6000), "p": np.r_[np.full(3000, 0.25), rnd.random(2000), rnd.integers(0, 5, 1000) / 4], "response": rnd.integers(0, 2, 6000)})
    pdf = pd.concat([pdf, pd.DataFrame({"a": [7, 7], "b": ["x", "x"], "p": [0.1, 0.2], "response": [1, 1]})])
    held = []
    keep = ml.kept
    monkeypatch.setattr(ml, "kept", lambda df: held.append(keep(df)) or held[-1])
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    try:
        df = spark.createDataFrame(pdf)
        got = {(r["a"], r["b"]): r["roc_auc"] for r in ml.classification_metrics(df.withColumn("predicted", F.lit(1)), ["a", "b"]).collect()}
        whole = ml.classification_metrics(df.withColumn("predicted", F.lit(1)), []).first()["roc_auc"]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)

    def auc(own):
        one, zero = own["p"][own["response"] == 1].to_numpy(), own["p"][own["response"] == 0].to_numpy()
        return ((one[:, None] > zero).mean() + (one[:, None] == zero).mean() / 2) if len(one) and len(zero) else None

    want = {k: auc(own) for k, own in pdf.groupby(["a", "b"])}
    assert got.keys() == want.keys() and got[7, "x"] is None
    assert all(abs(got[k] - v) < 1e-9 for k, v in want.items() if v is not None) and abs(whole - auc(pdf)) < 1e-9
    assert held and held[0].filter("p = 0.25").count() < 400


def test_guided_selection_makes_its_rows_once(spark):
    """Before, each pass of the forest, the moments and the lasso made the joined rows again."""
    from landweave.operators import ml

    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    rnd = np.random.default_rng(4)
    x = rnd.normal(size=(600, 2))
    pdf = pd.DataFrame({"x": x[:, 0], "z": x[:, 1], "response": (x[:, 0] + rnd.normal(size=600) > 0).astype(float)})
    rows = spark.createDataFrame(pdf).mapInArrow(count, "x double, z double, response double")
    assert ml.guided_selection(rows, ["x", "z"], penalty=0.01, trees=5)[0][0] == "x"
    assert made.value == 600


def test_guided_selections_are_each_tasks_own(spark, monkeypatch):
    """Before, tasks were one, and a penalty of 0 kept every column: a lasso of each task drops what doesn't count there (F2 of round 4)."""
    from landweave.operators import models as B

    rnd, out = np.random.default_rng(11), []
    for k, slope in enumerate([(3.0, 0.0), (0.0, -3.0), (2.0, 2.0)]):
        x = rnd.normal(size=(500, 2)) * [1, 20]
        eta = x @ (np.array(slope) / [1, 20]) - 1
        out.append(pd.DataFrame({"region": k, "response": (rnd.random(500) < 1 / (1 + np.exp(-eta))).astype(int), "a": x[:, 0], "b": x[:, 1], "same": 7.0}))
    out.append(pd.DataFrame({"region": 9, "response": 0, "a": rnd.normal(size=50), "b": 1.0, "same": 7.0}))
    pdf = pd.concat(out, ignore_index=True)
    pdf.loc[::83, "a"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("a", F.nanvl("a", F.lit(None).cast("double")))
    monkeypatch.setattr(B, "FOREST_ROWS", 200)
    got = B.guided_selections(df, ["region"], ["a", "b", "same"], balanced=True, penalty=0.05, trees=20).toPandas().set_index(["region", "predictor"])
    assert len(got) == 9 and got["converged"].all()
    assert {k for k, v in got["kept"].items() if v} == {(0, "a"), (1, "b"), (2, "a"), (2, "b")}
    for k, own in pdf.dropna().groupby("region"):
        if k == 9:
            continue
        mine = got.loc[k].loc[["a", "b"]]
        assert abs(got["importance"].loc[k].sum() - 1) < 1e-5 and got["importance"].loc[k, "same"] == 0
        # the lasso's conditions, classes weighing the same: a gradient of the column's penalty where kept, of less where not
        y, z = own["response"].to_numpy(), own[["a", "b"]].to_numpy()
        w = np.where(y == 1, 1 / (y == 1).sum(), 1 / (y == 0).sum()) / 2
        mean = w @ z
        z = (z - mean) / np.sqrt((w @ z**2 - mean**2) * len(y) / (len(y) - 1))
        guide = 0.5 + 0.5 * mine["importance"].to_numpy() / mine["importance"].max()
        b, c = mine["coefficient"].to_numpy(), 0.0
        for _ in range(100):
            mu = 1 / (1 + np.exp(-z @ b - c))
            c += w @ (y - mu) / (w @ (mu * (1 - mu)))
        g = z.T @ (w * (y - mu))
        assert np.allclose(g[b != 0], (np.sign(b) * 0.05 / guide)[b != 0], atol=1e-5) and (np.abs(g) <= 0.05 / guide + 1e-5).all()


def test_guided_selection_query_takes_all_columns_and_tasks(spark):
    """Before, three columns of six went into one forest of ten trees for all tasks together."""
    from helpers import SF

    from landweave.fixtures import Tables
    from landweave.queries import QUERIES

    t = Tables(spark, SF)
    got = {(r["region"], r["task"], r["predictor"]) for r in QUERIES["m7_guided_selection"](spark, SF).collect()}
    rows = t.cells.filter("lulc_2018 <> 105").join(t.predictors.drop("region").na.drop(), "cell_id").groupBy("region", "lulc_2018").agg(F.countDistinct(F.col("lulc_2022") == 105).alias("n"))
    tasks = [(r["region"], f"{r['lulc_2018']}-105") for r in rows.filter("n = 2").collect()]
    assert tasks and got == {(*x, f"x{k}") for x in tasks for k in range(1, 7)}
