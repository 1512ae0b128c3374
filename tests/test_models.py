"""Fits, tuning and scoring of all tasks at once against MLlib, one fit at a time, and against brute force."""

import itertools

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from landweave.operators import ml
from landweave.operators import models as M

COLS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def tasks(spark):
    """Six tasks of different sizes and shapes; one with one class only, one with a constant column, some nulls."""
    rnd, out = np.random.default_rng(8), []
    for k, (region, t) in enumerate(itertools.product([1, 2, 3], ["101-105", "102-105"])):
        n = 150 + 120 * k
        x = rnd.normal(size=(n, 3)) * [1, 20, 0.01] + [0, 5, 100]
        eta = (k - 2) * 0.5 * x[:, 0] + 0.06 * x[:, 1] - 0.5
        y = (rnd.random(n) < 1 / (1 + np.exp(-eta))).astype(int)
        if k == 4:
            x[:, 2] = 7.0
        out.append(pd.DataFrame({"region": region, "task": t, "cell_id": np.arange(n) + 10_000 * k, "response": y if k != 5 else 0, "a": x[:, 0], "b": x[:, 1], "c": x[:, 2], "wt": rnd.integers(1, 4, n).astype(float)}))
    pdf = pd.concat(out, ignore_index=True)
    pdf.loc[::97, "b"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("b", F.nanvl("b", F.lit(None).cast("double")))
    return pdf, df


SETTINGS = [{}, {"penalty": 0.05}, {"penalty": 0.02, "mixture": 1.0}, {"penalty": 0.03, "mixture": 0.5}]


@pytest.mark.parametrize("weight", [None, "wt"])
def test_coefficients_match_mllib(tasks, weight):
    from pyspark.ml.classification import LogisticRegression

    pdf, df = tasks
    got = {(r["region"], r["task"], r["setting"]): r for r in M.fit_glm(df, ["region", "task"], COLS, SETTINGS, weight).collect()}
    assert len(got) == 5 * len(SETTINGS) and all(r["converged"] and r["rounds"] < 30 for r in got.values())
    for region, task in {k[:2] for k in got} if weight is None else [(1, "102-105"), (3, "101-105")]:
        own = ml.assemble(df.filter((F.col("region") == region) & (F.col("task") == task)).na.drop(), COLS).cache()
        for k, s in enumerate(SETTINGS):
            more = {"weightCol": weight} if weight else {}
            fit = LogisticRegression(labelCol="response", regParam=s.get("penalty", 0.0), elasticNetParam=s.get("mixture", 0.0), maxIter=500, tol=1e-12, **more).fit(own)
            sd = own.agg(*(F.stddev_samp(c) for c in COLS)).first()
            r = got[region, task, k]
            # on standardized columns, as the penalty sees them
            assert np.allclose(np.array(r["coefficients"]) * sd, fit.coefficients.toArray() * np.array(sd), atol=1e-4 if weight is None else 5e-3), (region, task, k)


def test_parts_of_a_task_add_up(tasks, monkeypatch):
    _, df = tasks
    whole = {(r["region"], r["task"]): r["coefficients"] for r in M.fit_glm(df, ["region", "task"], COLS, [{"penalty": 0.01}]).collect()}
    monkeypatch.setattr(M, "PART_ROWS", 50)
    parts = {(r["region"], r["task"]): r["coefficients"] for r in M.fit_glm(df, ["region", "task"], COLS, [{"penalty": 0.01}]).collect()}
    assert set(whole) == set(parts) and all(np.allclose(whole[k], parts[k], rtol=1e-6, atol=1e-9) for k in whole)


def test_separable_task_says_so(spark):
    df = spark.createDataFrame([(1, k, int(k > 20), float(k)) for k in range(40)], "region int, cell_id long, response int, a double")
    got = {r["setting"]: r for r in M.fit_glm(df, ["region"], ["a"], [{}, {"penalty": 0.1}]).collect()}
    assert got[1]["converged"] and (not got[0]["converged"] or abs(got[0]["coefficients"][0]) > 5)
    assert M.fit_glm(df.filter("response = 1"), ["region"], ["a"], [{}]).count() == 0


def test_tuning_leaves_folds_out(tasks):
    """Each held-out AUC is that of a fit on the other folds alone; the best setting is refitted."""
    pdf, df = tasks
    keys = ["region", "task"]
    tuned = M.tune_glm(df, keys, COLS, SETTINGS[:3], folds=3, replicates=2)
    got = {(r["region"], r["task"], r["setting"], r["replicate"], r["fold"]): r["roc_auc"] for r in tuned.collect()}
    assert len(got) == 5 * 3 * 2 * 3
    parted, names = M.with_folds(df, keys, 3, 2)
    own = parted.filter("region = 2 AND task = '101-105'").na.drop()
    for r, f, s in [(0, 0, 0), (1, 2, 1), (0, 1, 2)]:
        train, test = own.filter(F.col(names[r]) != f), own.filter(F.col(names[r]) == f).toPandas()
        fit = M.fit_glm(train, keys, COLS, [SETTINGS[s]]).first()
        p = test[COLS].to_numpy() @ np.array(fit["coefficients"])
        one, zero = p[test["response"] == 1], p[test["response"] == 0]
        auc = np.mean((one[:, None] > zero) + 0.5 * (one[:, None] == zero))
        assert abs(got[2, "101-105", s, r, f] - auc) < 1e-9
    best = M.best_glm(df, keys, COLS, SETTINGS[:3], folds=3, replicates=2).collect()
    for b in best:
        mean = [np.mean([v for k, v in got.items() if k[:3] == (b["region"], b["task"], s)]) for s in range(3)]
        assert b["setting"] == int(np.argmax(np.round(mean, 9))) and abs(b["roc_auc"] - max(mean)) < 1e-8


def test_scores_by_a_table(tasks):
    pdf, df = tasks
    table = M.fit_glm(df, ["region", "task"], COLS, [{"penalty": 0.05}])
    cells = df.drop("task", "response", "wt")
    got = M.score_glm(cells, ["region"], table.select("region", "task", "intercept", "coefficients"), COLS).toPandas()
    n = pdf.dropna().groupby("region").size()
    assert len(got) == 2 * n[1] + 2 * n[2] + n[3]
    of = {(r["region"], r["task"]): r for r in table.collect()}
    for r in got.sample(50, random_state=1).itertuples():
        m = of[r.region, r.task]
        assert abs(r.p - 1 / (1 + np.exp(-(m["intercept"] + np.dot([r.a, r.b, r.c], m["coefficients"]))))) < 1e-12


def test_trees_by_a_table_score_as_mllib(spark, tasks, tmp_path):
    _, df = tasks
    df, path = df.na.drop(), f"file://{tmp_path}/trees"
    want = []
    for region, name in ((1, "rf"), (2, "gbt"), (3, "rf")):
        own = df.filter((F.col("region") == region) & (F.col("task") == "101-105"))
        fit = ml.model_spec(name, COLS, **({"trees": 7, "min_n": 3} if name == "rf" else {"trees": 6, "tree_depth": 3})).fit(own)
        fit.write().overwrite().save(f"{path}/{region}.101-105")
        want.append(ml.score(df.filter(F.col("region") == region), fit).select("cell_id", F.col("p").alias("want")).toPandas())
    table = M.tree_table(spark, path, ["region", "task"], "region int, task string")
    got = M.score_trees(df.drop("task").withColumn("region", F.col("region").cast("int")), ["region"], table, COLS).toPandas().merge(pd.concat(want), on="cell_id")
    assert len(got) == df.count() and np.abs(got["p"] - got["want"]).max() < 1e-9 and set(got["family"]) == {"rf", "gbt"}


def test_chosen_models_score_in_one_plan(spark, tasks, tmp_path):
    _, df = tasks
    rows = df.withColumn("region", F.col("region").cast("int"))
    # a step that no line can follow in one task, lines elsewhere
    rows = rows.withColumn("response", F.when((F.col("region") == 2) & (F.col("task") == "101-105"), (F.abs("a") > 0.7).cast("int")).otherwise(F.col("response")))
    path = f"file://{tmp_path}/chosen"
    fitted = M.choose_models(rows.filter("region < 3"), ["region", "task"], COLS, {"glm": [{"penalty": 0.01}, {"penalty": 10.0, "mixture": 1.0}], "rf": [{"trees": 5, "min_n": 5}]}, path, folds=2, replicates=2)
    got = {(r["region"], r["task"]): r for r in fitted.collect()}
    assert len(got) == 4 and got[2, "101-105"]["model"] == "rf" and got[2, "101-105"]["roc_auc"] > 0.9 and any(r["model"] == "glm" for r in got.values())
    cells = rows.drop("task", "response", "wt")
    scored = M.score_models(cells, ["region"], fitted, path, COLS)
    n = cells.filter("region < 3").na.drop().groupBy("region").count().collect()
    assert scored.count() == 2 * sum(r["count"] for r in n) and scored.filter("p < 0 OR p > 1 OR p IS NULL").count() == 0
    hit = scored.filter("region = 2 AND task = '101-105'").join(rows.filter("region = 2 AND task = '101-105'").select("cell_id", "response"), "cell_id")
    assert ml.classification_metrics(hit.withColumn("predicted", (F.col("p") >= 0.5).cast("int")), []).first()["roc_auc"] > 0.95
    assert M.score_models(cells, ["region"], fitted.limit(0), path, COLS).count() == 0
