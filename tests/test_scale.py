"""Ranks, percentiles, joins and labels that work by bins or tiles, against plain brute force; models by task."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def values(spark):
    rnd = np.random.default_rng(3)
    pdf = pd.DataFrame({"k": rnd.integers(0, 3, 3000), "cell_id": np.arange(3000), "v": np.round(rnd.random(3000) ** 3, 3)})
    pdf.loc[pdf["k"] == 2, "v"] = 0.25
    return pdf, spark.createDataFrame(pdf)


@pytest.mark.parametrize("descending", [False, True])
def test_ranks_over_ranges(values, descending):
    from landweave.operators.ranks import ranked

    pdf, df = values
    order = F.col("v").desc() if descending else F.col("v")
    got = ranked(df.repartition(5), ["k"], [order, F.col("cell_id")]).toPandas()
    want = pdf.sort_values(["v", "cell_id"], ascending=[not descending, True]).groupby("k").cumcount() + 1
    assert dict(zip(got["cell_id"], got["__rn"], strict=True)) == dict(zip(pdf.loc[want.index, "cell_id"], want, strict=True))
    assert dict(zip(got["k"], got["__n"], strict=True)) == pdf.groupby("k").size().to_dict()


def test_running_sums(values):
    from landweave.operators.ranks import running

    pdf, df = values
    df = df.withColumn("k", F.when(F.col("k") > 0, F.col("k")))
    got = running(df, ["k"], [F.col("cell_id")], {"s": F.col("v"), "c": F.lit(2)}).toPandas().set_index("cell_id").sort_index()
    own = pdf.groupby("k")["v"]
    assert np.allclose(got["s"], own.cumsum() - pdf["v"]) and np.allclose(got["s_all"], own.transform("sum")) and (got["c"] == own.cumcount() * 2).all()
    assert running(df.limit(0), [], [F.col("cell_id")], {"s": F.col("v")}).count() == 0


def test_crowded_values_spread_over_tasks(spark):
    """A million values below 1e-4 and one value repeated a million times: no part of the order holds more than a few shares of them."""
    from landweave.operators import ranks

    df = spark.range(2_000_000).select(F.col("id").alias("cell_id"), F.when(F.col("id") % 2 == 0, F.lit(0.5)).otherwise((F.xxhash64("id") / F.lit(2.0**64) + 0.5) * 1e-4).alias("p"))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 16)
    try:
        ranged = df.repartitionByRange(16, F.col("p"), F.col("cell_id"))
        assert ranged.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] < 2_000_000 / 16 * 2
        got = ranks.ranked(df, [], [F.col("p"), F.col("cell_id")])
        assert got.agg(F.min("__rn"), F.max("__rn"), F.countDistinct("__rn")).first()[:] == (1, 2_000_000, 2_000_000)
        cached = df.cache()
        for share in (0.25, 0.5, 0.75):
            assert abs(ranks.percentiles(cached, [], "p", share).first()["q"] - cached.agg(F.percentile("p", share)).first()[0]) < 1e-15
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


@pytest.mark.parametrize("share", [0.0, 0.5, 0.8, 0.95, 1.0])
def test_percentiles_by_bins(values, share):
    from landweave.operators.ranks import percentiles

    pdf, df = values
    got = percentiles(df, ["k"], "v", share).toPandas().set_index("k")["q"]
    assert np.allclose(got.sort_index(), pdf.groupby("k")["v"].quantile(share))
    one = percentiles(df.filter("cell_id = 7"), [], "v", share).first()["q"]
    assert one == pdf["v"][7] and percentiles(df.filter("k > 9"), ["k"], "v", share).count() == 0


def test_intervals_past_the_broadcast(spark, monkeypatch):
    from landweave.operators import joins

    rnd = np.random.default_rng(5)
    rows = spark.createDataFrame(pd.DataFrame({"i": range(300), "at": rnd.integers(0, 500, 300)}))
    spans = spark.createDataFrame(pd.DataFrame({"low": (a := rnd.integers(0, 480, 60)), "high": a + rnd.integers(1, 40, 60)}))
    few = sorted(map(tuple, joins.interval_join(rows, spans, "at", "low", "high").collect()))
    monkeypatch.setattr(joins, "FEW", 0)
    assert few == sorted(map(tuple, joins.interval_join(rows, spans, "at", "low", "high").collect())) and few
    wanted, known = spark.createDataFrame([(y,) for y in range(1990, 2031)], "w int"), spark.createDataFrame([(1995,), (2001,), (2020,)], "y int")
    got = {r["w"]: r["y"] for r in joins.nearest_value(wanted, known, "w", "y").collect()}
    assert got == {w: min((1995, 2001, 2020), key=lambda y: (abs(y - w), y)) for w in range(1990, 2031)}


@pytest.mark.parametrize("directions", [4, 8])
def test_snake_is_one_patch(spark, directions):
    """A path that turns back and forth inside a tile and over tile borders."""
    from landweave.operators.patches import patches

    path = [(r, c) for r in range(1, 60, 2) for c in range(1, 41)] + [(r, 40 if r % 4 == 2 else 1) for r in range(2, 59, 2)]
    df = spark.createDataFrame([(r * 1000 + c, r, c, 1) for r, c in path] + [(900_000, 900, 3, 1)], "cell_id long, row int, col int, v int")
    got = patches(df, "v", directions, tile=16).groupBy("patch").count().collect()
    assert sorted(map(tuple, got)) == [(1001, len(path)), (900_000, 1)]


def test_long_snake_over_many_tiles(spark):
    """A path of a million cells that turns back and forth over 1,000 x 2,000 cells; too few rounds are an error."""
    from landweave.operators import patches as P

    rows = spark.range(0, 1000, 2).select((F.col("id") + 1).alias("row")).crossJoin(spark.range(1, 2001).select(F.col("id").alias("col")))
    turns = spark.range(1, 999, 2).select((F.col("id") + 1).alias("row"), F.when(F.col("id") % 4 == 1, 2000).otherwise(1).cast("long").alias("col"))
    df = rows.union(turns).select((F.col("row") * 10_000 + F.col("col")).alias("cell_id"), F.col("row").cast("int").alias("row"), F.col("col").cast("int").alias("col"), F.lit(1).alias("v"))
    assert df.count() == 1_000_499
    got = P.patches(df, "v", 4, tile=128).groupBy("patch").count().collect()
    assert [tuple(r) for r in got] == [(10_001, 1_000_499)]
    with pytest.raises(RuntimeError):
        P.stars(spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")), 2)


def test_stars_of_random_graphs(spark):
    from landweave.operators.patches import stars

    rnd = np.random.default_rng(7)
    for n, m in ((200, 120), (50, 200), (300, 280)):
        e = rnd.integers(0, n, (m, 2))
        label = list(range(n))
        for _ in range(n):
            for a, b in e:
                label[a] = label[b] = min(label[a], label[b])
        got = {r["node"]: r["root"] for r in stars(spark.createDataFrame(e.tolist(), "a long, b long")).collect()}
        assert got == {k: v for k, v in enumerate(label) if k != v}


def test_areas_fold_over_steps(spark):
    from landweave.operators.scenario import project_areas

    areas = spark.createDataFrame([(1, 1, 100.0), (1, 2, 50.0), (2, 1, 10.0), (3, 5, 7.0)], "k int, lulc int, area double")
    rates = spark.createDataFrame([(1, 1, 2, 0.1, 2001), (1, 2, 1, 0.5, 2001), (1, 1, 2, 0.2, 2002), (2, 1, 9, 0.3, 2001), (2, 8, 1, 0.3, 2002)], "k int, from_v int, to_v int, rate double, step int")
    got = {(r["k"], r["lulc"], r["step"]): r["area"] for r in project_areas(areas, rates, [2000, 2001, 2002], ["k"]).collect()}
    want = {(1, 1, 2000): 100, (1, 2, 2000): 50, (1, 1, 2001): 115, (1, 2, 2001): 35, (1, 1, 2002): 92, (1, 2, 2002): 58, (2, 1, 2000): 10, (2, 1, 2001): 7, (2, 1, 2002): 7, (3, 5, 2000): 7, (3, 5, 2001): 7, (3, 5, 2002): 7}
    assert set(got) == set(want) and all(abs(got[k] - v) < 1e-9 for k, v in want.items())


@pytest.mark.parametrize("few", [200_000, 3, 0])
def test_first_fit_takes_what_still_fits(spark, few):
    from landweave.operators.conserve import select_to_budget

    df = spark.createDataFrame([(k, n, 1.0 - k / 10) for k, n in enumerate((50, 20, 8, 5, 2))], "patch long, n long, priority double")
    got = [r["n"] for r in select_to_budget(df, 60, few=few).orderBy("rank").collect() if r["chosen"]]
    assert got == [50, 8, 2]
    assert [r["n"] for r in select_to_budget(df, 60, "small", few).orderBy("rank").collect() if r["chosen"]] == [2, 5, 8, 20]
    rnd = np.random.default_rng(4)
    sizes = rnd.integers(1, 90, 400)
    many = spark.createDataFrame([(k, int(n), float(p)) for k, (n, p) in enumerate(zip(sizes, rnd.random(400), strict=True))], "patch long, n long, priority double")
    rows = select_to_budget(many, 2000, few=few).orderBy("rank").collect()
    room = 2000
    for r in rows:
        assert r["chosen"] == (r["n"] <= room)
        room -= r["n"] * r["chosen"]
    assert [r["rank"] for r in rows] == list(range(1, 401)) and [r["priority"] for r in rows] == sorted((r["priority"] for r in rows), reverse=True)


def test_univariate_pvalues_of_both_forms(spark):
    from landweave.operators.ml import univariate_pvalues

    rnd, rows = np.random.default_rng(1), []
    x = rnd.normal(size=400)
    for name, eta in (("line", 1.2 * x), ("curve", 1.5 * x * x - 1), ("none", 0 * x)):
        y = (rnd.random(400) < 1 / (1 + np.exp(-eta))).astype(float)
        rows += [("t", name, float(a), float(b), 1.0) for a, b in zip(x, y, strict=True)]
    five = rnd.integers(0, 4, 400)
    rows += [("t", "few", float(a), float(b), 1.0) for a, b in zip(five, rnd.random(400) < 1 / (1 + np.exp(1 - five)), strict=True)]
    pdf = pd.DataFrame(rows, columns=["task", "predictor", "x", "y", "w"])
    got = univariate_pvalues(spark.createDataFrame(pdf)).toPandas().set_index("predictor")["p_value"]
    for name, own in pdf.groupby("predictor"):
        z = (own["x"] - own["x"].mean()) / own["x"].std(ddof=0)
        a = np.stack([z**0, z, z**2][: 3 if own["x"].nunique() > 5 else 2], 1)
        b = np.zeros(a.shape[1])
        for _ in range(50):
            mu = 1 / (1 + np.exp(-a @ b))
            h = a.T @ (a * (mu * (1 - mu))[:, None])
            b = b + np.linalg.solve(h, a.T @ (own["y"].to_numpy() - mu))
        t = np.abs(b / np.sqrt(np.diag(np.linalg.inv(h))))[1:].min()
        want = 2 / (1 + np.exp(1.5976 * t + 0.07056 * t**3))
        assert abs(got[name] - min(1, want)) < 1e-3
    assert got["few"] < 0.01 < 0.05 < got["none"]


@pytest.fixture(scope="module")
def tasks(spark):
    rnd = np.random.default_rng(2)
    pdf = pd.DataFrame({"cell_id": range(900), "region": [1, 2, 3] * 300, "a": rnd.random(900), "b": rnd.random(900)})
    pdf["response"] = ((pdf["a"] > 0.6) | ((pdf["region"] == 2) & (pdf["b"] > 0.8))).astype(int)
    pdf.loc[pdf["region"] == 3, "response"] = 0
    return spark.createDataFrame(pdf)


@pytest.mark.parametrize("name", ["glm", "rf", "gbt"])
def test_families_tune(tasks, name):
    from landweave.operators import ml as M

    grid = {"glm": {"penalty": [0.0, 10.0]}, "rf": {"trees": [2, 6], "mtry": [1, 5]}, "gbt": {"trees": [1, 4]}}[name]
    got = M.tune(tasks.filter("region = 1"), name, ["a", "b"], grid, folds=2)
    assert len(got) == 2 and got[0]["roc_auc"] >= got[1]["roc_auc"] > 0.5


def test_guided_selection_finds_what_counts(tasks):
    from landweave.operators import ml as M

    rows = tasks.filter("region = 1").withColumn("response", F.col("response").cast("double"))
    assert [c for c, _ in M.guided_selection(rows, ["a", "b"], penalty=0.05, trees=10)] == ["a"]


def test_kernel_family_on_a_map(spark):
    from landweave.operators import focal

    cells = spark.createDataFrame([(r * 10 + c, r, c, (r * c) % 3) for r in range(1, 8) for c in range(1, 8)], "cell_id long, row int, col int, v int")
    kernels = focal.kernel_family(spark, [3, 5], 2, seed=68)
    w = {}
    for k in kernels.collect():
        w.setdefault(k["matrix_id"], {})[k["dr"], k["dc"]] = k["w"]
    assert sorted(map(len, w.values())) == [9, 9, 25, 25]
    for r in focal.focal_sum(cells, "v", [1], kernels).collect():
        want = sum(x for (dr, dc), x in w[r["matrix_id"]].items() if 1 <= r["row"] + dr <= 7 and 1 <= r["col"] + dc <= 7 and (r["row"] + dr) * (r["col"] + dc) % 3 == 1)
        assert abs(r["value"] - want) < 1e-9


def test_listed_files_have_their_sizes(spark, tmp_path):
    import os

    from landweave.sources import io

    path = str(tmp_path / "t")
    spark.range(100).write.parquet(path)
    got = {os.path.basename(r["file"]): r["bytes"] for r in io.list_files(spark, path).collect()}
    want = {f: os.path.getsize(f"{path}/{f}") for f in os.listdir(path) if f.endswith(".parquet")}
    assert got == {**want, "total": sum(want.values())}


def test_climatology_wants_equal_files(spark):
    from landweave.operators.climate import monthly_climatology

    df = spark.createDataFrame([(1, 1, "a", 2.0), (2, 1, "a", 3.0), (1, 1, "b", 4.0)], "cell_id long, month int, file string, v double")
    with pytest.raises(ValueError):
        monthly_climatology(df, "v", "file")
    assert monthly_climatology(df.filter("cell_id = 1"), "v", "file").first()["v"] == 3.0
