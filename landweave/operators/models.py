"""Models of all transitions and regions at once: logistic fits by grouped sums, tuning by folds, scoring by a table.

A task is a transition in a region. Rows lie side by side by task, a large task in several parts; a Newton round is one
pass in which each part adds up the Gram matrices of all models of its task (folds left out, settings, replicates), and one
small step a model on the sums: linear for ridge, coordinate descent on the Gram matrix with an L1 part. Rounds go on
until no coefficient moves by more than TOL; a step that makes the loss worse is halved. What the driver holds is a row a
model: tasks, settings and folds come from configuration.

The objective is mean weighted log loss + penalty * (mixture * |b|_1 + (1 - mixture) / 2 * |b|_2 ** 2) over
coefficients of standardized columns (sample deviation of the training rows), the intercept free.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landweave.operators.ranks import kept

TOL, ROUNDS = 1e-8, 60
#: Rows of a task that one part holds, and rows of one in a forest's fit.
PART_ROWS, FOREST_ROWS = 500_000, 200_000


def _task(keys: list[str]):
    return F.to_json(F.struct(*(F.col(k) for k in keys)), {"ignoreNullFields": "false"})


def _with_keys(df: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """df with the task's keys in place of its name."""
    schema = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys)
    return df.withColumn("__k", F.from_json("task", schema)).select(*(F.col(f"__k.`{k}`").alias(k) for k in keys), *(c for c in df.columns if c != "task"))


def by_task(rows: DataFrame, keys: list[str], cols: list[str], weight: str | None = None, held: list[str] | None = None) -> DataFrame:
    """task, y, w, x (array) and held (a fold for each replicate) of rows with every column known, kept, a task's rows side by side."""
    known = rows.filter(" AND ".join(f"`{c}` IS NOT NULL" for c in ["response", *cols, *keys]))
    n = known.groupBy(*keys).agg(F.count("*").alias("__n"))
    out = known.join(n, keys).select(
        _task(keys).alias("task"),
        F.pmod(F.xxhash64(*cols, "response"), F.floor(F.col("__n") / PART_ROWS) + 1).alias("part"),
        F.col("response").cast("double").alias("y"),
        (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("w"),
        F.array(*(F.col(c).cast("double") for c in cols)).alias("x"),
        F.array(*(F.col(c).cast("int") for c in held or [])).cast("array<int>").alias("held"),
    )
    return kept(out.repartition("task", "part").sortWithinPartitions("task"))


def _runs(batches: Iterator[pa.RecordBatch], d: int, replicates: int) -> Iterator[tuple[str, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """task, y, w, x and held of rows of one task that follow each other in a batch."""
    for batch in batches:
        if not batch.num_rows:
            continue
        task = batch.column("task").to_numpy(zero_copy_only=False)
        y, w = batch.column("y").to_numpy(), batch.column("w").to_numpy()
        x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
        held = batch.column("held").flatten().to_numpy(zero_copy_only=False).reshape(-1, replicates) if replicates else np.zeros((len(y), 0), int)
        ends = [0, *(np.flatnonzero(task[1:] != task[:-1]) + 1).tolist(), len(y)]
        for a, b in zip(ends, ends[1:], strict=False):
            yield task[a], y[a:b], w[a:b], x[a:b], held[a:b]


def _sums_by_run(pairs: Iterator[tuple[str, dict[int, np.ndarray]]]) -> Iterator[pa.RecordBatch]:
    """(task, model, sums) with what follows each other of one task added up."""
    now, total = None, {}

    def out() -> Iterator[pa.RecordBatch]:
        if total:
            yield pa.RecordBatch.from_pydict({"task": [now] * len(total), "model": pa.array(list(total), pa.int32()), "sums": [v.tolist() for v in total.values()]})

    for task, sums in pairs:
        if task != now:
            yield from out()
            now, total = task, {}
        for m, v in sums.items():
            total[m] = total[m] + v if m in total else v
    yield from out()


def _added_up(parts: DataFrame) -> DataFrame:
    """(task, model, sums) with one row each; the parts of a model meet sorted, so that rows are added as they come."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, None
        for batch in batches:
            names = list(zip(batch.column("task").to_pylist(), batch.column("model").to_pylist(), strict=True))
            values = batch.column("sums").flatten().to_numpy().reshape(batch.num_rows, -1) if names else np.zeros((0, 0))
            done: list[tuple] = []
            for name, v in zip(names, values, strict=True):
                if name == now:
                    total = total + v
                else:
                    done += [(now, total)] if now is not None else []
                    now, total = name, v
            if done:
                yield pa.RecordBatch.from_pydict({"task": [n[0] for n, _ in done], "model": pa.array([n[1] for n, _ in done], pa.int32()), "sums": [v.tolist() for _, v in done]})
        if now is not None:
            yield pa.RecordBatch.from_pydict({"task": [now[0]], "model": pa.array([now[1]], pa.int32()), "sums": [total.tolist()]})

    return parts.repartition("task", "model").sortWithinPartitions("task", "model").mapInArrow(run, parts.schema)


def _moments(data: DataFrame, d: int, replicates: int) -> dict[str, dict[tuple[int, int], tuple]]:
    """By task and (replicate, fold): weight, rows, ones, and weighted mean and sample deviation without that fold; (-1, -1): of all rows."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each():
            for task, y, w, x, held in _runs(batches, d, replicates):
                of = lambda at: np.r_[w[at].sum(), at.sum(), y[at].sum(), w[at] @ x[at], w[at] @ x[at] ** 2]
                found = {-1: of(np.ones(len(y), bool))}
                for r in range(replicates):
                    found |= {r * 1000 + int(f): of(held[:, r] == f) for f in np.unique(held[:, r])}
                yield task, found

        yield from _sums_by_run(each())

    schema = "task string, model int, sums array<double>"
    got: dict[str, dict[tuple[int, int], tuple]] = {}
    for r in _added_up(data.mapInArrow(add, schema)).collect():
        got.setdefault(r["task"], {})[r["model"]] = np.array(r["sums"])
    out = {}
    for task, sums in got.items():
        out[task] = {}
        for m, own in sums.items():
            s = sums[-1] - own if m >= 0 else own
            w, n, ones = s[:3]
            mean = s[3 : 3 + d] / w if w > 0 else np.zeros(d)
            var = np.maximum(s[3 + d :] / w - mean**2, 0) if w > 0 else np.zeros(d)
            # columns that are constant but for rounding don't count
            var = np.where(var <= 1e-14 * np.maximum(mean**2, 1e-300), 0, var)
            out[task][(m // 1000, m % 1000) if m >= 0 else (-1, -1)] = (w, n, ones, mean, np.sqrt(var * n / (n - 1)) if n > 1 else np.zeros(d))
    return out


def newton_step(beta: np.ndarray, h: np.ndarray, g: np.ndarray, penalty: float, mixture: float, live: np.ndarray, factor: np.ndarray | float = 1.0) -> np.ndarray:
    """The minimum of the loss's quadratic model at beta plus the penalty (times factor); live: coefficients that aren't held at 0 (the first is free)."""
    at = np.flatnonzero(live)
    h, target = h[np.ix_(at, at)], (h @ beta + g)[at]
    own = penalty * np.r_[0.0, np.broadcast_to(factor, len(beta) - 1)][at]
    l1, l2 = own * mixture, own * (1 - mixture)
    out = np.zeros_like(beta)
    if not l1.any():
        out[at] = np.linalg.solve(h + np.diag(l2) + 1e-12 * np.eye(len(at)), target)
        return out
    b = beta[at].copy()
    for _ in range(10_000):
        worst = 0.0
        for j in range(len(at)):
            r = target[j] - h[j] @ b + h[j, j] * b[j]
            new = np.sign(r) * max(abs(r) - l1[j], 0) / (h[j, j] + l2[j] + 1e-12)
            worst, b[j] = max(worst, abs(new - b[j])), new
        if worst < TOL / 10:
            break
    out[at] = b
    return out


def _fit(data: DataFrame, d: int, models: dict[str, list[dict]], replicates: int, rounds: int = ROUNDS) -> dict[str, list[dict]]:
    """models: by task dicts of w, mean, sd, penalty, mixture, replicate, fold, and factor (of the penalty, by column) if any; each gets beta, h (of the mean loss at beta), rounds and converged."""
    tri = np.triu_indices(d + 1)
    for own in models.values():
        for m in own:
            p = np.clip(m["ones"] / m["n"], 1e-6, 1 - 1e-6)
            m |= {"beta": np.r_[np.log(p / (1 - p)), np.zeros(d)], "best": None, "loss": np.inf, "rounds": 0, "converged": False, "h": None, "sd1": np.where(m["sd"] > 0, m["sd"], 1.0), "live": np.r_[True, m["sd"] > 0]}
    for _ in range(rounds):
        asked = {t: [(i, m["beta"], m["mean"], m["sd1"], m["live"][1:], m["replicate"], m["fold"]) for i, m in enumerate(own) if not m["converged"]] for t, own in models.items()}
        asked = {t: own for t, own in asked.items() if own}
        if not asked:
            break

        def add(batches: Iterator[pa.RecordBatch], asked=asked) -> Iterator[pa.RecordBatch]:
            def each():
                for task, y, w, x, held in _runs(batches, d, replicates):
                    found = {}
                    for i, beta, mean, sd, live, r, f in asked.get(task, ()):
                        use = held[:, r] != f if r >= 0 else slice(None)
                        z = np.c_[np.ones(len(y[use])), (x[use] - mean) / sd * live]
                        eta = z @ beta
                        mu = 1 / (1 + np.exp(-np.clip(eta, -500, 500)))
                        h = z.T @ (z * (w[use] * mu * (1 - mu))[:, None])
                        found[i] = np.r_[h[tri], z.T @ (w[use] * (y[use] - mu)), w[use] @ (np.logaddexp(0, eta) - y[use] * eta)]
                    yield task, found

            yield from _sums_by_run(each())

        schema = "task string, model int, sums array<double>"
        for r in _added_up(data.mapInArrow(add, schema)).collect():
            m = models[r["task"]][r["model"]]
            s = np.array(r["sums"]) / m["w"]
            h = np.zeros((d + 1, d + 1))
            h[tri] = s[: len(tri[0])]
            h = h + np.triu(h, 1).T
            g, b, f = s[len(tri[0]) : -1], m["beta"], m.get("factor", 1.0)
            loss = s[-1] + m["penalty"] * (m["mixture"] * (f * np.abs(b[1:])).sum() + (1 - m["mixture"]) / 2 * (f * b[1:] ** 2).sum())
            m["rounds"] += 1
            if loss > m["loss"] + 1e-12 * (1 + abs(m["loss"])):
                m["beta"] = (b + m["best"]) / 2
            else:
                m["best"], m["loss"], m["h"] = b, loss, h
                m["beta"] = b + np.clip(newton_step(b, h, g, m["penalty"], m["mixture"], m["live"], f) - b, -5, 5)
            m["converged"] = bool(np.abs(m["beta"] - b).max() < TOL)
    return models


_TABLE = "task string, setting int, replicate int, fold int, penalty double, mixture double, intercept double, coefficients array<double>, rounds int, converged boolean"


def _table(data: DataFrame, models: dict[str, list[dict]]) -> DataFrame:
    rows = []
    for task, own in models.items():
        for m in own:
            c = m["beta"][1:] / m["sd1"] * m["live"][1:]
            rows.append((task, m["setting"], m["replicate"], m["fold"], float(m["penalty"]), float(m["mixture"]), float(m["beta"][0] - c @ m["mean"]), [float(v) for v in c], m["rounds"], m["converged"]))
    return data.sparkSession.createDataFrame(rows, _TABLE)


def _asked(moments: dict, settings: list[dict], which: dict[str, list[int]] | None, parts: bool) -> dict[str, list[dict]]:
    """The models to fit: of each task with both classes every setting (or those in which), on all rows or without each fold of each replicate."""
    out: dict[str, list[dict]] = {}
    for task, own in moments.items():
        for (r, f), (w, n, ones, mean, sd) in own.items():
            if (r >= 0) != parts or not 0 < ones < n:
                continue
            for k in which.get(task, []) if which is not None else range(len(settings)):
                out.setdefault(task, []).append({"w": w, "n": n, "ones": ones, "mean": mean, "sd": sd, "replicate": r, "fold": f, "setting": k, "penalty": settings[k].get("penalty", 0.0), "mixture": settings[k].get("mixture", 0.0)})
    return out


def fit_glm(rows: DataFrame, keys: list[str], cols: list[str], settings: list[dict], weight: str | None = None, chosen: dict[str, list[int]] | None = None, data: DataFrame | None = None) -> DataFrame:
    """(keys, setting, penalty, mixture, intercept, coefficients, rounds, converged): a logistic fit for each task and setting.

    settings: dicts of penalty and mixture. Tasks with one class only have no model. Rows with nulls don't count.
    """
    data = by_task(rows, keys, cols, weight) if data is None else data
    # a task's fits on all rows don't look at folds
    models = _fit(data.withColumn("held", F.array().cast("array<int>")), len(cols), _asked(_moments(data, len(cols), 0), settings, chosen, False), 0)
    return _with_keys(_table(data, models), rows, keys).drop("replicate", "fold")


def slope_tests(rows: DataFrame, keys: list[str], cols: list[str], weight: str | None = None, rounds: int = 15) -> DataFrame:
    """(keys, coefficients, t, rounds, converged): unpenalized fits with |coefficient / standard error| of each column (0 for constant ones)."""
    data = by_task(rows, keys, cols, weight)
    models = _fit(data, len(cols), _asked(_moments(data, len(cols), 0), [{}], None, False), 0, rounds)
    out = []
    for task, (m,) in models.items():
        at = np.flatnonzero(m["live"])
        se = np.sqrt(np.maximum(np.diag(np.linalg.pinv(m["h"][np.ix_(at, at)] * m["w"])), 0))
        t = np.zeros(len(cols) + 1)
        t[at] = np.abs(m["beta"][at]) / np.where(se > 0, se, np.inf)
        out.append((task, [float(v) for v in m["beta"][1:] / m["sd1"] * m["live"][1:]], [float(v) for v in t[1:]], m["rounds"], m["converged"]))
    found = data.sparkSession.createDataFrame(out, "task string, coefficients array<double>, t array<double>, rounds int, converged boolean")
    return _with_keys(found, rows, keys)


def with_folds(rows: DataFrame, keys: list[str], folds: int, replicates: int, seed: int = 1) -> tuple[DataFrame, list[str]]:
    """rows with a column of stratified folds for each replicate, kept."""
    from landweave.operators.ml import stratified_folds

    names = [f"fold_{r}" for r in range(replicates)]
    for r, name in enumerate(names):
        rows = stratified_folds(rows, keys, folds, seed + r).withColumnRenamed("fold", name)
    return kept(rows), names


def tune_glm(rows: DataFrame, keys: list[str], cols: list[str], settings: list[dict], folds: int = 3, replicates: int = 2, seed: int = 1, weight: str | None = None) -> DataFrame:
    """(keys, setting, penalty, mixture, replicate, fold, roc_auc, rounds, converged): every setting of every task on every fold of every replicate."""
    from landweave.operators.ml import roc_auc

    parted, names = with_folds(rows, keys, folds, replicates, seed)
    data, d = by_task(parted, keys, cols, weight, names), len(cols)
    models = _fit(data, d, _asked(_moments(data, d, replicates), settings, None, True), replicates)
    linear = {t: [(i, m["replicate"], m["fold"], m["beta"][0], m["beta"][1:] * m["live"][1:] / m["sd1"], m["mean"]) for i, m in enumerate(own)] for t, own in models.items()}

    # a fit is one number, since names of tasks would be moved and ordered with every prediction
    first, n_fits = {}, 0
    for t, own in models.items():
        first[t], n_fits = n_fits, n_fits + len(own)

    def held_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for task, y, _, x, held in _runs(batches, d, replicates):
            fit, ys, ps = [], [], []
            for i, r, f, b, c, mean in linear.get(task, ()):
                at = held[:, r] == f
                ps.append(1 / (1 + np.exp(-np.clip(b + (x[at] - mean) @ c, -500, 500))))
                ys.append(y[at])
                fit.append(np.full(len(ps[-1]), first[task] + i, np.int32))
            if fit:
                yield pa.RecordBatch.from_pydict({"fit": np.concatenate(fit), "response": np.concatenate(ys), "p": np.concatenate(ps)})

    auc = roc_auc(data.mapInArrow(held_out, "fit int, response double, p double"), ["fit"])
    spec = data.sparkSession.createDataFrame([(t, first[t] + i, m["setting"], float(m["penalty"]), float(m["mixture"]), m["replicate"], m["fold"], m["rounds"], m["converged"]) for t, own in models.items() for i, m in enumerate(own)], "task string, fit int, setting int, penalty double, mixture double, replicate int, fold int, rounds int, converged boolean")
    out = spec.join(auc, ["fit"], "left").select("task", "setting", "penalty", "mixture", "replicate", "fold", "roc_auc", "rounds", "converged")
    return _with_keys(out, rows, keys)


def best_settings(tuned: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, setting, roc_auc): of each task the setting of greatest mean AUC over replicates and folds; ties to the smaller setting."""
    mean = tuned.groupBy(*keys, "setting").agg(F.avg("roc_auc").alias("roc_auc"))
    return mean.groupBy(*keys).agg(F.min_by("setting", F.struct(-F.coalesce(F.round("roc_auc", 9), F.lit(-1.0)), F.col("setting"))).alias("setting"), F.max(F.round("roc_auc", 9)).alias("roc_auc"))


def best_glm(rows: DataFrame, keys: list[str], cols: list[str], settings: list[dict], folds: int = 3, replicates: int = 2, seed: int = 1, weight: str | None = None) -> DataFrame:
    """The best setting of each task by mean AUC over replicates and folds, fitted again on all its rows; with that roc_auc."""
    best = kept(best_settings(tune_glm(rows, keys, cols, settings, folds, replicates, seed, weight), keys))
    chosen = {r["task"]: [r["setting"]] for r in best.select(_task(keys).alias("task"), "setting").collect()}
    return fit_glm(rows, keys, cols, settings, weight, chosen).join(best, [*keys, "setting"])


def score_glm(rows: DataFrame, keys: list[str], table: DataFrame, cols: list[str]) -> DataFrame:
    """rows that have a model, one row a row and model of their keys, with p: one join and one expression for any number of models.

    keys may be fewer than the table's: rows of a region and class meet every transition from it.
    """
    x = F.array(*(F.col(c).cast("double") for c in cols))
    both = rows.filter(" AND ".join(f"`{c}` IS NOT NULL" for c in cols)).join(table, keys)
    eta = F.aggregate(F.zip_with(x, "coefficients", lambda a, b: a * b), F.col("intercept"), lambda s, v: s + v)
    more = [c for c in table.columns if c not in (*keys, "intercept", "coefficients")]
    return both.select(*rows.columns, *(c for c in more if c not in rows.columns), (1 / (1 + F.exp(-eta))).alias("p"))


def tree_table(spark, path: str, keys: list[str], schema: str) -> DataFrame:
    """(keys, family, nodes, mean, sd) of all forests and boosted trees saved below path/<key>.<key>...: one scan of the saved node tables.

    nodes: arrays over all nodes of a model: tree, id, feature (-1: leaf), threshold, left, right, value. A forest's
    value is the share of class 1 over the trees, a boosted model's is half its log odds.
    """
    found = spark.read.option("recursiveFileLookup", "false").parquet(f"{path}/*/stages/2_*/data").select("treeID", "nodeData.*", F.input_file_name().alias("file"))
    place = F.regexp_extract("file", r"/([^/]+)/stages/2_([A-Za-z]+)_[^/]*/data/", 1)
    family = F.regexp_extract("file", r"/([^/]+)/stages/2_([A-Za-z]+)_[^/]*/data/", 2)
    weights = spark.read.parquet(f"{path}/*/stages/2_*/treesMetadata").select("*", F.input_file_name().alias("file"))
    weights = weights.select(F.regexp_extract("file", r"/([^/]+)/stages/", 1).alias("place"), F.col(weights.columns[0]).alias("treeID"), F.col(weights.columns[2]).cast("double").alias("weight"))
    trees = found.select("treeID", place.alias("place"), F.when(family == "GBTClassifier", "gbt").otherwise("rf").alias("family"), "id", "prediction", "impurityStats", "leftChild", "rightChild", "split").join(weights, ["place", "treeID"])
    total = F.aggregate("impurityStats", F.lit(0.0), lambda s, v: s + v)
    value = F.when(F.col("family") == "gbt", F.col("prediction") * F.col("weight")).otherwise(F.try_divide(F.get("impurityStats", 1), total))
    node = F.struct("treeID", "id", F.col("split.featureIndex").alias("feature"), F.coalesce(F.get("split.leftCategoriesOrThreshold", 0), F.lit(0.0)).alias("threshold"), "leftChild", "rightChild", value.alias("value"))
    one = trees.groupBy("place", "family").agg(F.sort_array(F.collect_list(node)).alias("nodes"))
    ends = spark.read.parquet(f"{path}/*/stages/1_*/data").select(F.regexp_extract(F.input_file_name(), r"/([^/]+)/stages/", 1).alias("place"), vector_to_array("mean").alias("mean"), vector_to_array("std").alias("sd"))
    one = one.join(ends, "place")
    names = [c.strip().split(" ")[0].strip("`") for c in schema.split(",")]
    kinds = [c.strip().split(" ")[1] for c in schema.split(",")]
    parts = F.split("place", r"\.")
    return one.select(*(F.get(parts, k).cast(kind).alias(n) for k, (n, kind) in enumerate(zip(names, kinds, strict=True))), "family", "nodes", "mean", "sd")


def forest_scores(nodes: list, family: str, x: np.ndarray) -> np.ndarray:
    """p of class 1 for rows of x by one model's flattened trees; all rows go down a tree level by level."""
    tree, ids, feature, left, right = (np.array([n[c] for n in nodes], np.int64) for c in ("treeID", "id", "feature", "leftChild", "rightChild"))
    threshold, value = (np.array([n[c] for n in nodes], np.float64) for c in ("threshold", "value"))
    total, names = np.zeros(len(x)), np.unique(tree)
    for t in names:
        at = np.flatnonzero(tree == t)
        place = np.zeros(ids[at].max() + 1, np.int64)
        place[ids[at]] = at
        now = np.full(len(x), place[0])
        while (moving := np.flatnonzero(feature[now] >= 0)).size:
            n = now[moving]
            now[moving] = place[np.where(x[moving, feature[n]] <= threshold[n], left[n], right[n])]
        total += value[now]
    return 1 / (1 + np.exp(-2 * total)) if family == "gbt" else total / len(names)


def score_trees(rows: DataFrame, keys: list[str], table: DataFrame, cols: list[str], id_col: str = "cell_id") -> DataFrame:
    """(keys of the table, id_col, family, p) of rows by the trees of their task; a plan for any number of models.

    Rows meet their models by keys and a salt, so a task's rows are many groups; its models go to each of them. The
    trees were fitted on standardized columns, whose means and deviations the table carries (mean, sd).
    """
    n = rows.count()
    salts = max(1, min(1024, n // 200_000))
    x = F.array(*(F.col(c).cast("double") for c in cols))
    cells = rows.filter(" AND ".join(f"`{c}` IS NOT NULL" for c in cols)).select(*keys, id_col, x.alias("__x"), F.pmod(F.xxhash64(id_col), F.lit(salts)).alias("__salt"))
    models = table.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).withColumn("__salt", F.col("__salt").cast("long"))
    extra = [c for c in table.columns if c not in (*keys, "nodes", "mean", "sd", "family")]
    names = [*keys, *extra, id_col, "family", "p"]

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            raw = np.stack(left["__x"].to_list())
            for m in right.to_dict("records"):
                sd = np.array(m["sd"], float)
                z = np.where(sd > 0, (raw - np.array(m["mean"], float)) / np.where(sd > 0, sd, 1), 0.0)
                out.append(left[[*keys, id_col]].assign(**{c: m[c] for c in extra}, family=m["family"], p=forest_scores(m["nodes"], m["family"], z)))
        return pd.concat(out)[names] if out else pd.DataFrame(columns=names)

    kind = lambda df, c: f"`{c}` {df.schema[c].dataType.simpleString()}"
    schema = ", ".join([*(kind(rows, k) for k in keys), *(kind(table, c) for c in extra), kind(rows, id_col), "family string, p double"])
    return cells.groupBy(*keys, "__salt").cogroup(models.groupBy(*keys, "__salt")).applyInPandas(run, schema)


def choose_models(rows: DataFrame, keys: list[str], cols: list[str], specs: dict[str, list[dict]], path: str, folds: int = 3, replicates: int = 2, seed: int = 1, at_once: int = 8) -> DataFrame:
    """(keys, model, setting, roc_auc): of each task the family and setting of greatest mean AUC over replicates and folds
    (ties by name, then setting), fitted again on all its rows and saved under path.

    specs: settings to try by family. Logistic fits of all tasks go together; MLlib fits trees one at a time, from rows
    kept side by side by task, at_once of them in parallel. A task with one class only has no model.
    """
    from multiprocessing.pool import ThreadPool

    from landweave.operators.ml import model_spec, roc_auc, score, task_folder

    spark = rows.sparkSession
    tried = []
    if "glm" in specs:
        tuned = tune_glm(rows, keys, cols, specs["glm"], folds, replicates, seed)
        tried += [(*(r[k] for k in keys), "glm", r["setting"], r["auc"]) for r in tuned.groupBy(*keys, "setting").agg(F.avg("roc_auc").alias("auc")).collect()]
    trees = sorted(set(specs) - {"glm"})
    if trees:
        known = rows.filter(" AND ".join(f"`{c}` IS NOT NULL" for c in ["response", *cols]))
        parted, names = with_folds(known.repartition(*keys), keys, folds, replicates, seed)
        tasks = [tuple(r[k] for k in keys) for r in parted.groupBy(*keys).agg(F.countDistinct("response").alias("n")).filter("n = 2").orderBy(*keys).collect()]

        def own(task: tuple) -> DataFrame:
            out = parted
            for k, v in zip(keys, task, strict=True):
                out = out.filter(F.col(k).eqNullSafe(F.lit(v)))
            return out

        def one(job: tuple) -> float | None:
            task, family, k, r, f = job
            fit = model_spec(family, cols, **specs[family][k]).fit(own(task).filter(F.col(names[r]) != f))
            return roc_auc(score(own(task).filter(F.col(names[r]) == f), fit), []).first()["roc_auc"]

        jobs = [(t, family, k, r, f) for t in tasks for family in trees for k in range(len(specs[family])) for r in range(replicates) for f in range(folds)]
        with ThreadPool(at_once) as pool:
            got = dict(zip(jobs, pool.map(one, jobs, 1), strict=True))
        for t, family, k in dict.fromkeys(j[:3] for j in jobs):
            found = [v for j, v in got.items() if j[:3] == (t, family, k) and v is not None]
            tried.append((*t, family, k, sum(found) / len(found) if found else None))
    rank = lambda x: (-(round(x[-1], 9) if x[-1] is not None else -1.0), x[-3], x[-2])
    best: dict[tuple, tuple] = {}
    for x in sorted(tried, key=rank):
        best.setdefault(x[: len(keys)], x)
    schema = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys)
    out = spark.createDataFrame(list(best.values()), f"{schema}, model string, setting int, roc_auc double")
    linear = out.filter("model = 'glm'").select(_task(keys).alias("task"), "setting").collect()
    if "glm" in specs:
        fit_glm(rows, keys, cols, specs["glm"], chosen={r["task"]: [r["setting"]] for r in linear}).write.mode("overwrite").parquet(f"{path}/glm")
    if trees:
        with ThreadPool(at_once) as pool:
            pool.map(lambda x: model_spec(x[-3], cols, **specs[x[-3]][x[-2]]).fit(own(x[: len(keys)])).write().overwrite().save(f"{path}/trees/{task_folder(list(x[: len(keys)]))}"), [x for x in best.values() if x[-3] != "glm"], 1)
    return out


def guided_selections(rows: DataFrame, keys: list[str], cols: list[str], weight: str | None = None, balanced: bool = False, gamma: float = 0.5, penalty: float = 0.01, trees: int = 100, seed: int = 7, at_once: int = 4) -> DataFrame:
    """(keys, predictor, importance, coefficient, kept, converged) of each task with both classes and each of cols.

    Forest importances guide a lasso of z-scores: column j counts (1 - gamma) + gamma * imp_j / max(imp), so its penalty is
    divided by that; coefficients are of z-scores, and kept are those that aren't 0. Columns that are constant in a task take no part there. balanced: a
    task's classes weigh the same. MLlib fits forests one at a time, at_once of them side by side; lassos go together.
    """
    from multiprocessing.pool import ThreadPool

    from landweave.operators.ml import class_weights

    # the rows are gone over many times: they are made once
    data = by_task(kept(rows.select(*keys, "response", *([weight] if weight else []), *cols)), keys, cols, weight)
    if balanced:
        own = kept(class_weights(data.withColumnRenamed("y", "response"), ["task"]).select("task", F.col("response").alias("y"), F.col("weight").alias("w")))
        data = data.drop("w").join(F.broadcast(own), ["task", "y"])
    models = _asked(_moments(data, len(cols), 0), [{"penalty": penalty, "mixture": 1.0}], None, False)

    def importances(task: str) -> np.ndarray:
        m, out = models[task][0], np.zeros(len(cols))
        at = np.flatnonzero(m["sd"] > 0)
        if len(at):
            mine = data.filter(F.col("task") == task).select("y", "w", array_to_vector(F.array(*(F.col("x")[int(j)] for j in at))).alias("features"))
            # a forest keeps a number for each row and tree
            parts = int(m["n"] // FOREST_ROWS)
            mine = mine.repartition(parts + 1) if parts else mine
            forest = RandomForestClassifier(labelCol="y", weightCol="w", numTrees=trees, minInstancesPerNode=10, featureSubsetStrategy="sqrt", seed=seed)
            out[at] = forest.fit(mine).featureImportances.toArray()
        return out

    names = sorted(models)
    with ThreadPool(at_once) as pool:
        found = dict(zip(names, pool.map(importances, names, 1), strict=True))
    for task, (m,) in models.items():
        m["factor"] = 1 / np.maximum((1 - gamma) + gamma * found[task] / (found[task].max() or 1.0), 1e-9)
    _fit(data.withColumn("held", F.array().cast("array<int>")), len(cols), models, 0)
    out = [(task, c, float(found[task][j]), float(m["beta"][1 + j]), bool(m["beta"][1 + j] != 0), m["converged"]) for task, (m,) in models.items() for j, c in enumerate(cols)]
    return _with_keys(rows.sparkSession.createDataFrame(out, "task string, predictor string, importance double, coefficient double, kept boolean, converged boolean"), rows, keys)


def score_models(rows: DataFrame, keys: list[str], fitted: DataFrame, path: str, cols: list[str], id_col: str = "cell_id") -> DataFrame:
    """(keys of fitted, id_col, p) of rows by the models that choose_models saved: one plan, however many tasks. keys: those of rows, all or some of fitted's."""
    spark = rows.sparkSession
    own = [c for c in fitted.columns if c not in ("model", "setting", "roc_auc")]
    cells, out = rows.select(*keys, id_col, *cols), []
    families = {r["model"] for r in fitted.select("model").distinct().collect()}
    if "glm" in families:
        table = spark.read.parquet(f"{path}/glm").select(*own, "intercept", "coefficients")
        out.append(score_glm(cells, keys, table, cols).select(*own, id_col, "p"))
    if families - {"glm"}:
        schema = ", ".join(f"{k} {fitted.schema[k].dataType.simpleString()}" for k in own)
        out.append(score_trees(cells, keys, tree_table(spark, f"{path}/trees", own, schema), cols, id_col).select(*own, id_col, "p"))
    if not out:
        return cells.limit(0).join(fitted, keys).select(*own, id_col, F.lit(None).cast("double").alias("p"))
    return out[0] if len(out) == 1 else out[0].unionByName(out[1])
