"""Samples, feature selection, models and metrics of transitions."""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from landweave.operators.ranks import kept, ranked

MODELS = {"glm": LogisticRegression, "rf": RandomForestClassifier, "gbt": GBTClassifier}
#: Settings by their names in a model specification and in MLlib.
SETTINGS = {"penalty": "regParam", "mixture": "elasticNetParam", "trees": {"rf": "numTrees", "gbt": "maxIter"}, "min_n": "minInstancesPerNode", "mtry": "featureSubsetStrategy", "tree_depth": "maxDepth", "learn_rate": "stepSize", "loss_reduction": "minInfoGain"}


def load_response(long: DataFrame, keys: list[str]) -> DataFrame:
    """One row a task and cell with a response; of several the greatest response stays."""
    return long.filter("response IS NOT NULL").groupBy(*keys, "cell_id").agg(F.max("response").alias("response"))


def thin_majority(df: DataFrame, keys: list[str], ratio: float = 1.5) -> DataFrame:
    """Where zeros exceed ratio times the ones, every k-th zero in cell order stays, k = ceil(zeros / ceil(ratio * ones))."""
    n = df.groupBy(*keys).agg(F.sum(F.col("response").cast("long")).alias("__n1"), F.sum((1 - F.col("response")).cast("long")).alias("__n0"))
    rows = ranked(df, [*keys, "response"], [F.col("cell_id")]).drop("__n").join(n, keys)
    k = F.ceil(F.col("__n0") / F.greatest(F.ceil(F.col("__n1") * ratio), F.lit(1)))
    keep = (F.col("response") == 1) | (F.col("__n0") <= F.col("__n1") * ratio) | ((F.col("__rn") - 1) % k == 0)
    return rows.filter(keep).select(*df.columns)


def class_weights(df: DataFrame, keys: list[str]) -> DataFrame:
    n = df.groupBy(*keys, "response").agg(F.count("*").alias("n"))
    return n.withColumn("weight", F.max("n").over(Window.partitionBy(*keys)) / F.col("n"))


def task_status(df: DataFrame, keys: list[str], least: int = 100, least_ones: int = 10) -> DataFrame:
    n = df.groupBy(*keys).agg(F.count("*").alias("n_observations"), F.sum("response").alias("n_transitions"))
    s = F.when(F.col("n_transitions") == 0, "no_transition_data").when(F.col("n_observations") < least, "insufficient_observations").when(F.col("n_transitions") < least_ones, "insufficient_transitions").otherwise("eligible")
    return n.withColumn("status", s)


def needs_downsampling(df: DataFrame, keys: list[str], low: float = 0.05, high: float = 60.0) -> DataFrame:
    """Tasks whose ratio of ones to zeros is at most low or at least high."""
    n = df.groupBy(*keys).agg(F.sum("response").alias("n1"), F.sum(1 - F.col("response")).alias("n0"))
    r = F.try_divide(F.col("n1").cast("double"), F.col("n0"))
    return n.withColumns({"ratio": r, "downsample": F.coalesce((r <= low) | (r >= high), F.lit(False))})


def univariate_pvalues(long: DataFrame, rounds: int = 15, least: int = 10) -> DataFrame:
    """(task, predictor, n, p_value, converged): weighted logistic fits of y on x (and x^2 with more than five values), all at once.

    long: task, predictor, x, y, w. p is the least favourable (greatest) two-sided one of the slopes. Fits go on until no
    coefficient moves; converged is false for a predictor that separates the classes, which never ends, and p is NULL
    where y has one class only.
    """
    from landweave.operators.models import slope_tests

    rows = kept(long.filter("x IS NOT NULL"))
    stats = rows.groupBy("task", "predictor").agg(F.count("*").alias("n"), F.countDistinct("x").alias("d"), F.avg("x").alias("m"), F.stddev_pop("x").alias("s"))
    stats = kept(stats.filter((F.col("n") >= least) & (F.col("d") >= 3) & (F.col("s") > 0)))
    z = (F.col("x") - F.col("m")) / F.col("s")
    quad = F.col("d") > 5
    both = rows.join(stats, ["task", "predictor"]).select("task", "predictor", F.col("y").alias("response"), "w", z.alias("z"), F.when(quad, z * z).otherwise(0.0).alias("z2"))
    tests = slope_tests(both, ["task", "predictor"], ["z", "z2"], "w", rounds)
    p = lambda x: F.least(F.lit(1.0), 2 / (1 + F.exp(F.least(F.lit(700.0), 1.5976 * x + 0.07056 * x * x * x))))
    t = F.when(quad, F.least(F.col("t")[0], F.col("t")[1])).otherwise(F.col("t")[0])
    return stats.join(tests, ["task", "predictor"], "left").select("task", "predictor", "n", p(t).alias("p_value"), F.coalesce("converged", F.lit(False)).alias("converged"))


def correlations(df: DataFrame, cols: list[str]) -> DataFrame:
    """(a, b, r) of all pairs on rows where both are known; one pass."""
    pairs = list(itertools.combinations(cols, 2))
    both = lambda a, b: F.when(F.col(b).isNotNull(), F.col(a))
    one = df.agg(*(F.try_divide(F.covar_pop(both(a, b), both(b, a)), F.stddev_pop(both(a, b)) * F.stddev_pop(both(b, a))).alias(f"{a}|{b}") for a, b in pairs))
    rows = one.select(F.explode(F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.nanvl(F.col(f"`{a}|{b}`"), F.lit(None).cast("double")).alias("r")) for a, b in pairs))).alias("x"))
    return rows.select("x.*")


def collinearity_filter(df: DataFrame, order: list[str] | dict[str, list[str]], cut: float = 0.7) -> list[str]:
    """Predictors in order of p-value, each kept unless it correlates above cut with one kept before; unknown correlations are 0.

    order: one list, or a list for each category, which are filtered apart.
    """
    kept: list[str] = []
    for own in order.values() if isinstance(order, dict) else [order]:
        r = {frozenset((x["a"], x["b"])): abs(x["r"] or 0.0) for x in correlations(df, own).collect()} if len(own) > 1 else {}
        good: list[str] = []
        for c in own:
            if all(r[frozenset((c, k))] <= cut for k in good):
                good.append(c)
        kept += good
    return kept


def assemble(df: DataFrame, cols: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="skip").transform(df)


def guided_selection(df: DataFrame, cols: list[str], gamma: float = 0.5, penalty: float = 0.01, trees: int = 100, seed: int = 7) -> list[tuple[str, float]]:
    """(predictor, importance) of one task's rows: those that models.guided_selections keeps, most important first; weights come from a column weight, if any."""
    from landweave.operators.models import guided_selections

    weight = "weight" if "weight" in df.columns else None
    found = guided_selections(df.withColumn("__task", F.lit(1)), ["__task"], cols, weight, False, gamma, penalty, trees, seed)
    return [(r["predictor"], r["importance"]) for r in found.filter("kept").orderBy(F.desc("importance"), "predictor").collect()]


def _order(seed: int) -> Column:
    return F.xxhash64("cell_id", F.lit(seed))


def _shuffled(df: DataFrame, keys: list[str], seed: int) -> DataFrame:
    """df with __rn and __n: the place among the rows of its task and class in seeded order, and their number."""
    return ranked(df, [*keys, "response"], [_order(seed), F.col("cell_id")])


def balance(df: DataFrame, keys: list[str], multiplier: float = 1.0, seed: int = 1, most: int | None = None, proportion: float | None = None) -> DataFrame:
    """All of the smaller class and a seeded choice of multiplier times as many of the larger.

    proportion: instead, so many of the larger that the smaller is this share of all; most: at most so many rows in all.
    """
    least = df.groupBy(*keys, "response").agg(F.count("*").alias("__c")).groupBy(*keys).agg(F.min("__c").alias("__least"))
    rows = _shuffled(df, keys, seed).join(least, keys)
    room = F.floor(F.col("__least") * (multiplier if proportion is None else (1 - proportion) / proportion) + 1e-9)
    if most is not None:
        room = F.least(room, F.lit(most) - F.col("__least"))
    return rows.filter((F.col("__n") == F.col("__least")) | (F.col("__rn") <= room)).select(*df.columns)


def final_sample(df: DataFrame, keys: list[str], most: int, seed: int = 1) -> DataFrame:
    return balance(df, keys, multiplier=1e12, seed=seed, most=most)


def stratified_split(df: DataFrame, keys: list[str], share: float = 0.75, seed: int = 1) -> DataFrame:
    """part: train for the first share of each class in seeded order, else test."""
    part = F.when(F.col("__rn") <= F.round(F.col("__n") * share), "train").otherwise("test")
    return _shuffled(df, keys, seed).select(*df.columns, part.alias("part"))


def stratified_folds(df: DataFrame, keys: list[str], k: int = 5, seed: int = 1) -> DataFrame:
    return _shuffled(df, keys, seed).select(*df.columns, (F.col("__rn") % k).cast("int").alias("fold"))


def model_spec(name: str, cols: list[str], **params):
    """A pipeline: columns, z-scores, and a model (glm, rf, gbt) with settings by their specification names."""
    own = {}
    for key, value in params.items():
        to = SETTINGS.get(key, key)
        to = to[name] if isinstance(to, dict) else to
        own[to] = str(min(int(value), len(cols))) if to == "featureSubsetStrategy" else value
    if name in ("rf", "gbt"):
        own.setdefault("seed", 7)
    model = MODELS[name](labelCol="response", featuresCol="scaled", **own)
    return Pipeline(stages=[VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="skip"), StandardScaler(inputCol="features", outputCol="scaled", withMean=True), model])


def score(df: DataFrame, model) -> DataFrame:
    """df with p (of class 1) and predicted (at 0.5)."""
    out = model.transform(df).withColumn("p", vector_to_array("probability")[1])
    return out.withColumn("predicted", (F.col("p") >= 0.5).cast("int")).select(*df.columns, "p", "predicted")


def tune(df: DataFrame, name: str, cols: list[str], grid: dict[str, list], folds: int = 3, seed: int = 1, at_once: int = 4) -> list[dict]:
    """All settings of the grid by cross-validation: mean AUC over folds, best first. mtry above the number of columns is dropped.

    at_once: fits that Spark runs side by side.
    """
    rows = stratified_folds(df, [], folds, seed).cache()
    grid_of = [dict(zip(grid, values, strict=True)) for values in itertools.product(*grid.values())]
    grid_of = [p for p in grid_of if p.get("mtry", 0) <= len(cols)]

    def one(job: tuple[dict, int]) -> float | None:
        params, k = job
        model = model_spec(name, cols, **params).fit(rows.filter(F.col("fold") != k))
        return roc_auc(score(rows.filter(F.col("fold") == k), model), []).first()["roc_auc"]

    with ThreadPool(at_once) as pool:
        got = pool.map(one, [(p, k) for p in grid_of for k in range(folds)], 1)
    rows.unpersist()
    out = []
    for i, params in enumerate(grid_of):
        known = [x for x in got[i * folds : (i + 1) * folds] if x is not None]
        out.append({**params, "roc_auc": sum(known) / len(known) if known else None})
    return sorted(out, key=lambda x: -(x["roc_auc"] or 0))


def task_folder(values: list) -> str:
    return ".".join(str(v) for v in values)


def roc_auc(pred: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, roc_auc): AUC by rank sums (ties half), NULL with one class only; exact, and rows move once.

    A batch counts its rows by probability first, so that a crowded probability is a row a batch. Then counts lie in ranges of
    keys and probability, equal ones in one range; a range gives a row for each of its keys: its ones, zeros and pairs won
    within it. The ranges below a range win against all its ones.
    """
    spark = pred.sparkSession
    named = [f"k{i}" for i in range(len(keys))]
    rows = pred.select(*(F.col(k).alias(n) for k, n in zip(keys, named, strict=True)), F.col("p").cast("double").alias("p"), F.col("response").cast("double").alias("one"))
    rows = rows.filter("p IS NOT NULL AND one IS NOT NULL")
    kinds = ", ".join(f"{n} {rows.schema[n].dataType.simpleString()}" for n in named)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = t.append_column("zero", pc.subtract(1.0, t["one"])).group_by([*named, "p"]).aggregate([("one", "sum"), ("zero", "sum")])
            yield from t.select([*named, "p", "one_sum", "zero_sum"]).rename_columns([*named, "p", "one", "zero"]).combine_chunks().to_batches()

    # the ranges are drawn from a sample, a pass of its own, so that the counts are kept
    counts = kept(rows.mapInArrow(counted, ", ".join(x for x in (kinds, "p double, one double, zero double") if x)))
    ranged = counts.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *named, "p").sortWithinPartitions(*named, "p")

    def won(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, tie = None, None
        total = np.zeros(3)  # ones, zeros and pairs won by what lies before the open tie

        def closed(total, tie):
            return total + np.array([tie[1], tie[2], tie[1] * (total[1] + tie[2] / 2)])

        for batch in batches:
            if not batch.num_rows:
                continue
            p, one, zero = (batch.column(c).to_numpy() for c in ("p", "one", "zero"))
            new = np.zeros(len(p), bool)
            for n in named:
                c = batch.column(n)
                new[1:] |= pc.fill_null(pc.not_equal(c[1:], c[:-1]), False).to_numpy(zero_copy_only=False) | (c[1:].is_null().to_numpy(zero_copy_only=False) != c[:-1].is_null().to_numpy(zero_copy_only=False))
            starts = np.r_[0, np.flatnonzero(new)]
            out = []
            for a, b in zip(starts, np.r_[starts[1:], len(p)], strict=True):
                key = tuple(batch.column(n)[int(a)].as_py() for n in named)
                if now is not None and key != now:
                    out.append((now, closed(total, tie)))
                    total, tie = np.zeros(3), None
                now = key
                at = np.r_[a, a + 1 + np.flatnonzero(p[a + 1 : b] != p[a : b - 1])]
                ones, zeros = np.add.reduceat(one[a:b], at - a), np.add.reduceat(zero[a:b], at - a)
                if tie is not None and tie[0] == p[a]:
                    ones[0], zeros[0] = ones[0] + tie[1], zeros[0] + tie[2]
                elif tie is not None:
                    total = closed(total, tie)
                below = total[1] + np.cumsum(zeros) - zeros
                total = total + np.array([ones[:-1].sum(), zeros[:-1].sum(), (ones * (below + zeros / 2))[:-1].sum()])
                tie = (p[b - 1], ones[-1], zeros[-1])
            if out:
                yield sums(out)
        if now is not None:
            yield sums([(now, closed(total, tie))])

    def sums(found: list[tuple]) -> pa.RecordBatch:
        from pyspark import TaskContext

        cols = {n: pa.array([k[i] for k, _ in found], rows_kinds[n]) for i, n in enumerate(named)}
        part = TaskContext.get().partitionId()
        return pa.RecordBatch.from_pydict({**cols, "part": pa.array([part] * len(found), pa.int32()), **{c: [float(v[i]) for _, v in found] for i, c in enumerate(("one", "zero", "won"))}})

    rows_kinds = {n: to_arrow_type(rows.schema[n].dataType) for n in named}
    parts = ranged.mapInArrow(won, ", ".join(x for x in (kinds, "part int, one double, zero double, won double") if x))
    below = F.coalesce(F.sum("zero").over(Window.partitionBy(*named).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    out = parts.withColumn("won", F.col("won") + F.col("one") * below).groupBy(*named).agg(F.try_divide(F.sum("won"), F.sum("one") * F.sum("zero")).alias("roc_auc"))
    return out.select(*(F.col(n).alias(k) for k, n in zip(keys, named, strict=True)), "roc_auc")


def classification_metrics(pred: DataFrame, keys: list[str]) -> DataFrame:
    """AUC by rank sums (ties half), accuracy, precision, recall, F, kappa, MCC, specificity; positive class 1."""
    auc = roc_auc(pred, keys)
    c = lambda y, q: F.sum(((F.col("response") == y) & (F.col("predicted") == q)).cast("double"))
    m = pred.groupBy(*keys).agg(c(1, 1).alias("tp"), c(0, 0).alias("tn"), c(0, 1).alias("fp"), c(1, 0).alias("fn"))
    tp, tn, fp, fn = (F.col(x) for x in ("tp", "tn", "fp", "fn"))
    total = tp + tn + fp + fn
    chance = ((tp + fp) * (tp + fn) + (tn + fn) * (tn + fp)) / (total * total)
    acc = (tp + tn) / total
    out = m.select(*keys, acc.alias("accuracy"), F.try_divide(tp, tp + fp).alias("precision"), F.try_divide(tp, tp + fn).alias("recall"), F.try_divide(2 * tp, 2 * tp + fp + fn).alias("f_meas"), F.try_divide(acc - chance, 1 - chance).alias("kap"), F.try_divide(tp * tn - fp * fn, F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))).alias("mcc"), F.try_divide(tn, tn + fp).alias("specificity"))
    return auc.join(out, keys) if keys else auc.crossJoin(out)


def aggregate_metrics(rows: DataFrame) -> DataFrame:
    """Mean, sd, min and max of each metric over replicates."""
    return rows.groupBy("model", "metric").agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("sd"), F.min("value").alias("min"), F.max("value").alias("max"))


def select_best(metrics: DataFrame, keys: list[str], metric: str = "roc_auc") -> DataFrame:
    """By task the model of greatest mean metric, and its best replicate; ties by name, then number."""
    rows = metrics.filter(F.col("metric") == metric)
    mean = rows.groupBy(*keys, "model").agg(F.avg("value").alias("mean"))
    best = mean.groupBy(*keys).agg(F.min_by("model", F.struct(-F.col("mean"), F.col("model"))).alias("model"), F.max("mean").alias("mean"))
    return rows.join(best, [*keys, "model"]).groupBy(*keys, "model", "mean").agg(F.min_by("replicate", F.struct(-F.col("value"), F.col("replicate"))).alias("replicate"))


def focal_lookup(selected: DataFrame, details: DataFrame) -> DataFrame:
    """Selected neighbourhood predictors of a period with the layers they name."""
    own = selected.filter(F.contains("predictor", F.lit("nhood")))
    return own.join(details, (F.contains("predictor", F.col("layer"))) & (own["period"] == details["layer_period"])).select("period", "predictor", "layer", "matrix_id").distinct()


def model_lookup(files: DataFrame, transitions: DataFrame) -> DataFrame:
    """(file, region, from_v, to_v, transition_id) of model files named region.from-to.ext, without persistence."""
    t = F.split_part("file", F.lit("."), F.lit(2))
    rows = files.select("file", F.split_part("file", F.lit("."), F.lit(1)).alias("region_name"), F.split_part(t, F.lit("-"), F.lit(1)).try_cast("int").alias("from_v"), F.split_part(t, F.lit("-"), F.lit(2)).try_cast("int").alias("to_v"))
    return rows.filter("from_v <> to_v").join(transitions, ["from_v", "to_v"], "left")


def load_predictors(static: DataFrame, dynamic: DataFrame, names: list[str], region: int, scenario: str, period: str) -> DataFrame:
    """Static and dynamic predictors of a region, scenario and period by cell; columns come from whichever table has them."""
    s = static.filter(F.col("region") == region).select("cell_id", *(c for c in names if c in static.columns))
    d = dynamic.filter((F.col("region") == region) & (F.col("scenario") == scenario) & (F.col("period") == period)).select("cell_id", *(c for c in names if c in dynamic.columns and c not in static.columns))
    return s.join(d, "cell_id", "full")
