"""Toxicity by non-negative positive-unlabelled learning.

Known toxic texts are the positives, the texts of the whole corpus the unlabelled ones. With class prior pi,
the risk of a linear classifier is pi * E_pos[l(z)] + max(0, E_unl[l(-z)] - pi * E_pos[l(-z)]) with the logistic
loss l; where the second part falls below zero, a step goes back up it. Features are words, chosen by how much more
often positives hold them than the corpus does: a Chernoff bound on that excess, corrected for the number of words
looked at. Near copies among the positives count once (three least word hashes alike).

All counts and risks cover every document. A document matters to the risk only by the chosen words it holds, so
documents are counted by that set of words, and each step sums gradients over the counted sets in Spark; the
driver holds weights, the positives' sets and one sum a weight. Several classifiers leave out a part of the positives
each; a score is the logistic function of their mean. The shift of the scores, so that 0.5 is the best cut, comes
from labelled rows.

Bounds, all parameters: about max_positives positives and max_labelled labelled rows are used (by a hash of
doc_id; all of them where there are fewer), and max_features words at most.

Defined results: a null or empty text holds no words and gets the score of such texts; equal texts get equal scores;
very long texts are read whole; rows of one doc_id are scored each; a null doc_id is scored, never held out and never
labelled; of several labels of a document the greatest counts, null labels and labels without a document don't; without
positives or telling words every score is the class prior; an empty table gives no rows. Only doc_id and text are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landweave.llm.common import Scratch, table

MEMBERS = 3
STEPS, RATE, RIDGE = 25, 0.3, 1e-4
#: Share of positives that must hold a word, and how much more often than the corpus they must.
LEAST_SHARE, LEAST_LIFT = 0.02, 2.0
MAX_POSITIVES, MAX_LABELLED, MAX_FEATURES = 20_000, 200_000, 1024


def words(text: Column) -> Column:
    """The different words of a text: runs of letters and digits, in lower case."""
    return F.array_distinct(F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), ""))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def signature(found: Column) -> list[Column]:
    """Three least hashes of the words: alike for near copies, different for others."""
    return [F.array_min(F.transform(found, lambda w, s=s: F.xxhash64(F.lit(s), w))).alias(f"sig{s}") for s in range(3)]


def telling(held: np.ndarray, total: np.ndarray, n_pos: int, n_all: int, level: float = 0.01) -> np.ndarray:
    """Which words positives hold too often for chance; held: positives, total: all documents with the word.

    Were a word's documents positives at the overall rate p, held of total would be as far above with a
    probability of at most exp(-total * KL(held / total, p)).
    """
    p, a = n_pos / n_all, np.minimum(held / np.maximum(total, 1), 1.0)
    with np.errstate(divide="ignore", invalid="ignore"):
        kl = a * np.log(a / p) + np.where(a < 1, (1 - a) * np.log((1 - a) / (1 - p)), 0.0)
    return (held / n_pos > LEAST_LIFT * total / n_all) & (a > p) & (total * kl > math.log(max(len(held), 1) / level))


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


@dataclass
class Model:
    """Linear classifiers over words: weights has a row a member and the intercept in the last column."""

    features: list[str]
    weights: np.ndarray
    shift: float = 0.0
    at: dict[str, int] = field(init=False)

    def __post_init__(self) -> None:
        self.at = {w: i for i, w in enumerate(self.features)}

    def rows(self, sets: list[list[str]]) -> np.ndarray:
        x = np.zeros((len(sets), len(self.features) + 1))
        x[:, -1] = 1
        for i, found in enumerate(sets):
            x[i, [self.at[w] for w in found]] = 1
        return x

    def logits(self, sets: list[list[str]]) -> np.ndarray:
        return (self.rows(sets) @ self.weights.T).mean(axis=1) - self.shift

    def scores(self, sets: list[list[str]]) -> np.ndarray:
        return sigmoid(self.logits(sets))


def unlabelled_sums(counted: DataFrame, model: Model) -> np.ndarray:
    """For each member the sum over all documents of l(-z) (last column) and of its gradient (the others)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(model.weights), model.weights.shape[1] + 1))
        for batch in batches:
            x, n = model.rows(batch.column(0).to_pylist()), batch.column(1).to_numpy()
            z = x @ model.weights.T
            total[:, :-1] += (sigmoid(z) * n[:, None]).T @ x
            total[:, -1] += n @ np.logaddexp(0, z)
        member, place = np.nonzero(total)
        yield pa.RecordBatch.from_pydict({"member": member, "place": place, "value": total[member, place]})

    found = counted.mapInArrow(run, "member long, place long, value double").groupBy("member", "place").agg(F.sum("value").alias("value"))
    out = np.zeros((len(model.weights), model.weights.shape[1] + 1))
    for r in found.collect():
        out[r["member"], r["place"]] = r["value"]
    return out


def train(counted: DataFrame, n_all: int, positives: list[list[str]], features: list[str], prior: float, members: int = MEMBERS, steps: int = STEPS) -> Model:
    """Classifiers by the non-negative risk, by Adam steps; member m leaves out every members-th positive, from the m-th."""
    model = Model(features, np.full((members, len(features) + 1), 2.0))
    model.weights[:, -1] = math.log(prior / (1 - prior)) - 1
    x = model.rows(positives)
    part = np.arange(len(x)) % members
    use = [x[(part != m) | (len(x) < 2 * members)] for m in range(members)]
    first, second = np.zeros_like(model.weights), np.zeros_like(model.weights)
    ridge = RIDGE * np.r_[np.ones(len(features)), 0.0]
    for step in range(1, steps + 1):
        sums = unlabelled_sums(counted, model) / n_all
        for m, own in enumerate(use):
            z = own @ model.weights[m]
            right, wrong = -(sigmoid(-z)[:, None] * own).mean(axis=0), (sigmoid(z)[:, None] * own).mean(axis=0)
            rest = sums[m, -1] - prior * np.logaddexp(0, z).mean()
            slope = sums[m, :-1] - prior * wrong
            g = (prior * right + slope if rest >= 0 else -slope) + ridge * model.weights[m]
            first[m], second[m] = 0.8 * first[m] + 0.2 * g, 0.99 * second[m] + 0.01 * g * g
            model.weights[m] -= RATE * (first[m] / (1 - 0.8**step)) / (np.sqrt(second[m] / (1 - 0.99**step)) + 1e-8)
    return model


def best_shift(logits: np.ndarray, toxic: np.ndarray, n: np.ndarray) -> float:
    """The cut between logits with the fewest wrong rows; of equal ones that nearest to 0."""
    if not len(logits):
        return 0.0
    order = np.argsort(logits, kind="stable")
    z, pos, neg = logits[order], np.cumsum((toxic * n)[order]), np.cumsum(((1 - toxic) * n)[order])
    ends = np.flatnonzero(np.diff(z) > 1e-9)
    cuts = np.r_[z[0] - 1, (z[ends] + z[ends + 1]) / 2, z[-1] + 1, 0.0]
    at = np.searchsorted(z, cuts)
    below = lambda c: np.r_[0, c][at]
    wrong = below(pos) + neg[-1] - below(neg)
    return float(cuts[np.lexsort((np.abs(cuts), wrong))[0]])


def sampled(df: DataFrame, n: int, most: int) -> DataFrame:
    """About most of df's n rows, by a hash of doc_id; all if there are fewer."""
    return df if n <= most else df.filter(F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(1 << 30)) < int(most / n * (1 << 30)))


def score_toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_positives: int = MAX_POSITIVES, max_labelled: int = MAX_LABELLED, max_features: int = MAX_FEATURES, members: int = MEMBERS, steps: int = STEPS
) -> DataFrame:
    """doc_id, words (telling words that the text holds) and score for every row of docs; labels: doc_id and toxic (0 or 1) of rows to learn from."""
    work = Scratch(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    known = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast(kind).alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    known = work.saved(known.filter("toxic IN (0, 1)"), "labels")
    n_known, n_toxic = known.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    prior = (n_toxic + 0.5) / (n_known + 2)

    chosen = sampled(known.filter("toxic = 1"), n_toxic, max_positives).select("doc_id")
    # about max_positives ids at most, so that texts stay where they are
    held = texts.join(F.broadcast(chosen), "doc_id", "left_semi").select("doc_id", words(F.col("text")).alias("words"))
    sig = signature(F.col("words"))
    one = held.select("doc_id", "words", *sig).groupBy("sig0", "sig1", "sig2").agg(F.min_by("words", F.struct("doc_id", F.xxhash64("words"))).alias("words"))
    positives = work.saved(one.select("words"), "positives")
    n_pos = positives.count()
    # at most mean words a positive / LEAST_SHARE candidates, so that sending them to all tasks is bounded
    candidates = work.saved(positives.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("held")).filter(F.col("held") >= max(2, LEAST_SHARE * n_pos)), "candidates")
    everywhere = texts.select(F.explode(words(F.col("text"))).alias("word")).join(F.broadcast(candidates), "word").groupBy("word", "held").agg(F.count("*").alias("total")).orderBy("word").collect()
    n_all = texts.count()
    features: list[str] = []
    if everywhere:
        held_n, total_n = (np.array([r[c] for r in everywhere], float) for c in ("held", "total"))
        good = np.flatnonzero(telling(held_n, total_n, n_pos, n_all))
        features = [everywhere[i]["word"] for i in good[np.argsort(-(held_n / n_pos - total_n / n_all)[good], kind="stable")][:max_features]]

    pick = lambda c: F.sort_array(F.array_intersect(c, F.array(*map(F.lit, features)).cast("array<string>")))
    sets = work.saved(texts.select("doc_id", pick(words(F.col("text"))).alias("words")), "word-sets")
    if features:
        counted = work.saved(sets.groupBy("words").agg(F.count("*").alias("n")), "counted")
        model = train(counted, n_all, [r[0] for r in positives.select(pick(F.col("words")).alias("words")).orderBy("words").collect()], features, prior, members, steps)
        judged = sets.join(sampled(known, n_known, max_labelled), "doc_id").groupBy("words", "toxic").agg(F.count("*").alias("n")).collect()
        model.shift = best_shift(model.logits([r["words"] for r in judged]), np.array([r["toxic"] for r in judged], float), np.array([r["n"] for r in judged], float))
        work.drop("counted")
    else:
        model = Model([], np.full((1, 1), math.log(prior / (1 - prior))))
    work.drop("labels", "positives", "candidates")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.scores(batch.column(1).to_pylist()))], names=["doc_id", "words", "score"])

    return sets.mapInArrow(run, f"doc_id {kind}, words array<string>, score double")


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    found = score_toxicity(table(spark, sf_dir, "documents"), labels.filter(~held_out(F.col("doc_id"))))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
