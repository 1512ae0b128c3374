"""Toxicity on planted words, whitening against exact fractions, and the manifest against hashlib."""

import hashlib
import math
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from helpers import SF
from pyspark.sql import functions as F

from landweave.llm import op11_toxicity as op11
from landweave.llm import op12_whitening as op12
from landweave.llm import op13_merkle as op13
from landweave.llm import sha256
from landweave.llm.common import saved


def prose(rnd, n):
    words = "alpha Beta gamma, delta. eps zeta eta theta iota kappa été naïve of the".split()
    return " ".join(rnd.choice(words) + (str(rnd.randint(0, 300)) if rnd.random() < 0.6 else "") for _ in range(n))


# toxicity


@pytest.fixture(scope="module")
def judged(spark):
    """2,000 texts, a fifth toxic; a third of the toxic ones known, some near copies; clean ones share rare words too."""
    rnd = random.Random(5)
    bad = ["blorg", "snivel", "krutz", "wretch", "gromp"]
    rows, truth = [], {}
    for i in range(2000):
        text = prose(rnd, rnd.randint(5, 80))
        if i % 5 == 0:
            words = text.split(" ")
            for w in rnd.sample(bad, rnd.randint(1, 4)):
                words.insert(rnd.randrange(len(words)), rnd.choice([w, w.upper() + "!!", w + ","]))
            text = " ".join(words)
        truth[i] = int(i % 5 == 0)
        rows.append((i, text))
    copied = rows[0][1] + " zzyzx"
    rows += [(5000 + k, copied) for k in range(60)]
    truth |= {5000 + k: 1 for k in range(60)}
    labels = [(i, t) for i, t in truth.items() if i % 3 == 0]
    docs = saved(spark.createDataFrame(rows, "doc_id long, text string"), "judged")
    return docs, spark.createDataFrame(labels, "doc_id long, toxic int"), truth


def test_toxic_texts_are_found_and_clean_ones_left(judged):
    docs, labels, truth = judged
    got = {r["doc_id"]: r for r in op11.score_toxicity(docs, labels.filter(~op11.held_out(F.col("doc_id")))).collect()}
    assert len(got) == len(truth) and all(0 <= r["score"] <= 1 for r in got.values())
    wrong = [i for i, t in truth.items() if (got[i]["score"] >= 0.5) != (t == 1)]
    assert len(wrong) <= 0.01 * len(truth), [(i, truth[i], got[i]["words"]) for i in wrong][:5]
    # near copies count once, so a word of theirs alone tells nothing
    assert "zzyzx" not in {w for r in got.values() for w in r["words"]}


def test_held_out_accuracy(spark):
    sf = SF.replace("0.001", "0.1")
    got = op11.op11_toxicity(spark, sf)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    both = got.join(spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic"), "doc_id").filter("held_out").groupBy("toxic", "predicted").count().collect()
    n = {(r["toxic"], r["predicted"]): r["count"] for r in both}
    tp, fp, fn, tn = n.get((1, 1), 0), n.get((0, 1), 0), n.get((1, 0), 0), n.get((0, 0), 0)
    assert tp / (tp + fn) >= 0.8 and tp / (tp + fp) >= 0.95 and (tp + tn) / (tp + fp + fn + tn) >= 0.97
    ids = got.select("doc_id", "held_out").collect()
    assert all((zlib.crc32(str(r[0]).encode()) % 5 == 0) == r[1] for r in ids)


def test_toxicity_of_odd_rows(spark, odd, odd_rows, empty):
    labels = spark.createDataFrame([(10, 1), (10, 0), (3, None), (None, 1), (99999, 1), (60, 0)], "doc_id long, toxic int")
    got = op11.score_toxicity(odd, labels).collect()
    assert len(got) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in got)
    score = {r["doc_id"]: r["score"] for r in got}
    assert score[0] == score[1] == score[2] and len({score[10 + k] for k in range(6)}) == 1
    assert op11.score_toxicity(empty, labels).count() == 0
    none = op11.score_toxicity(odd, labels.filter("doc_id < 0")).collect()
    assert {r["score"] for r in none} == {0.25}
    odd_ids = spark.createDataFrame([(None, "x"), ("b", None)], "doc_id string, text string")
    assert sorted((r["doc_id"] or "") for r in op11.score_toxicity(odd_ids, labels).collect()) == ["", "b"]


def test_risk_steps_match_plain_numpy(spark):
    """The summed gradients are those over all documents one by one."""
    sets = [["a"], ["a", "b"], [], [], ["b"], ["a"]]
    df = spark.createDataFrame([(s,) for s in sets], "words array<string>").groupBy("words").agg(F.count("*").alias("n"))
    model = op11.Model(["a", "b"], np.array([[1.0, -2.0, 0.5], [0.0, 3.0, -1.0]]))
    x = model.rows(sets)
    z = x @ model.weights.T
    want = np.concatenate([(op11.sigmoid(z).T @ x), np.logaddexp(0, z).sum(axis=0)[:, None]], axis=1)
    assert np.allclose(op11.unlabelled_sums(df, model), want)


def test_shift_has_the_fewest_wrong_rows():
    rnd = np.random.default_rng(1)
    for _ in range(50):
        z, y, n = rnd.integers(-5, 6, 12).astype(float), rnd.integers(0, 2, 12).astype(float), rnd.integers(1, 4, 12).astype(float)
        c = op11.best_shift(z, y, n)
        wrong = lambda c: float((((z >= c) != (y == 1)) * n).sum())
        assert wrong(c) == min(wrong(t) for t in np.arange(-6, 7, 0.25))
    assert op11.best_shift(np.zeros(0), np.zeros(0), np.zeros(0)) == 0.0


# whitening


def brute(vs, scale, offset, k):
    x = [[math.floor(scale * c) + offset for c in v] for v in vs]
    n, d = len(x), len(x[0])
    total = [sum(r[i] for r in x) for i in range(d)]
    cov = [[Fraction(n * sum(r[i] * r[j] for r in x) - total[i] * total[j], n * n) for j in range(d)] for i in range(d)]
    values, vectors = np.linalg.eigh(np.array(cov, float))
    centred = np.array([[float(Fraction(n * r[i] - total[i], n)) for i in range(d)] for r in x])
    order = np.argsort(-values, kind="stable")[:k]
    return [sum((n * r[i] - total[i]) ** 2 for i in range(d)) for r in x], centred @ vectors[:, order] / np.sqrt(np.abs(values[order])), values[order] / np.trace(np.array(cov, float))


@pytest.mark.parametrize("scale,offset,spread", [(64.0, 1_000_000, 1.0), (64.0, -5, 1e3), (1.0, 0, 1e14), (1e6, 10**12, 1e3)])
def test_whitening_against_fractions(spark, scale, offset, spread):
    rnd = random.Random(3)
    vs = [[rnd.gauss(0, spread) * (1 + j) for j in range(7)] for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(vs)), "vec_id long, embedding array<double>")
    dev, white, share = brute(vs, scale, offset, 5)
    got = op12.whiten(df, 5, scale, offset).collect()
    assert len(got) == 300
    for r in got:
        assert int(r["deviation"]) == dev[r["vec_id"]] and r["n"] == 300
        assert np.allclose(np.abs(r["whitened"]), np.abs(white[r["vec_id"]]), rtol=1e-9, atol=1e-9)
        assert np.allclose(r["explained"], share, rtol=1e-9) and r["identity_error"] < 1e-9


def test_block_sums_are_exact():
    rnd = np.random.default_rng(2)
    for x in (rnd.integers(-5, 6, (130, 3)), rnd.integers(-(1 << 61), 1 << 61, (70, 4)), np.full((65, 2), 7), np.zeros((1, 3), np.int64)):
        s, p = op12.block_sums(x.astype(np.int64))
        o = x.astype(object)
        assert (s == o.sum(axis=0)).all() and (p == o.T @ o).all()
    values = np.array([0, -1, 1 << 100, -(1 << 100) + 12345], object)
    assert [sum(int(x[i]) << op12.LIMB_BITS * k for k, x in enumerate(op12.limbs(values))) for i in range(4)] == list(values)


def test_whitening_of_odd_vectors(spark):
    rnd = random.Random(4)
    good = [[rnd.random() for _ in range(3)] for _ in range(40)]
    rows = [(i, v, "x") for i, v in enumerate(good)] + [(None, good[0], "y"), (3, good[3], "z")]
    bad = [(100, None, ""), (101, [1.0, None, 2.0], ""), (102, [float("nan")] * 3, ""), (103, [float("inf"), 0.0, 0.0], ""), (104, [], ""), (105, [1.0, 2.0], ""), (106, [3e38, 0.0, 0.0], "")]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>, x string")
    got = op12.whiten(df, 32).collect()
    assert len(got) == 42 and sorted(len(r["whitened"]) for r in got) == [3] * 42 and max(r["identity_error"] for r in got) < 1e-9
    same = op12.whiten(spark.createDataFrame([(k, [1.0, 2.0]) for k in range(5)], "vec_id long, embedding array<float>"), 32).collect()
    assert [(int(r["deviation"]), r["whitened"], r["identity_error"]) for r in same] == [(0, [None, None], 0.0)] * 5
    flat = op12.whiten(spark.createDataFrame([(k, [float(k), float(k), 2.0]) for k in range(50)], "vec_id long, embedding array<float>"), 32).collect()
    assert all(r["whitened"][0] is not None and r["whitened"][1:] == [None, None] for r in flat) and flat[0]["identity_error"] < 1e-9
    assert op12.whiten(df.filter("vec_id < 0"), 32).count() == 0


# manifest


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def shown(*values):
    return "".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha(*out[-1][k : k + 3]) for k in range(0, len(out[-1]), 3)])
    return out


def by_hand(rows, change):
    """(doc_id, leaf, subroot, root, proof, folded root) of each row."""
    given = {}
    for r in rows:
        given.setdefault(r[3], []).append((-math.inf if r[0] is None else r[0], sha(shown(r[0], r[3], r[2], r[4], r[1])), r))
    names = sorted(given, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: (sorted(v, key=lambda x: x[:2]), levels([x[1] for x in sorted(v, key=lambda x: x[:2])])) for s, v in given.items()}
    top = levels([trees[s][1][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for place, (_, leaf, r) in enumerate(trees[s][0]):
            new = (r[0], r[3], r[2], r[4], change(r))
            now, proof = sha(shown(*new)), []
            for tree, at in ((trees[s][1], place), (top, k)):
                for level in tree[:-1]:
                    a = at - at % 3
                    kids = level[a : a + 3]
                    proof += kids[: at % 3] + kids[at % 3 + 1 :]
                    kids[at % 3] = now
                    now, at = sha(*kids), at // 3
            out.append((r[0], leaf, trees[s][1][-1][0], top[-1][0], "".join(proof), now))
    return out


def test_states_match_hashlib():
    rnd = np.random.default_rng(0)
    for n in (1, 5, sha256.LANES + 3):
        d = rnd.integers(0, 256, (3, n, 32), np.uint8)
        state = sha256.start(n)
        for count in range(4):
            got = sha256.finish(state, np.full(n, count))
            for i in (0, n - 1):
                assert got[i].tobytes().hex() == sha(*(d[c, i].tobytes().hex() for c in range(count)))
            if count < 3:
                state = sha256.absorb(state, d[count])


def tampered():
    return {"text": F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.translate("text", "\n", "")).otherwise(F.col("text"))}


def change(r):
    return r[1].replace("\n", "") if r[1] is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 else r[1]


@pytest.mark.parametrize("storey", [1, 2, 9])
def test_manifest_against_hashlib(spark, odd, odd_rows, storey):
    """Storeys of one and two levels make several storeys of a few rows."""
    rows = [*odd_rows, (None, "a\nb", None, None, None), (-5, "", "x", "", 1), (-6, "x\ny", "x", "é", 1), (-6, "x\nz", "x", "é", 1)]
    df = saved(spark.createDataFrame([(*r, "mine", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, key string, place int"), "tree-rows")
    m = op13.merkle_manifest(df, tampered(), levels=storey)
    got = [(r["doc_id"], r["leaf"], r["subroot"], m.root, r["proof"], r["folded_root"]) for r in m.rows.collect()]
    want = by_hand(rows, change)
    order = lambda rows: sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, *r[1:]))
    assert order(got) == order(want)
    assert {(r["source"], r["n_rows"]) for r in m.sources.collect()} == {(s, sum(r[3] == s for r in rows)) for s in {r[3] for r in rows}}


def test_manifest_of_one_row_none_and_hot_source(spark):
    cols = "doc_id long, text string, lang string, source string, n_chars long"
    one = op13.merkle_manifest(spark.createDataFrame([(7, "t", "en", "s", 1)], cols))
    r = one.rows.first()
    assert r["leaf"] == r["subroot"] == r["folded_root"] == one.root and r["proof"] == "" and r["steps"] == ""
    none = op13.merkle_manifest(spark.createDataFrame([], cols))
    assert none.root is None and none.rows.count() == 0 and none.sources.count() == 0
    rows = [(i, f"text {i}\n", "en", "hot" if i % 3 else f"s{i}", i) for i in range(1500)]
    m = op13.merkle_manifest(spark.createDataFrame(rows, cols).repartition(7), tampered())
    got = sorted((r["doc_id"], r["leaf"], r["subroot"], m.root, r["proof"], r["folded_root"]) for r in m.rows.collect())
    assert got == sorted(by_hand(rows, change))
