"""Each operator against SQL on the smallest tables and against brute force on the odd rows."""

import hashlib
import math
import re
import zlib
from collections import Counter
from fractions import Fraction

import pytest
from helpers import SF, rows_of
from pyspark.sql import functions as F

from landweave.llm import op1_url_filter as op1
from landweave.llm import op2_topk as op2
from landweave.llm import op3_mixing as op3
from landweave.llm import op4_quality as op4
from landweave.llm import op5_packing as op5
from landweave.llm import op6_secrets as op6
from landweave.llm import op7_token_files as op7
from landweave.llm import op8_licenses as op8
from landweave.llm import op9_jaccard as op9
from landweave.llm import op10_substrings as op10
from landweave.llm.common import scratch
from landweave.llm.registry import ORACLES, QUERIES
from landweave.llm.tokens import vocabulary

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, oracle, name):
    assert rows_of(QUERIES[name](spark, SF).toPandas()) == rows_of(oracle.execute(ORACLES[name]).df())


def tokenizer(name):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary(name))


def crc(ids):
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))


def test_url_rules_and_reputation(spark):
    urls = ["https://A.Example.NET/en/x?q", "http://example.net", "http://x.net/en/", "ftp://org/fr/1#t", "//none", None, "http://bad.example.org/p", "http://good.example.org/p", "http://example.com/de/a"]
    urls += ["http://bad.example.org/%d" % k for k in range(40)] + ["http://good.example.org/%d" % k for k in range(40)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    outcomes = pages.select("page_id", F.when(F.contains("url", F.lit("bad.")), 0).when(F.contains("url", F.lit("good.")), 1).alias("good"))
    got = {r["page_id"]: r for r in op1.filter_urls(pages, outcomes).collect()}
    assert len(got) == len(urls)
    assert [got[k]["rule"] for k in range(9)] == ["example.net/en/", None, "net/", "org/fr/", None, None, None, None, "example.com/de/"]
    assert [got[k]["verdict"] for k in range(9)] == ["allow", "allow", "block", "allow", "allow", "allow", "block", "allow", "block"]
    assert (got[0]["host"], got[0]["path"], got[5]["host"], got[5]["path"]) == ("a.example.net", "/en/x", "", "")
    assert op1.filter_urls(pages.filter("page_id < 0"), outcomes).count() == 0


def test_topk_ties_bad_vectors_and_lengths(spark):
    vs = [(i, [float((i * 7 + j) % 5) / 4 for j in range(6)]) for i in range(60)] + [(200, None), (201, [1.0, None] * 3), (202, [float("nan")] * 6), (203, []), (300, [0.5] * 4), (400, [0.5] * 4)]
    got = op2.topk(spark.createDataFrame(vs, "vec_id long, embedding array<float>"), F.col("vec_id") % 20 == 0, k=5, block_bytes=16 * 48, query_bytes=2 * 48).collect()
    good = {i: [math.floor(1024 * x) for x in v] for i, v in vs if v and all(x is not None and x == x for x in v)}
    want = []
    for q in (i for i in good if i % 20 == 0):
        s = sorted((-sum(a * b for a, b in zip(good[q], v, strict=True)), i) for i, v in good.items() if i != q and len(v) == len(good[q]))
        want += [(q, k + 1, i, -x) for k, (x, i) in enumerate(s[:5])]
    assert sorted(map(tuple, got)) == sorted(want)


def test_topk_does_not_prune_near_ties():
    import numpy as np

    rnd = np.random.default_rng(0)
    x = rnd.integers(-2000, 2000, (500, 33))
    x[100:200] = x[0]
    ids = np.arange(500)
    known = np.full(9, np.iinfo(np.int64).min)
    for (at, score), q in zip(op2.block_topk(op2.Block(ids[:9], x[:9]), slice(0, 9), op2.Block(ids, x), 10, known), range(9), strict=True):
        s = x @ x[q]
        want = sorted((-int(s[i]), int(i)) for i in ids if i != q)[:10]
        assert list(zip((-score).tolist(), ids[at].tolist(), strict=True)) == want


def water(sizes, weights, total, epochs):
    """Brute force by bisection on the level."""
    low, high = 0.0, 1e9
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if sum(min(epochs * s, mid * w) for s, w in zip(sizes, weights, strict=True)) < total else (low, mid)
    return [min(epochs * s, high * w) for s, w in zip(sizes, weights, strict=True)]


def test_mixing_targets_and_takes(spark, odd, odd_rows, empty):
    got = op3.mixed_sizes(odd).collect()
    size = lambda t: len(WORD.findall(t or ""))
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((r[0], size(r[1])) for r in odd_rows)
    names = sorted({r[3] for r in odd_rows if r[3]}) + [None]
    total = [sum(size(r[1]) for r in odd_rows if r[3] == n) for n in names]
    want = dict(zip(names, water(total, [(5, 2, 1)[k % 3] for k in range(len(names))], 1.5 * sum(total), 2), strict=True))
    assert all(abs(r["target"] - want[r["source"]]) < 1e-6 for r in got) and all(0 <= r["times"] <= 2 for r in got)
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, op3.mixed_sizes(odd).collect()), key=str)
    docs = spark.createDataFrame([(i, "w " * (1 + i % 9), "ab"[i % 2]) for i in range(4000)], "doc_id long, text string, source string")
    for r in op3.mixed_sizes(docs, weights=(3, 1)).groupBy("source", "target").agg(F.sum(F.col("size") * F.col("times")).alias("taken")).collect():
        assert abs(r["taken"] - r["target"]) < 0.01 * r["target"] + 20
    assert op3.mixed_sizes(empty).count() == 0 and op3.mixed_documents(empty).columns == empty.columns


def repeats(words):
    n = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    return len({i + k for i in range(len(words) - 2) if n[tuple(words[i : i + 3])] > 1 for k in range(3)})


def test_quality_measures(odd, odd_rows, empty):
    got = Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in op4.judge(odd).collect())
    want = Counter()
    for r in odd_rows:
        t = r[1] or ""
        w, lines = WORD.findall(t), [x for x in t.split("\n") if WORD.search(x)]
        rep = repeats(w)
        want[(r[0], len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), rep, len(w) < 50 or 100 * rep > 50 * len(w))] += 1
    assert got == want
    assert op4.judge(empty).count() == 0
    kept = [r["doc_id"] for r in op4.judge(odd).filter("kept").collect()]
    assert sorted(kept) == sorted(r["doc_id"] for r in op4.keep_good(odd).collect()) and op4.keep_good(odd).columns == odd.columns


def test_reduction_keeps_the_optimum():
    import random

    def best(items, cap):
        top = [(99, 0)] * (1 << len(items))
        top[0] = (1, 0)
        for m in range(1, len(top)):
            for i, s in enumerate(items):
                if m >> i & 1:
                    k, f = top[m ^ (1 << i)]
                    top[m] = min(top[m], (k, f + s) if f + s <= cap else (k + 1, s))
        return top[-1][0]

    rnd = random.Random(4)
    for _ in range(60):
        cap, items = rnd.choice([10, 20, 37]), [rnd.randint(1, 10) for _ in range(rnd.randint(1, 8))]
        fixed, left = op5.reduce_dominated(dict(Counter(items)), cap)
        rest = [s for s, n in left.items() for _ in range(n)]
        assert sum(n for _, n in fixed) + (best(rest, cap) if rest else 0) == best(items, cap)


def test_packing_places_every_piece_once(odd, odd_rows, empty):
    t = tokenizer("byte_bpe_50k.json")
    pieces = op5.token_pieces(odd, vocabulary("byte_bpe_50k.json"), 512)
    got = op5.pack(pieces, 512).collect()
    want, short = Counter(), 0
    for r in odd_rows:
        ids = t.encode(r[1] or "", add_special_tokens=False).ids + [0]
        first = len(ids) - 512 * (-(-len(ids) // 512) - 1)
        cuts = [0, *range(first, len(ids) + 1, 512)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            want[(r[0], k, a, b - a, crc(ids[a:b]))] += 1
            short += b - a
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    bins = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in bins.values():
        at = 0
        for a, n in sorted(spans):
            assert a == at
            at += n
        assert at <= 512
    assert len(bins) <= max(-(-short // 512), sum(r["length"] > 256 for r in got)) + 3
    assert op5.pack(op5.token_pieces(empty, vocabulary("byte_bpe_50k.json")), 2048).count() == 0


def test_secret_spans(spark, odd, odd_rows, empty):
    kinds = [("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), lambda m: len(m[2]) >= 6), ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20), ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24)]
    found = op6.find_secrets(odd)
    got = found.select("doc_id", op6.joined(F.filter("spans", lambda s: s["kind"] < 3)).alias("s")).collect()
    want = Counter()
    for r in odd_rows:
        spans = sorted((m.start(), k, m.end()) for k, (_, p, ok) in enumerate(kinds) for m in p.finditer(r[1] or "") if ok(m))
        want[(r[0], ",".join(f"{kinds[k][0]}:{a}:{b}" for a, k, b in spans))] += 1
    assert Counter(map(tuple, got)) == want
    assert op6.find_secrets(empty).count() == 0
    clean = {r["doc_id"]: r["t"] for r in found.select("doc_id", op6.redacted(F.col("text"), F.col("spans")).alias("t")).collect()}
    assert "hunter22" not in clean[63] and clean[63].startswith("pi 😀 <secret> é") and clean[3] == "one two" and clean[0] is None


def test_random_strings_are_found_and_structured_ones_are_not(spark):
    import random
    import string

    rnd = random.Random(2)
    rows = [(i, "key " + "".join(rnd.choice(string.ascii_letters + string.digits) for _ in range(48)) + " end") for i in range(60)]
    rows += [(100 + i, f"see chapter-one-of-the-old-book-of-the-sea-and-the-seven-sails-of-edition-{i} now") for i in range(60)]
    got = {r["doc_id"]: r["n"] for r in op6.find_secrets(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", F.size("spans").alias("n")).collect()}
    assert sum(got[i] for i in range(60)) >= 54 and sum(got[100 + i] for i in range(60)) == 0


PIECES = ["a", "B", "é", "İ", "ABİ", "TARİHİ", "ß", "Σ", "The", "It's", "don't", "12", "½", "ά", "日本", "한", "J\u030c", "\u0301", "🙂", "_", "--", "<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>", "|", "&&&", "\u00a0", "\u2003", "\u0085", "\x0b", "\x1c", "\x01", "\x00", "\t", "\r\n", "ª", "Ÿ"]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_codec_gives_the_ids_of_the_library(name):
    import random

    import pyarrow as pa

    from landweave.llm.tokens import Codec

    rnd, whole = random.Random(3), tokenizer(name)
    coded = Codec(vocabulary(name), memo=300)
    marks, gaps = [".", ",", "!", "...", ".,", "'", "'s", ")"], [" ", " ", " ", "", "\n", "\n", "  ", "\n\n", " \n", "\n ", "\t"]
    texts = ["".join(rnd.choice(PIECES) + (rnd.choice(marks) if rnd.random() < 0.3 else "") + rnd.choice(gaps) for _ in range(rnd.randint(0, 8))) for _ in range(4000)]
    texts += ["".join(rnd.choice(["word", "The", "été", "ABİ", "x"]) + rnd.choice(["", "", ".", ","]) + rnd.choice([" ", "\n"]) for _ in range(rnd.randint(0, 9))) + "end" for _ in range(4000)]
    for a in range(0, len(texts), 400):
        ids, counts = coded.encode(pa.array([*texts[a : a + 400], None]))
        assert ids.tolist() == [i for t in texts[a : a + 400] for i in whole.encode(t, add_special_tokens=False).ids]
        assert counts.tolist() == [len(whole.encode(t, add_special_tokens=False).ids) for t in texts[a : a + 400]] + [0]


def test_token_files_round_trip(spark, odd, odd_rows, empty):
    t, out = tokenizer("word_bpe_49k.json"), scratch(spark, "files")
    op7.write_token_files(odd, out, vocabulary("word_bpe_49k.json"), end_id=2, parts=3)
    got = sorted(map(tuple, op7.token_file_stats(spark, out).collect()), key=lambda r: r[1])
    at, want = 0, []
    for r in sorted(odd_rows, key=lambda r: r[0]):
        ids = t.encode(r[1] or "", add_special_tokens=False).ids + [2]
        want.append((r[0], at, len(ids), crc(ids)))
        at += len(ids)
    assert got == want
    out = scratch(spark, "files")
    assert op7.write_token_files(empty, out, vocabulary("word_bpe_49k.json"), 2) == [] and op7.token_file_stats(spark, out).count() == 0


def test_licenses(odd, empty):
    got = {r["doc_id"]: r for r in op8.find_licenses(odd, tuple(op8.Template(k, v) for k, v in op8.TEMPLATES.items())).collect()}
    assert (got[64]["license"], got[65]["license"], got[3]["license"]) == ("MIT", "CC-BY-NC-4.0", None) and got[65]["dice"] == 1.0
    assert op8.find_licenses(empty, (op8.Template("a", "a b c"),)).count() == 0


def shingles(text, k):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


FIRST_SHORT = [f"w{k}" for k in range(24)]


@pytest.mark.parametrize("ids", [(1, 2), (2, 1), (500, 600), (600, 500)])
def test_jaccard_links_where_single_shingles_are_hubs(spark, ids):
    """Nearly all shingles of two long documents also stand alone in short ones."""
    rows = [(ids[0], " ".join(FIRST_SHORT)), (ids[1], " ".join(FIRST_SHORT[:-1]))]
    rows += [(100 + i, " ".join(FIRST_SHORT[i : i + 4])) for i in range(21)]
    got = Counter(map(tuple, op9.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 4, "0.85").collect()))
    assert got == linked(rows, 4, Fraction("0.85"))


def linked(rows, k, t):
    sets = [(r[0], shingles(r[1], k)) for r in rows]
    parent = {d: d for d, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and len(x & y) >= t * len(x | y):
                p, q = sorted((find(a), find(b)))
                parent[q] = p
    return Counter((d, len(s), find(d)) for d, s in sets)


@pytest.mark.parametrize(("k", "t"), [(4, "0.85"), (5, "0.8"), (3, "0.5")])
def test_jaccard_components(odd, odd_rows, empty, k, t):
    assert Counter(map(tuple, op9.jaccard_components(odd, k, t).collect())) == linked(odd_rows, k, Fraction(t))
    if k == 4:
        assert op9.jaccard_components(empty).count() == 0


@pytest.mark.parametrize("ids", [(1, 2, 3, 4), (2, 1, 3, 4), (4, 3, 2, 1), (3, 4, 1, 2)])
def test_jaccard_links_past_shorter_hubs(spark, ids):
    w = [f"w{k}" for k in range(1, 15)]
    rows = [(d, " ".join(x)) for d, x in zip(ids, (w, w[:13], w[:8], w[5:13]), strict=True)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter(map(tuple, op9.jaccard_components(docs, 4, "0.85").collect()))
    assert got == linked(rows, 4, Fraction("0.85"))


def test_jaccard_random_excerpts(spark):
    import random

    rnd = random.Random(5)
    rows = []
    for _ in range(60):
        whole = [f"w{rnd.randint(0, 400)}" for _ in range(rnd.randint(12, 40))]
        rows += [whole, whole[: -rnd.randint(1, 2)], whole[: len(whole) // 2], whole[len(whole) // 3 :], whole[rnd.randint(1, 2) :]]
    rnd.shuffle(rows)
    rows = [(i, " ".join(x)) for i, x in enumerate(rows)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter(map(tuple, op9.jaccard_components(docs, 4, "0.85").collect())) == linked(rows, 4, Fraction("0.85"))


@pytest.mark.parametrize("size", [50, 13, 5, 2])
def test_substrings(odd, odd_rows, empty, size):
    first = {}
    for r in odd_rows:
        w = WORD.findall(r[1] or "")
        for i in range(len(w) - size + 1):
            key = tuple(w[i : i + size])
            first[key] = min(first.get(key, r[0]), r[0])
    want = Counter()
    for r in odd_rows:
        w = WORD.findall(r[1] or "")
        gone = {i + k for i in range(len(w) - size + 1) if first[tuple(w[i : i + size])] < r[0] for k in range(size)}
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        want[(r[0], len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept)] += 1
    assert Counter(map(tuple, op10.dedup_substrings(odd, size).collect())) == want
    if size == 13:
        assert op10.dedup_substrings(empty).count() == 0


def test_pipeline_stages(spark, odd, odd_rows, empty):
    import corpus_pipeline as p
    from landweave.llm.common import saved

    docs = odd.select("doc_id", "text", "lang", "source", "n_chars")
    kept = saved(p.quality(spark, docs, SF), "t")
    good = {r["doc_id"] for r in op4.judge(docs).filter("kept").collect()}
    assert {r["doc_id"] for r in kept.collect()} == good and good.isdisjoint({0, 1, 2, 3, 4})
    one = saved(p.near_duplicates(spark, kept, SF), "t")
    links = linked([r for r in odd_rows if r[0] in good], 5, Fraction("0.8"))
    assert {r["doc_id"] for r in one.collect()} == {d for d, _, c in links if d == c}
    safe = saved(p.secrets(spark, one, SF), "t")
    assert safe.columns == docs.columns and safe.count() == one.count()
    mixed = saved(p.mixing(spark, safe, SF), "t")
    assert mixed.columns == docs.columns
    packed = p.packing(spark, mixed, SF)
    assert packed.filter("piece = 0").count() == mixed.count()
    for _, stage in p.STAGES:
        assert stage(spark, saved(empty.select(docs.columns), "t"), SF).count() == 0
