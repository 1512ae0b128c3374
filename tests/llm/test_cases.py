"""Cases beside the common odd rows: brute force of single steps, planted strings, clashing names, null ids."""

import math
import random
import re
import string
import zlib
from collections import Counter

import pytest
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
from landweave.llm.common import saved, scratch
from landweave.llm.tokens import vocabulary

SUFFIXES = ("co.uk", "a.b.net")


def levels(host):
    """Suffix and domain of a host, by a list of suffixes."""
    name = re.sub(r":\d*$", "", host.rsplit("@", 1)[-1])
    labels = name.split(".")
    known = [".".join(labels[i:]) for i in range(len(labels)) if ".".join(labels[i:]) in SUFFIXES]
    suffix = known[0] if known else labels[-1]
    if re.fullmatch(r"[0-9.]+", name):
        return suffix, name
    return suffix, ".".join(labels[-(suffix.count(".") + 2) :])


def reputation(rows):
    """Posterior rate and upper bound of each host: three levels of moments and shrinkage."""
    hosts = {}
    for host, good in rows:
        n, g = hosts.get(host, (0, 0))
        hosts[host] = (n + (good is not None), g + (good or 0))

    def strength(own):
        own = [(n, g, p) for n, g, p in own if n]
        if not own:
            return 10.0
        a, b, c = (sum(f(*x) for x in own) for f in (lambda n, g, p: n * (g / n - p) ** 2, lambda n, g, p: p * (1 - p), lambda n, g, p: n * p * (1 - p)))
        return 1 / min(max((a - b) / max(c - b, 1e-9), 0.001), 0.5) - 1

    def summed(key):
        out = {}
        for host, (n, g) in hosts.items():
            a, b = out.get(key(host), (0, 0))
            out[key(host)] = (a + n, b + g)
        return out

    def shrunk(own, prior):
        k = strength([(n, g, prior(x)) for x, (n, g) in own.items()])
        return k, {x: (g + k * prior(x)) / (n + k) for x, (n, g) in own.items()}

    n, g = (sum(x[i] for x in hosts.values()) for i in (0, 1))
    root = (g + 1) / (n + 2) if n else 0.5
    _, suffix = shrunk(summed(lambda h: levels(h)[0]), lambda s: root)
    domain_of = {(s, d): None for s, d in map(levels, hosts)}
    _, domain = shrunk({x: v for x, v in summed(levels).items() if x in domain_of}, lambda x: suffix[x[0]])
    k, host = shrunk(hosts, lambda h: domain[levels(h)])
    return {h: (r, min(1.0, r + 1.645 * math.sqrt(r * (1 - r) / (hosts[h][0] + k + 1)))) for h, r in host.items()}


def test_host_reputation_against_brute_force(spark):
    rnd = random.Random(8)
    names = ["a.x.co.uk", "b.x.co.uk:8080", "u:p@b.x.co.uk:8080", "y.co.uk", "n.m.a.b.net", "one.org", "two.one.org", "10.0.0.7:80", "bad.example.com", "localhost", ""]
    rows = [(h, rnd.choice([0, 1, 1, None]) if h != "bad.example.com" else 0) for _ in range(60) for h in names]
    got = op1.host_reputation(spark.createDataFrame(rows, "host string, good int"), suffixes=spark.createDataFrame([(s,) for s in SUFFIXES], "suffix string")).collect()
    want = reputation(rows)
    assert {r["host"] for r in got} == set(names)
    for r in got:
        assert abs(r["rate"] - want[r["host"]][0]) < 1e-9 and abs(r["bound"] - want[r["host"]][1]) < 1e-9
    assert want["bad.example.com"][1] < 0.5
    assert op1.host_reputation(spark.createDataFrame([], "host string, good int")).count() == 0


def test_public_suffixes_with_wildcards_and_exceptions(spark, tmp_path):
    (tmp_path / "list.dat").write_text("// a comment\n\ncom\nuk  // not part of the rule\nco.uk\n*.ck\n!www.ck\njp\n*.kobe.jp\n!city.kobe.jp\r\n// ===BEGIN PRIVATE DOMAINS===\npages.example\n")
    known = op1.public_suffixes(spark, f"file://{tmp_path}/list.dat")
    rules = ["!city.kobe.jp", "!www.ck", "*.ck", "*.kobe.jp", "co.uk", "com", "jp", "uk"]
    assert sorted(r["suffix"] for r in known.collect()) == sorted([*rules, "pages.example"])
    assert sorted(r["suffix"] for r in op1.public_suffixes(spark, f"file://{tmp_path}/list.dat", private=False).collect()) == rules
    want = {
        "a.b.co.uk:80": ("co.uk", "b.co.uk"), "b.uk": ("uk", "b.uk"), "co.uk": ("co.uk", "co.uk"), "www.ck": ("ck", "www.ck"), "a.www.ck": ("ck", "www.ck"),
        "x.y.test.ck": ("test.ck", "y.test.ck"), "ck": ("ck", "ck"), "a.b.c.kobe.jp": ("c.kobe.jp", "b.c.kobe.jp"), "z.city.kobe.jp": ("kobe.jp", "city.kobe.jp"),
        "kobe.jp": ("jp", "kobe.jp"), "u.pages.example": ("pages.example", "u.pages.example"), "un.known.zz": ("zz", "known.zz"), "1.2.3.4": ("4", "1.2.3.4"), "": ("", ""),
    }
    hosts = spark.createDataFrame([(h, 1) for h in want], "host string, v int")
    assert {r["host"]: (r["suffix"], r["domain"]) for r in op1.with_levels(hosts, known).collect()} == want


def test_url_filter_keeps_every_page(spark):
    long = "https://x.example.org/" + "p/" * 20_000
    urls = [long, long, "https://EXAMPLE.com:80/de/", "no url", "", "a://b@c.net/z"] + [f"https://hot.io/{k}" for k in range(3000)]
    pages = spark.createDataFrame([(k // 2, u, "mine", 1.0) for k, u in enumerate(urls)], "page_id long, url string, host string, rate double")
    outcomes = spark.createDataFrame([(1, 0), (1, 1), (2, None)], "page_id long, good int")
    got = op1.filter_urls(pages, outcomes)
    # a page_id with two outcome rows has both of its pages judged once for each look-up, not multiplied
    assert got.count() == len(urls) and got.filter("verdict IS NULL").count() == 0
    assert got.filter("host = 'example.com:80' AND rule IS NULL").count() == 1 and got.filter("rule = 'net/'").count() == 1


def test_topk_of_repeated_ids_and_odd_tables(spark):
    schema = "vec_id long, embedding array<float>, id string, v int, score double"
    rows = [(1, [1.0, 2.0], "x", 1, 0.5), (1, [3.0, 0.0], "x", 1, 0.5), (2, [1.0, 1.0], "x", 1, 0.5), (2, [1.0, 1.0], "x", 1, 0.5), (3, [5.0] * 3, "x", 1, 0.5), (None, [9.0, 9.0], "x", 1, 0.5)]
    df = spark.createDataFrame(rows, schema)
    got = sorted(map(tuple, op2.topk(df, F.col("vec_id") == 1, k=5).collect()))
    s = 1024 * 1024
    assert [(r[0], r[2], r[3]) for r in got] == [(1, 2, 3 * s), (1, 2, 3 * s), (1, 2, 3 * s), (1, 2, 3 * s)]
    assert op2.topk(df.limit(0), F.col("vec_id") == 1).count() == 0 and op2.topk(df, F.col("vec_id") == 77).count() == 0
    wide = spark.createDataFrame([(k, [float((k * j) % 7) for j in range(20_000)]) for k in range(6)], "vec_id long, embedding array<float>")
    assert op2.topk(wide, F.col("vec_id") == 0, k=3, block_bytes=1000).count() == 3


def test_water_fill_ends_however_many_sources(spark):
    rnd = random.Random(4)
    rows = [(f"s{k}", rnd.randint(1, 1000), float(rnd.choice([1, 2, 5, 50]))) for k in range(300)]
    total = 1.5 * sum(r[1] for r in rows)
    got = {r["source"]: r["target"] for r in op3.water_fill(spark.createDataFrame(rows, "source string, source_size long, weight double"), total, 2.0).collect()}
    low, high = 0.0, 1e9
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if sum(min(2 * s, mid * w) for _, s, w in rows) < total else (low, mid)
    assert all(abs(got[n] - min(2 * s, high * w)) < 1e-6 * total for n, s, w in rows)


def test_quality_rules_of_lines_and_letters(spark):
    good = " ".join(f"word{k}" for k in range(80))
    lines = "\n".join(["the same line of seven words again"] * 10 + ["a line of its own"])
    rows = [(1, good), (2, good + "\n" + "\n \n"), (3, " ".join(f"{k} =" for k in range(100, 160))), (4, lines), (5, None), (6, " ".join(f"word{k}" for k in range(24_000)))]
    docs = spark.createDataFrame([(*r, 9, True) for r in rows], "doc_id long, text string, n_words int, kept boolean")
    assert sorted(r["doc_id"] for r in op4.keep_good(docs).collect()) == [1, 2, 6]
    counted = docs.select("doc_id", *(c.alias(k) for k, c in op4.rule_measures(F.col("text")).items())).collect()
    word = re.compile(r"[^\x20\x09-\x0D]+")
    assert {r["doc_id"]: (r["n_lines"], r["n_letter_words"]) for r in counted} == {i: (sum(bool(word.search(x)) for x in (t or "").split("\n")), sum(any(c.isalpha() for c in w) for w in word.findall(t or ""))) for i, t in rows}
    judged = op4.judge(docs)
    assert sorted(judged.columns) == sorted(["doc_id", "text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"])


def test_quality_estimates_in_one_pass(spark):
    rows = [(k, None if k % 50 == 0 else " ".join(f"word{j}" for j in range(80)) if k % 2 else "one two three " * 40) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    rules = op4.BASE + op4.MILD
    got = {rule.name: (cost, share) for cost, share, rule in op4.rule_estimates(docs, rules, sample_rows=4000)}
    assert got["few_words"][1] == 8 / 400 and got["repeats"][1] == 192 / 400 and got["symbols"][1] == 0
    assert got["repeats"][0] > got["few_words"][0] >= 1
    ready = {rule.name: cost for cost, _, rule in op4.rule_estimates(docs, rules, ready=tuple(op4.measures(F.col("text"))))}
    assert ready["few_words"] == ready["repeats"] == ready["symbols"] == 1 < ready["letters"]
    order = [rule.name for rule in op4.cascade_order(docs, rules, ready=("n_words", "n_repeat_words"))]
    assert order[:2] == ["repeats", "few_words"] and sorted(order) == sorted(r.name for r in rules)
    assert op4.cascade_order(docs.filter("doc_id < 0"), rules) == list(rules)
    assert op4.asked(rules[1], op4.all_measures(F.col("text"))) == {"n_words", "n_repeat_words"}


def planted(rnd):
    """Random strings as keys have them, and structured ones as clean text has them."""
    draw = lambda alphabet, low, high: "".join(rnd.choice(alphabet) for _ in range(rnd.randint(low, high)))
    keys = [draw(a, 24, 64) for _ in range(300) for a in (string.ascii_letters + string.digits + "+/", string.ascii_letters + string.digits, "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")]
    part = ["alpha", "beta", "gamma", "user", "data", "index", "report", "annual", "summary", "final", "version", "north", "2023", "v2", "img", "page", "0001"]
    join = lambda sep, low, high: sep.join(rnd.choice(part) for _ in range(rnd.randint(low, high)))
    clean = [join("-", 6, 12) for _ in range(300)] + [join("/", 6, 12) for _ in range(300)] + [join("_", 6, 12) for _ in range(300)] + ["".join(rnd.choice(part).capitalize() for _ in range(rnd.randint(6, 9))) for _ in range(300)]
    return keys, [c for c in clean if len(c) >= 24]


def test_precision_of_random_spans(spark):
    keys, clean = planted(random.Random(6))
    rows = [(k, f"see {s} there") for k, s in enumerate(keys + clean)]
    found = {r["doc_id"] for r in op6.find_secrets(spark.createDataFrame(rows, "doc_id long, text string")).filter(F.size("spans") > 0).collect()}
    hits = sum(k < len(keys) for k in found)
    print("random spans: precision", round(hits / len(found), 3), "recall", round(hits / len(keys), 3), len(keys), len(clean))
    assert hits / len(found) > 0.9 and hits / len(keys) > 0.9


def test_spans_of_many_matches_and_partial_covers(spark):
    many = " ".join(f"token=abc{k:05d}" for k in range(1500))
    rnd = random.Random(1)
    tail = "".join(rnd.choice(string.ascii_letters + string.digits) for _ in range(40))
    rows = [(1, many), (2, "x " + "0123456789abcdef" * 2 + "Zq" + tail + " y")] + [(10 + k, "".join(rnd.choice(string.ascii_letters + string.digits) for _ in range(48))) for k in range(40)]
    got = {r["doc_id"]: r["spans"] for r in op6.find_secrets(spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, candidates int, spans int")).collect()}
    assert [(s["start"], s["end"]) for s in got[1]] == [m.span() for m in re.finditer(r"token=\w+", many)]
    two = [(s["kind"], s["start"], s["end"]) for s in got[2]]
    assert two[0] == (2, 2, 34) and (len(two) == 1 or two[1] == (3, 34, 2 + 32 + 42))


def test_digests_of_spans(odd, odd_rows):
    import hashlib

    kinds = [("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), lambda m: len(m[2]) >= 6), ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20), ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24)]
    want = Counter()
    for r in odd_rows:
        spans = sorted((m.start(), k, m.end()) for k, (_, p, ok) in enumerate(kinds) for m in p.finditer(r[1] or "") if ok(m))
        n = [sum(x[1] == k for x in spans) for k in range(3)]
        want[(r[0], *n, hashlib.sha256(",".join(f"{kinds[k][0]}:{a}:{b}" for a, k, b in spans).encode()).hexdigest())] += 1
    got = op6.digest(op6.find_secrets(odd, keep=["doc_id"])).collect()
    assert Counter((r["doc_id"], r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"]) for r in got) == want
    assert all(len([x for x in r["spans"].split(",") if x]) == r["n_assign"] + r["n_access"] + r["n_hex"] + r["n_random"] for r in got)


def test_licenses_inside_lines_and_whole_texts(spark):
    own = {k: op8.Template(k, v) for k, v in op8.TEMPLATES.items()}
    rows = [(1, "This project is released under the MIT License, see LICENSE."), (2, "# head\n\nMIT License Copyright 2020 someone\n\n" + op8.TEMPLATES["MIT-full"].replace(". ", ".\n\n")), (3, op8.TEMPLATES["BSD-2-Clause"]), (4, op8.TEMPLATES["BSD-3-Clause"]), (5, "code; " + op8.TEMPLATES["GPL-2.0-notice"] + " more code follows here"), (6, op8.TEMPLATES["LGPL-3.0-notice"]), (7, "the License is under the MIT"), (8, None), (9, "word " * 30_000 + "Licensed under CC BY-NC 4.0." + " word" * 10)]
    got = {r["doc_id"]: r for r in op8.find_licenses(spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, license string, m int"), tuple(own.values())).collect()}
    assert [got[k]["license"] for k in range(1, 10)] == ["MIT", "MIT-full", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0-notice", "LGPL-3.0-notice", None, None, "CC-BY-NC-4.0"]
    table = spark.createDataFrame([("mine", "you may share this text with all your friends"), ("short", "one")], "name string, text string")
    mine = op8.find_licenses(spark.createDataFrame([(1, "Note: you may share this text with all your friends, always.")], "doc_id long, text string"), table).first()
    assert mine["license"] == "mine" and mine["n_matches"] >= 1


def test_null_and_repeated_ids(spark):
    text = " ".join(f"w{k}" for k in range(40))
    docs = saved(spark.createDataFrame([(None, text), (None, text), (5, text), (5, "other words here"), (7, text + " end")], "doc_id long, text string"), "nulls")
    nine = Counter(map(tuple, op9.jaccard_components(docs, 4, "0.85").collect()))
    assert nine == Counter([(None, 37, None), (None, 37, None), (5, 37, 5), (5, 1, 5), (7, 38, 5)])
    ten = {(r["doc_id"], r["n_words"]): r["n_removed"] for r in op10.dedup_substrings(docs).collect()}
    assert ten == {(None, 40): 0, (5, 40): 40, (5, 3): 0, (7, 41): 40}
    out = scratch(spark, "files")
    op7.write_token_files(docs, out, vocabulary("word_bpe_49k.json"), 2, parts=3)
    got = sorted(op7.token_file_stats(spark, out).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [None, None, 5, 5, 7] and [r["start"] for r in got][1:] == [sum(r["n_tokens"] for r in got[:k]) for k in range(1, 5)]


def test_pipeline_stages_with_clashing_columns(spark, odd_rows):
    import corpus_pipeline as p

    extra = [(*r, "s", 5, 1.5, "k", 3) for r in odd_rows]
    docs = saved(spark.createDataFrame(extra, "doc_id long, text string, lang string, source string, n_chars long, spans string, candidates int, times double, __spans string, size int"), "clash")
    safe = saved(p.secrets(spark, docs, ""), "t")
    assert safe.columns == docs.columns
    found = op6.find_secrets(docs.select("doc_id", "text")).collect()
    want = Counter()
    for r in found:
        t, at = r["text"], 0
        out = []
        for s in r["spans"]:
            if s["start"] > at or not out:
                out.append(t[at : s["start"]])
            at = max(at, s["end"])
        want[(r["doc_id"], "<secret>".join([*out, t[at:]]) if r["spans"] else t)] += 1
    assert Counter(map(tuple, safe.select("doc_id", "text").collect())) == want
    assert {(r["candidates"], r["times"], r["__spans"], r["size"]) for r in safe.collect()} == {(5, 1.5, "k", 3)}
    assert {(r["doc_id"], r["n_chars"]) for r in safe.filter("doc_id IN (62, 63)").collect()} == {(r["doc_id"], len(r["text"])) for r in safe.filter("doc_id IN (62, 63)").collect()}

    mixed = saved(p.mixing(spark, safe, ""), "t")
    times = {(r["doc_id"], r["source"]): r["times"] for r in op3.mixed_sizes(safe).collect()}
    rows = Counter((r["doc_id"], r["source"]) for r in safe.collect())
    assert mixed.columns == docs.columns
    assert Counter((r["doc_id"], r["source"]) for r in mixed.collect()) == Counter({k: n * times[k] for k, n in rows.items() if times[k]})

    packed = p.packing(spark, mixed, "").collect()
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    want = Counter()
    for r in mixed.collect():
        ids = tok.encode(r["text"] or "", add_special_tokens=False).ids + [0]
        first = len(ids) - 2048 * (-(-len(ids) // 2048) - 1)
        cuts = [0, *range(first, len(ids) + 1, 2048)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            want[(r["doc_id"], k, a, b - a, zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids[a:b])))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in packed) == want
    spans = {}
    for r in packed:
        spans.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert all(sum(n for _, n in own) <= 2048 and sorted(own)[0][0] == 0 for own in spans.values())
    assert op5.pack(saved(spark.createDataFrame([(4, "x"), (4, "x"), (2, "y")], "length int, sequence_id string"), "t"), 4).select("length").count() == 3


@pytest.mark.parametrize("name", ["quality", "near_duplicates", "secrets", "mixing", "packing"])
def test_stages_take_empty_tables_with_any_columns(spark, name):
    import corpus_pipeline as p

    docs = saved(spark.createDataFrame([], "doc_id long, text string, source string, spans int, candidates int, chunk int, key int"), "none")
    assert getattr(p, name)(spark, docs, "").count() == 0
