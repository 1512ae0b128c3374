"""Texts with very many secrets, and licence templates of any script."""

import random
import re
import string
import time

from pyspark.sql import functions as F

from landweave.llm import op6_secrets as op6
from landweave.llm import op8_licenses as op8


def test_one_text_of_very_many_matches(spark):
    """Time grows little more than the matches do; spans and marks are those of a plain loop."""
    rnd, took = random.Random(9), {}
    find = lambda df: op6.find_secrets(df).select("doc_id", "spans", op6.redacted(F.col("text"), F.col("spans")).alias("clean"))
    pieces = lambda n: " ".join(x for k in range(n) for x in (f"token={k:08d}", "".join(rnd.choices(string.ascii_letters + string.digits, k=30)), "é"))
    for n in (200, 2_000, 20_000):
        text = pieces(n)
        began = time.time()
        r = find(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
        took[n] = time.time() - began
        fixed = [(m.start(), m.end()) for m in re.finditer(op6.ASSIGN, text)]
        assert [(s["start"], s["end"]) for s in r["spans"] if s["kind"] == 0] == fixed
        out, at = [], 0
        for s in sorted((s["start"], s["end"]) for s in r["spans"]):
            if s[0] > at or not out:
                out.append(text[at : s[0]])
            at = max(at, s[1])
        assert r["clean"] == "<secret>".join([*out, text[at:]])
        assert sum(s["kind"] == 3 for s in r["spans"]) > 0.8 * n
    assert took[20_000] < 30 + 25 * took[2_000], took


def test_blocks_find_what_a_plain_search_finds(spark):
    rnd = random.Random(2)
    for n in (0, 1, 40, 700):
        spans = sorted((a := rnd.randrange(5000), k, a + rnd.randint(1, 60), "x") for k in (rnd.randrange(3) for _ in range(n)))
        asked = [(a := rnd.randrange(5000), 3, a + 30, "y" * 30) for _ in range(60)]
        df = spark.createDataFrame([(spans, asked)], f"spans {op6.SPANS}, asked {op6.SPANS}")
        b = op6.in_blocks(F.col("spans"))
        got = df.select(F.transform("asked", lambda c: op6.inside(c, b)).alias("i"), F.transform("asked", lambda c: op6.outside(c, b)).alias("o")).first()
        for c, i, o in zip(asked, got["i"], got["o"], strict=True):
            assert i == any(s[0] <= c[0] and c[2] <= s[2] for s in spans)
            free = [p for p in range(c[0], c[2]) if not any(s[0] <= p < s[2] for s in spans)]
            assert [p for x in o for p in range(x["start"], x["end"])] == free and all(len(x["value"]) == x["end"] - x["start"] for x in o)


def test_templates_in_any_script(spark):
    texts = {"fr": "Ce logiciel est distribué sous la licence publique générale étendue, sans aucune garantie", "de": "Veröffentlicht unter der Größten Öffentlichen Lizenz für Übungen", "zh": "本 软件 按 原样 提供 不 附带 任何 担保", "ru": "Эта программа распространяется на условиях лицензии без гарантий"}
    table = spark.createDataFrame(list(texts.items()), "name string, text string")
    docs = [(k, t) for k, t in enumerate(texts.values())] + [(10 + k, f"Une page. {t}\nEt la suite d'un texte.") for k, t in enumerate(texts.values())] + [(20, "Ce texte est libre"), (21, None)]
    got = {r["doc_id"]: r["license"] for r in op8.find_licenses(spark.createDataFrame(docs, "doc_id long, text string"), table).collect()}
    assert [got[k] for k in range(4)] == list(texts) and [got[10 + k] for k in range(4)] == list(texts) and got[20] is None and got[21] is None
