"""Quality rules as a short-circuit cascade, with DataFrame operations only.

Measures of a whole text become rules; each rule's cost and rejection rate are estimated on a sample, and
rules run by rejection per cost, so a text leaves at its first failing rule. The order changes the time,
never the verdict.

Two measures (lines with words, words with letters) serve rules alone: they are computed only for texts that
no earlier rule has rejected.

Defined results: null or empty text has no words and fails; repeated rows are judged alike; very long texts
are measured whole; an empty table gives no rows; other columns are not read, or pass through where
documents are asked for, but for those that judge names itself (measures, base_failed, kept), which it replaces.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landweave.llm.common import WORD, table

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Rule:
    """A document fails where fails (of the measures' columns) holds; null counts as passing."""

    name: str
    fails: Callable[[dict[str, Column]], Column]


#: The two base rules come with the task; the others are mild, for texts that are hardly prose at all.
BASE = (
    Rule("few_words", lambda m: m["n_words"] < 50),
    Rule("repeats", lambda m: m["n_repeat_words"] * 100 > m["n_words"] * 50),
)
MILD = (
    Rule("symbols", lambda m: m["n_symbols"] > m["n_words"] * 2),
    Rule("word_length", lambda m: (m["word_chars"] > m["n_words"] * 25) | (m["word_chars"] < m["n_words"] * 2)),
    Rule("dup_lines", lambda m: (m["n_dup_lines"] >= 4) & (m["n_dup_lines"] * 10 > m["n_lines"] * 8)),
    Rule("letters", lambda m: m["n_letter_words"] * 2 < m["n_words"]),
)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value computed once, however often use refers to it and wherever the optimizer moves it."""
    return F.transform(F.array(value), use)[0]


def steps(x: Column, f: Callable[[Column, Column], Column]) -> Column:
    """f of all neighbours in an array."""
    n = F.greatest(F.size(x) - 1, F.lit(0))
    return F.zip_with(F.slice(x, 1, n), F.slice(x, 2, n), f)


def windows_sorted(words: Column) -> Column:
    """(hash, place) of all 3-word windows, sorted: equal windows stand side by side. Hashes have 64 bits and meet within one text only."""
    n = F.greatest(F.size(words) - 2, F.lit(0))
    threes = F.arrays_zip(*(F.slice(words, k, n).alias(c) for k, c in enumerate("abc", 1)))
    return F.sort_array(F.transform(threes, lambda w, i: F.struct(F.xxhash64(w["a"], w["b"], w["c"]).alias("h"), i.alias("i"))))


def repeat_places(windows: Column) -> Column:
    """Places of windows found twice or more, ascending."""
    pairs = steps(windows, lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
    return F.sort_array(F.array_distinct(F.flatten(F.filter(pairs, lambda p: p.isNotNull()))))


def covered_words(places: Column) -> Column:
    """Words in 3-word windows that start at places."""
    return F.when(F.size(places) > 0, F.aggregate(steps(places, lambda a, b: F.least(b - a, F.lit(3))), F.lit(3), lambda x, y: x + y)).otherwise(0)


def rule_measures(text: Column) -> dict[str, Column]:
    """Measures that only rules ask for: lines with words, and words with a letter."""
    text = F.coalesce(text, F.lit(""))
    return {
        "n_lines": F.regexp_count(text, F.lit(r"(?dm)^[\x20\t\x0b\f\r]*[^\x20\x09-\x0D]")).cast("long"),
        "n_letter_words": F.regexp_count(text, F.lit(r"\p{L}[^\x20\x09-\x0D]*")).cast("long"),
    }


def measures(text: Column) -> dict[str, Column]:
    """Each measure as an expression of its own, so that a rule computes no other."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD))
    return {
        "n_words": F.regexp_count(text, F.lit(WORD)).cast("long"),
        "word_chars": F.char_length(F.translate(text, BLANKS, "")).cast("long"),
        "n_symbols": (F.char_length(text) - F.char_length(F.translate(text, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": bound(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": bound(F.regexp_extract_all(text, F.lit(WORD), 0), lambda w: bound(windows_sorted(w), lambda s: bound(repeat_places(s), covered_words))).cast("long"),
    }


def clock() -> Column:
    """The executor's clock in nanoseconds, read anew for each row wherever it stands."""
    return F.reflect(F.lit("java.lang.System"), F.lit("nanoTime")).cast("long")


def asked(rule: Rule, by: dict[str, Column]) -> set[str]:
    """Names of the measures that a rule looks at."""
    seen: set[str] = set()

    class Noting(dict):
        def __getitem__(self, name: str) -> Column:
            seen.add(name)
            return super().__getitem__(name)

    rule.fails(Noting(by))
    return seen


def rule_estimates(docs: DataFrame, rules: tuple[Rule, ...], ready: tuple[str, ...] = (), sample_rows: int = 1000, seed: int = 5, runs: int = 2) -> list[tuple[float, float, Rule]]:
    """(nanoseconds, share rejected, rule) a document, from one pass over about sample_rows documents (at most twice as many).

    Every sampled row takes the clock before and after each measure, so all measures are timed side by side in
    the same tasks and what else runs slows all alike. A rule costs what the measures it asks for cost, but for
    those that are ready at hand; of some runs over the sample the cheapest counts. The sample serves these
    estimates alone. An empty table gives no estimates.
    """
    n = docs.count()
    if not n:
        return []
    by = all_measures(F.col("text"))
    place = {name: 2 * i + 3 for i, name in enumerate(by)}
    sample = docs.select("text").sample(min(1.0, 1.2 * sample_rows / n), seed).limit(2 * sample_rows).repartition(docs.sparkSession.sparkContext.defaultParallelism)
    # an array keeps clock and measures in this order; the first interval holds the clock alone
    timed = F.array(clock(), F.lit(0).cast("long"), clock(), *(x for c in by.values() for x in (c, clock())))
    rows = sample.select("text", F.explode(F.sequence(F.lit(1), F.lit(runs))).alias("run")).select("run", timed.alias("m"))
    took = lambda at: F.sum(F.col("m")[at + 1] - F.col("m")[at - 1])
    got = {name: F.col("m")[at] for name, at in place.items()}
    rejected = [F.sum(failing(rule, got).cast("long")).alias(f"r{i}") for i, rule in enumerate(rules)]
    seen = rows.groupBy("run").agg(F.count("*").alias("n"), took(1).alias("none"), *(took(at).alias(f"t_{name}") for name, at in place.items()), *rejected).collect()
    if not seen:
        return [(1.0, 0.0, rule) for rule in rules]
    cost = {name: max(min((r[f"t_{name}"] - r["none"]) / r["n"] for r in seen), 1.0) for name in by}
    return [(sum((cost[x] for x in asked(rule, by) - set(ready)), 1.0), seen[0][f"r{i}"] / seen[0]["n"], rule) for i, rule in enumerate(rules)]


def cascade_order(docs: DataFrame, rules: tuple[Rule, ...], ready: tuple[str, ...] = ()) -> list[Rule]:
    """rules by rejections per nanosecond, estimated on a sample; those that reject none of it go last, cheapest first."""
    scored = sorted(rule_estimates(docs, rules, ready), key=lambda x: (-x[1] / x[0], x[0], x[2].name))
    return [rule for *_, rule in scored] or list(rules)


def all_measures(text: Column) -> dict[str, Column]:
    return {**measures(text), **rule_measures(text)}


def failing(rule: Rule, by: dict[str, Column]) -> Column:
    return F.coalesce(rule.fails(by), F.lit(False))


def verdict(order: list[Rule], by: dict[str, Column]) -> Column:
    """True where no rule fails; once one fails, the later ones aren't computed."""
    kept = F.lit(True)
    for rule in reversed(order):
        kept = F.when(failing(rule, by), F.lit(False)).otherwise(kept)
    return kept


def judge(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MILD) -> DataFrame:
    """docs with the five base measures, base_failed and kept; docs needs a text column."""
    made = measures(F.col("text"))
    by = {**{k: F.col(k) for k in made}, **rule_measures(F.col("text"))}
    order = cascade_order(docs, rules, ready=tuple(made))
    base = failing(BASE[0], by) | failing(BASE[1], by)
    clash = [c for c in (*made, "base_failed", "kept") if c in docs.columns]
    return docs.drop(*clash).withColumns(made).withColumn("base_failed", base).withColumn("kept", ~F.col("base_failed") & verdict(order, by))


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MILD) -> DataFrame:
    """The documents that pass all rules, with the columns they had; each leaves at its first failing rule."""
    order, by = cascade_order(docs, rules, ready=("n_words",)), all_measures(F.col("text"))
    # nearly all rules compare with the number of words: it is counted once
    return docs.filter(bound(by["n_words"], lambda n: verdict(order, {**by, "n_words": n})))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


#: The base columns alone: the rules beyond them are ours, with the thresholds of MILD.
SQL = r"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents),
t AS (SELECT doc_id, unnest(range(1, len(words) - 1)) AS i, words FROM w),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i], words[i + 1], words[i + 2]) AS n FROM t),
r AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM g, (SELECT unnest([0, 1, 2]) AS k) WHERE g.n > 1 GROUP BY doc_id),
m AS (
  SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
    len(lines) AS n_lines, len(list_filter(words, lambda x: regexp_matches(x, '\p{L}'))) AS n_letter_words
  FROM w LEFT JOIN r ON r.doc_id = w.doc_id)
SELECT * EXCLUDE (n_lines, n_letter_words), n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR n_symbols > n_words * 2 OR word_chars > n_words * 25
    OR word_chars < n_words * 2 OR (n_dup_lines >= 4 AND n_dup_lines * 10 > n_lines * 8) OR n_letter_words * 2 < n_words) AS kept
FROM m
"""
