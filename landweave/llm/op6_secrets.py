"""Secret scans with DataFrame operations only: fixed kinds by pattern, and random-looking strings by a test battery.

Candidates are runs of 24 and more characters of an encoding's alphabet that mix two of digits, small and
capital letters. For each, under the hypothesis that it is random over the alphabet of its inferred encoding,
three tests give p-values: chi-squared uniformity of its characters, runs above and below the middle of the
alphabet, and the lag-one serial correlation of alphabet places. Three times the least of them is the
battery's p-value. False-discovery control (Benjamini-Hochberg) over all candidates, apart for each class of
encoding and length, tells which strings are certainly not random: at most a share q of those dismissed would
be random ones. So the control bounds what is missed; how many of the reported are secrets is measured on
planted strings (README). The others are reported as kind `random`; of one that a fixed kind's span covers
in part, the rest is.

P-values are rounded up to 512 levels, so that the control needs counts by class and level alone (at most
3 x 8 x 512 of them), never a sort of all candidates.

Defined results: null or empty text has no spans; spans are in code points, end exclusive; very long texts are
scanned whole; the same string in several documents is a candidate each time; equal rows give equal spans;
an empty table gives no rows; columns of the input pass through, but for one named spans, which is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from landweave.llm.common import saved, table
from landweave.llm.op4_quality import bound, steps

#: Fixed kinds, in their listed order: fixed values.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "random")
MIN_VALUE = 6
SPANS = "array<struct<start:int,kind:int,end:int,value:string>>"

CANDIDATE = r"[A-Za-z0-9+/_-]{24,}"
#: Encodings by the characters of a candidate: alphabet in order, and the pattern that infers it, first match first.
ENCODINGS = (
    ("hex", "0123456789abcdef", r"^([0-9a-f]+|[0-9A-F]+)$"),
    ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", r"^[A-Z2-7]+$"),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", r"^.*$"),
)
LEVELS = 512


#: Matches whose places are summed up together.
BLOCK = 256


def sums_before(gaps: Column) -> Column:
    """Places of matches from (gap before it, own length) of each: running sums within blocks, and over the blocks."""
    none = F.array().cast("array<int>")

    def within(rows: Column, step) -> Column:
        return F.aggregate(rows, F.struct(F.lit(0).alias("at"), none.alias("out")), lambda s, x: F.struct((s["at"] + step(x)[0]).alias("at"), F.concat(s["out"], F.array(s["at"] + step(x)[1])).alias("out")))

    inner = lambda rows: within(rows, lambda x: (x["gap"] + x["own"], x["gap"]))

    def blocked(rows: Column) -> Column:
        parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(rows) - 1) / BLOCK).cast("int")), lambda k: inner(F.slice(rows, k * BLOCK + 1, BLOCK)))
        return bound(parts, lambda p: F.flatten(F.zip_with(p, within(p, lambda x: (x["at"], F.lit(0)))["out"], lambda one, before: F.transform(one["out"], lambda at: at + before))))

    return bound(gaps, lambda rows: F.when(F.size(rows) <= BLOCK, inner(rows)["out"]).otherwise(blocked(rows)))


def spans_of(text: Column, pattern: str, kind: str) -> Column:
    """Leftmost non-overlapping matches as an array of (start, kind, end, value): texts between matches give their places."""
    order = KINDS.index(kind)
    found, between = F.regexp_extract_all(text, F.lit(pattern), 0), F.split(text, pattern, -1)
    value = F.regexp_extract_all(text, F.lit(pattern), 2) if kind == "assign" else found
    size = F.zip_with(F.transform(between, F.char_length), F.transform(found, F.char_length), lambda gap, own: F.struct(gap.alias("gap"), F.coalesce(own, F.lit(0)).alias("own")))
    return bound(sums_before(size), lambda start: F.zip_with(F.slice(start, 1, F.size(found)), F.arrays_zip(found.alias("m"), value.alias("v")), lambda a, m: F.struct(a.alias("start"), F.lit(order).alias("kind"), (a + F.char_length(m["m"])).alias("end"), m["v"].alias("value"))))


def in_blocks(spans: Column) -> Column:
    """spans (by start) in about as many blocks as each has spans, with the least start and greatest end of each.

    So a look-up costs the root of their number twice, not their number.
    """
    size = F.greatest(F.lit(16), F.ceil(F.sqrt(F.size(spans).cast("double"))).cast("int"))
    cut = bound(size, lambda k: F.transform(F.sequence(F.lit(0), F.floor((F.size(spans) - 1) / k).cast("int")), lambda i: F.slice(spans, i * k + 1, k)))
    cut = F.when(F.size(spans) > 0, cut).otherwise(F.array().cast(f"array<{SPANS}>"))
    return F.transform(cut, lambda b: F.struct(F.get(b, 0)["start"].alias("lo"), F.array_max(F.transform(b, lambda s: s["end"])).alias("hi"), b.alias("spans")))


def inside(c: Column, blocks: Column) -> Column:
    """Whether one span covers c whole."""
    own = lambda s: (s["start"] <= c["start"]) & (c["end"] <= s["end"])
    return F.exists(blocks, lambda b: (b["lo"] <= c["start"]) & (c["end"] <= b["hi"]) & F.exists(b["spans"], own))


def outside(c: Column, blocks: Column) -> Column:
    """The parts of span c that no span of blocks covers."""
    near = F.filter(blocks, lambda b: (b["lo"] < c["end"]) & (c["start"] < b["hi"]))
    met = F.flatten(F.transform(near, lambda b: F.filter(b["spans"], lambda s: (s["start"] < c["end"]) & (c["start"] < s["end"]))))
    piece = lambda a, b: F.struct(a.alias("start"), c["kind"].alias("kind"), b.alias("end"), F.substring(c["value"], a - c["start"] + 1, b - a).alias("value"))
    none = F.array().cast(SPANS)

    def step(s: Column, x: Column) -> Column:
        more = F.when(x["start"] > s["at"], F.array(piece(s["at"], x["start"]))).otherwise(none)
        return F.struct(F.greatest(s["at"], x["end"]).alias("at"), F.concat(s["out"], more).alias("out"))

    def cut(met: Column) -> Column:
        done = F.aggregate(met, F.struct(c["start"].alias("at"), none.alias("out")), step)
        rest = bound(done, lambda d: F.concat(d["out"], F.when(d["at"] < c["end"], F.array(piece(d["at"], c["end"]))).otherwise(none)))
        return F.when(F.size(met) == 0, F.array(c)).otherwise(rest)

    return bound(met, cut)


def or_none(cond: Column, spans: Column) -> Column:
    return F.when(cond, spans).otherwise(F.array().cast(SPANS))


def base_spans(text: Column) -> dict[str, Column]:
    """The fixed kinds; a text that can't have a kind costs one search."""
    marked = (F.contains(text, F.lit("=")) | F.contains(text, F.lit(":"))) & text.rlike(ASSIGN)
    return {
        "assign": or_none(marked, F.filter(spans_of(text, ASSIGN, "assign"), lambda s: F.char_length(s["value"]) >= MIN_VALUE)),
        "access": or_none(F.contains(text, F.lit("AKIA")), spans_of(text, ACCESS, "access")),
        "hex": or_none(text.rlike(HEX), spans_of(text, HEX, "hex")),
    }


def tail(z: Column) -> Column:
    """Upper tail of the normal distribution (logistic approximation, error below 2e-4)."""
    return F.lit(1.0) / (1 + F.exp(F.least(F.lit(1.5976) * z + F.lit(0.07056) * z * z * z, F.lit(700.0))))


def encoding(value: Column) -> Column:
    """Number in ENCODINGS."""
    out = F.lit(len(ENCODINGS) - 1)
    for k, (_, _, pattern) in reversed(list(enumerate(ENCODINGS))[:-1]):
        out = F.when(value.rlike(pattern), k).otherwise(out)
    return out


def places(value: Column, kind: Column) -> Column:
    """Places of the characters in the alphabet, from 0."""
    alphabets = F.array(*(F.lit(a) for _, a, _ in ENCODINGS))
    plain = F.translate(F.when(kind == 0, F.lower(value)).otherwise(value), "-_", "+/")
    return bound(F.element_at(alphabets, kind + 1), lambda a: F.transform(F.split(plain, ""), lambda c: F.instr(a, c) - 1))


def battery(value: Column) -> Column:
    """(encoding, p): the p-value of the randomness battery for one candidate."""
    sizes = F.array(*(F.lit(len(a)) for _, a, _ in ENCODINGS))

    def tests(x: Column, k: Column) -> Column:
        n = F.size(x).cast("double")
        size = k.cast("double")
        counts = F.transform(F.array_distinct(x), lambda v: F.size(F.filter(x, lambda y: y == v)).cast("double"))
        chi = size / n * F.aggregate(counts, F.lit(0.0), lambda s, c: s + c * c) - n
        df = size - 1
        z_chi = (F.pow(F.greatest(chi, F.lit(0.0)) / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
        high = F.size(F.filter(x, lambda y: y * 2 >= k)).cast("double")
        low = n - high
        runs = 1 + F.size(F.filter(steps(x, lambda a, b: (a * 2 >= k) != (b * 2 >= k)), lambda y: y))
        mean = 2 * high * low / n + 1
        var = F.greatest((mean - 1) * (mean - 2) / (n - 1), F.lit(1e-9))
        z_runs = F.abs(runs - mean) / F.sqrt(var)
        avg = F.aggregate(x, F.lit(0.0), lambda s, y: s + y) / n
        dev = F.transform(x, lambda y: y - avg)
        own = F.aggregate(dev, F.lit(0.0), lambda s, y: s + y * y)
        lag = F.aggregate(steps(dev, lambda a, b: a * b), F.lit(0.0), lambda s, y: s + y)
        z_lag = F.abs(F.when(own > 0, lag / own * F.sqrt(n)).otherwise(9.0))
        return F.least(F.lit(1.0), 3 * F.least(tail(z_chi), 2 * tail(z_runs), 2 * tail(z_lag)))

    return bound(encoding(value), lambda e: F.struct(e.alias("encoding"), bound(places(value, e), lambda x: bound(F.element_at(sizes, e + 1), lambda k: tests(x, k))).alias("p")))


def length_class(n: Column) -> Column:
    return F.least(F.lit(7), F.floor(F.log2(n / 24.0) * 2)).cast("int")


def level(p: Column) -> Column:
    """p rounded up to 2 ** (-level / 8): 0 is p = 1, the last level holds all that is less."""
    return F.least(F.lit(LEVELS - 1), F.floor(-F.log2(F.greatest(p, F.lit(1e-30))) * 8)).cast("int")


def scored(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with __spans (fixed kinds, in order) and __candidates (span, encoding, class, level), row by row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = base_spans(text)
    spans = F.array_sort(F.concat(*base.values()))
    classes = lambda v: sum((v.rlike(p).cast("int") for p in ("[a-z]", "[A-Z]")), v.rlike("[0-9]").cast("int"))
    raw = or_none(text.rlike(CANDIDATE), F.filter(spans_of(text, CANDIDATE, "random"), lambda s: classes(s["value"]) >= 2))
    open_ = bound(in_blocks(F.col("__spans")), lambda blocks: F.filter("__raw", lambda c: ~inside(c, blocks)))
    judged = F.transform("__open", lambda c: bound(battery(c["value"]), lambda b: F.struct(c.alias("span"), b["encoding"].alias("encoding"), length_class(c["end"] - c["start"]).alias("size"), level(b["p"]).alias("level"))))
    return docs.withColumns({"__spans": spans, "__raw": raw}).withColumn("__open", open_).withColumn("__candidates", judged).drop("__raw", "__open")


def dismissed_levels(candidates: DataFrame, q: float) -> list[tuple[int, int, int]]:
    """(encoding, size class, least level dismissed): Benjamini-Hochberg over counts by level."""
    counts = candidates.groupBy("encoding", "size", "level").count()
    own = Window.partitionBy("encoding", "size")
    upto = F.sum("count").over(own.orderBy(F.col("level").desc()))
    ok = F.pow(F.lit(2.0), -F.col("level") / 8) <= F.lit(q) * upto / F.sum("count").over(own)
    found = counts.withColumn("ok", ok).filter("ok").groupBy("encoding", "size").agg(F.min("level").alias("least"))
    return [tuple(r) for r in found.collect()]


def find_secrets(docs: DataFrame, q: float = 0.05, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """docs with spans: an array of (start, kind, end, value), kind a number in KINDS, by start and kind.

    What is found is written once, with the columns of docs (or those in keep alone: without the text that is
    little). The driver gets one level for each class of encoding and length, 24 at most.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c != "spans"]
    rows = saved(scored(docs, text_col).select(*(F.col(f"`{c}`") for c in keep), "__spans", "__candidates", F.lit(0).alias("__no")), "secret-spans")
    bounds = dismissed_levels(rows.select(F.explode("__candidates").alias("c")).select("c.encoding", "c.size", "c.level"), q)

    def random(c: Column) -> Column:
        out = F.lit(True)
        for e, size, least in bounds:
            out = out & ~((c["encoding"] == e) & (c["size"] == size) & (c["level"] >= least))
        return out

    more = bound(in_blocks(F.col("__spans")), lambda blocks: F.flatten(F.transform(F.filter("__candidates", random), lambda c: outside(c["span"], blocks))))
    return rows.withColumn("spans", F.array_sort(F.concat("__spans", more))).drop("__spans", "__candidates", "__no")


def joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column) -> Column:
    """text with every span replaced by a mark; spans that overlap or touch get one mark together.

    Spans become the stretches they cover, and the kept pieces between these are joined by the mark.
    """
    none = F.array().cast("array<struct<a:int,b:int>>")

    def step(s: Column, x: Column) -> Column:
        gap = F.when(x["start"] > s["at"], F.array(F.struct(s["at"].alias("a"), x["start"].alias("b")))).otherwise(none)
        return F.struct(F.greatest(s["at"], x["end"]).alias("at"), F.concat(s["out"], gap).alias("out"))

    def block(s: Column, b: Column) -> Column:
        # gaps are added up within a block before they join the rest, so that few long arrays are copied
        own = F.aggregate(b["spans"], F.struct(s["at"].alias("at"), none.alias("out")), step)
        return bound(own, lambda o: F.struct(o["at"].alias("at"), F.concat(s["out"], o["out"]).alias("out")))

    first = F.get(spans, 0)["start"]
    done = F.aggregate(in_blocks(spans), F.struct(first.alias("at"), F.array(F.struct(F.lit(0).alias("a"), first.alias("b"))).alias("out")), block)
    kept = bound(done, lambda d: F.concat(d["out"], F.array(F.struct(d["at"].alias("a"), F.char_length(text).alias("b")))))
    # one walk over the text's characters; a substring would look for its place from the start each time
    marked = bound(F.regexp_extract_all(text, F.lit("(?s)."), 0), lambda chars: F.array_join(F.transform(kept, lambda p: F.array_join(F.slice(chars, p["a"] + 1, p["b"] - p["a"]), "")), "<secret>"))
    return F.when(F.size(spans) == 0, text).otherwise(marked)


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"]))


def digest(found: DataFrame) -> DataFrame:
    """doc_id, counts by kind, a hash of the fixed kinds' spans, and all spans as text."""
    found = saved(found.select("doc_id", "spans"), "spans")
    base = F.filter("spans", lambda s: s["kind"] < 3)
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), count(3).alias("n_random"))
