"""Exact n-gram Jaccard self-join by a grouped prefix join, and its connected components.

1. Documents with one and the same shingle set become a class.
2. All shingles get one global order, rarest first, by a fixed-size table of counts; two sets can only
   link if they share a shingle within the first n - ceil(t * n) + 1 of each (their prefixes).
3. Classes with identical prefix and size become a group. A shingle in the prefixes of one group alone makes
   no pair: each chunk of documents sends its different prefix shingles by bucket, is answered which of them
   other groups have, and only these become rows. Groups that meet at a shingle are filtered by
   size and by the place of the shingle. First each group is held against the one hub of a shingle; what
   links is one component already, and only then other pairs, between different components alone, are
   looked for: groups at a shingle are summed by (size, place), pairs of such sums of fitting sizes are
   filtered, and only pairs that pass are expanded to their members.
4. Member pairs pass a bound on their overlap from counts in 128 parts of the hash space, and then the
   sets themselves are compared.

Nothing is capped: filters only drop pairs that can't reach the threshold, and pairs within a component
change no component. Texts are read where they lie and never shuffled; sets travel for the documents of
candidate pairs only. Intermediate tables go as soon as what was made of them is written.

Defined results: null or empty text, or one without words, has an empty set and is its own component; a
text shorter than a shingle has its whole word sequence as one; very long texts are handled whole; rows of
one doc_id are one node, each keeping its own n_shingles; a null doc_id is its own component (null); an
empty table gives no rows; other columns are not read, whatever their names. Sets hold 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landweave.llm.common import Scratch, table
from landweave.llm.components import components
from landweave.llm.files import read_folder
from landweave.llm.op10_substrings import _SENT, Answers, Outbox, among, answer, buckets_for, chunks_of, placed
from landweave.llm.words import hashed, mixed, slices

#: Counters of the frequency table; its size never depends on the data.
SLOTS = 1 << 22
_BLOCK = 1 << 16
#: Tasks whose counters are summed together.
TREE = 256
PARTS = 128


def sets_of(texts: pa.Array, k: int) -> Iterator[np.ndarray]:
    """The distinct k-word shingles of each text, ascending."""
    for _, part in slices(texts):
        w = hashed(part, lower=True)
        windows, ends = w.windows(k), np.cumsum(w.counts)
        for n, end in zip(w.counts.tolist(), ends.tolist(), strict=True):
            if n >= k:
                yield np.unique(windows[end - n : end - k + 1])
            elif n:
                h = np.uint64(n)
                for x in w.hashes[end - n : end]:
                    h = mixed(np.array([h]) ^ x)[0]
                yield np.array([h])
            else:
                yield np.zeros(0, np.uint64)


def slot(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(20)).astype(np.int64) & (SLOTS - 1)


def frequency_levels(rows: DataFrame, k: int) -> np.ndarray:
    """For each slot a level that grows with how many documents have its shingles: SLOTS bytes, whatever the input."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        branch = TaskContext.get().partitionId() // TREE
        total, held, n_held = np.zeros(SLOTS, np.int32), [], 0

        def flush() -> None:
            if held:
                at, n = np.unique(slot(np.concatenate(held)).astype(np.int32), return_counts=True)
                total[at] += n.astype(np.int32)
                held.clear()

        for batch in batches:
            for s in sets_of(batch.column("text"), k):
                held.append(s)
                n_held += len(s)
                if n_held > 1 << 19:
                    flush()
                    n_held = 0
        flush()
        for b in range(0, SLOTS, _BLOCK):
            own = np.flatnonzero(total[b : b + _BLOCK])
            if len(own):
                n = total[b : b + _BLOCK][own]
                wide = bool(n.max() > 255)
                yield pa.RecordBatch.from_pydict({"block": pa.array([b], pa.int32()), "branch": pa.array([branch], pa.int32()), "at": [own.astype(np.uint16).tobytes()], "wide": [wide], "n": [n.astype(np.int32 if wide else np.uint8).tobytes()]})

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(_BLOCK, np.int64)
        for at, wide, n in zip(pdf["at"], pdf["wide"], pdf["n"], strict=True):
            total[np.frombuffer(at, np.uint16)] += np.frombuffer(n, np.int32 if wide else np.uint8)
        return pd.DataFrame({"block": pdf["block"].iloc[:1], "n": [total.tobytes()]})

    def finish(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(n, np.int64) for n in pdf["n"])
        level = np.minimum(255, np.round(8 * np.log2(np.maximum(total, 1)))).astype(np.uint8)
        return pd.DataFrame({"block": pdf["block"].iloc[:1], "level": [level.tobytes()]})

    # in two steps, so that no group gets a row of every task
    parts = rows.select("text").mapInArrow(count, "block int, branch int, at binary, wide boolean, n binary")
    parts = parts.groupBy("block", "branch").applyInPandas(add, "block int, n binary").groupBy("block").applyInPandas(finish, "block int, level binary")
    levels = np.zeros(SLOTS, np.uint8)
    for r in parts.toLocalIterator():
        levels[r["block"] : r["block"] + _BLOCK] = np.frombuffer(r["level"], np.uint8)
    return levels


def needed(n: int, t: Fraction) -> int:
    """Least overlap of a set of n with any set it links to."""
    return math.ceil(t * n)


def summaries(rows: DataFrame, k: int, t: Fraction, levels: np.ndarray) -> DataFrame:
    """doc_id, chunk, n, sig (of the set), prefix (shingles in order) and parts (counts) of every document."""
    shared = rows.sparkSession.sparkContext.broadcast(levels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = shared.value
        for batch in batches:
            ns, sigs, prefixes, parts = [], [], [], []
            for s in sets_of(batch.column("text"), k):
                n = len(s)
                ns.append(n)
                m = mixed(s + np.uint64(0x5BF03635))
                sigs.append(np.array([n, m.sum() if n else 0, np.bitwise_xor.reduce(m) if n else 0], np.uint64).tobytes())
                first = n - needed(n, t) + 1 if n else 0
                prefixes.append(s[np.lexsort((s, level[slot(s)]))[:first]].tobytes())
                parts.append(np.minimum(np.bincount((m >> np.uint64(57)).astype(np.int64), minlength=PARTS), 65535).astype(np.uint16).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("chunk"), pa.array(ns, pa.int32()), pa.array(sigs, pa.binary()), pa.array(prefixes, pa.binary()), pa.array(parts, pa.binary())], names=["doc_id", "chunk", "n", "sig", "prefix", "parts"])

    return rows.mapInArrow(run, "doc_id long, chunk long, n int, sig binary, prefix binary, parts binary")


def shingles_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All prefix shingles of a batch in a row, which row each is of, and its place there."""
    own = [np.frombuffer(x, np.uint64) for x in batch.column("prefix").to_pylist()]
    size = np.array([len(x) for x in own], np.int64)
    place = np.arange(size.sum(), dtype=np.int32) - np.repeat(np.cumsum(size) - size, size).astype(np.int32)
    return np.concatenate([np.zeros(0, np.uint64), *own]), np.repeat(np.arange(len(own)), size), place


def sent_prefixes(docs_of: DataFrame, buckets: int) -> DataFrame:
    """Each chunk's different prefix shingles with the least and the greatest group that has them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Outbox(buckets)
        for batch in batches:
            for chunk, part in chunks_of(batch):
                h, row, _ = shingles_of(part)
                yield from out.add(chunk, h, part.column("key").to_numpy()[row])
        yield from out.flush()

    return docs_of.select("chunk", "key", "prefix").mapInArrow(run, _SENT)


def prefix_rows(docs_of: DataFrame, answers: str) -> DataFrame:
    """(token, at, key, n) for the prefix shingles that several groups have, once for each group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        back, own, seen = Answers(answers), None, set()
        for batch in batches:
            for chunk, part in chunks_of(batch):
                if chunk != own:
                    own, seen = chunk, set()
                new = [i for i, k in enumerate(part.column("key").to_pylist()) if not (k in seen or seen.add(k))]
                part = part.take(pa.array(new, pa.int64()))
                h, row, place = shingles_of(part)
                hit = among(h, back.of(chunk)[0])[0]
                row = pa.array(row[hit])
                yield pa.RecordBatch.from_arrays([pa.array(h[hit].view(np.int64)), pa.array(place[hit]), part.column("key").take(row), part.column("n").take(row)], names=["token", "at", "key", "n"])

    # copies in different chunks give the same rows
    return docs_of.select("chunk", "key", "n", "prefix").mapInArrow(run, "token long, at int, key long, n int").distinct()


def may_link(n1, at1, n2, at2, t: Fraction):
    """Whether sets of n1 and n2 that meet at these places can have the overlap that t asks for (integers only)."""
    p, q = t.numerator, t.denominator
    return (F.least(n1 - at1, n2 - at2) * F.lit(p + q)) >= (n1 + n2) * F.lit(p)


def bounded(pairs: DataFrame, classes: DataFrame, t: Fraction) -> DataFrame:
    """Pairs (a, b) of classes whose parts allow the overlap, with both chunks."""
    p, q = t.numerator, t.denominator
    side = lambda x: classes.select(F.col("rep").alias(x), F.col("n").alias(f"n_{x}"), F.col("parts").alias(f"p_{x}"), F.col("chunk").alias(f"chunk_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, PARTS) for c in ("p_a", "p_b"))
                n = batch.column("n_a").to_numpy().astype(np.int64) + batch.column("n_b").to_numpy()
                full = (a == 65535).any(1) | (b == 65535).any(1)
                ok = full | (np.minimum(a, b).sum(1, dtype=np.int64) * (p + q) >= n * p)
                yield batch.select(["a", "b", "chunk_a", "chunk_b"]).filter(pa.array(ok))

    return both.mapInArrow(run, "a long, b long, chunk_a long, chunk_b long")


def verified(pairs: DataFrame, rows: DataFrame, k: int, t: Fraction, work: Scratch) -> DataFrame:
    """The pairs (a, b) whose sets link; sets are made again where the texts lie, for the documents asked for."""
    p, q = t.numerator, t.denominator
    asked = pairs.select(F.col("a").alias("doc_id"), F.col("chunk_a").alias("chunk")).union(pairs.select("b", "chunk_b")).distinct()
    path = work.path("asked")
    asked.repartition("chunk").write.partitionBy("chunk").parquet(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, ids = None, set()
        for batch in batches:
            for chunk, part in chunks_of(batch):
                if chunk != own:
                    own, ids = chunk, set(read_folder(f"{path}/chunk={chunk}", ["doc_id"])["doc_id"])
                doc = part.column("doc_id").to_pylist()
                at = [i for i, d in enumerate(doc) if d in ids]
                if at:
                    some = part.take(pa.array(at))
                    yield pa.RecordBatch.from_arrays([some.column("doc_id"), pa.array([s.tobytes() for s in sets_of(some.column("text"), k)], pa.binary())], names=["doc_id", "set"])

    sets = work.saved(rows.mapInArrow(run, "doc_id long, set binary"), "sets")
    side = lambda x: sets.select(F.col("doc_id").alias(x), F.col("set").alias(f"s_{x}"))
    both = pairs.select("a", "b").join(side("b"), "b").join(side("a"), "a")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column("s_a").to_pylist(), batch.column("s_b").to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both_have = len(x) + len(y) - len(np.unique(np.concatenate([x, y])))
                ok.append(both_have * (p + q) >= (len(x) + len(y)) * p and both_have > 0)
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    links = work.saved(both.mapInArrow(compare, "a long, b long").distinct(), "links")
    work.drop("asked", "sets")
    return links


def second_look(tokens: DataFrame, classes: DataFrame, known: DataFrame, t: Fraction, work: Scratch) -> DataFrame:
    """Pairs (a, b) of classes in different components that the first look didn't hold against each other."""
    label = classes.select("rep", "key").join(known.withColumnRenamed("node", "rep"), "rep", "left").select("rep", "key", F.coalesce("component", "rep").alias("c"))
    label = work.saved(label, "labels-of-groups")
    span = label.groupBy("key").agg(F.min("c").alias("low"), F.max("c").alias("high"))
    at = tokens.join(span, "key")
    # a shingle whose groups are all of one component makes no pair
    mixed_tokens = at.groupBy("token").agg(F.min("low").alias("low"), F.max("high").alias("high")).filter("low <> high").select("token")
    at = work.saved(at.join(mixed_tokens, "token", "left_semi"), "met-labels")
    sums = work.saved(at.groupBy("token", "n", "at").agg(F.min("low").alias("low"), F.max("high").alias("high")), "met-sums")
    # sizes n <= n2 link only up to n2 <= n / t: bands of that width, each larger one meets its own and the one below
    wide = F.lit(-math.log(t))
    band = lambda c, more: F.floor(F.log(c) / wide + more).cast("int")
    other = sums.select("token", *(F.col(c).alias(f"{c}2") for c in ("n", "at", "low", "high")), F.explode(F.sequence(band("n", -1 - 1e-9), band("n", 1e-9))).alias("band"))
    ordered = (F.col("n") < F.col("n2")) | ((F.col("n") == F.col("n2")) & (F.col("at") <= F.col("at2")))
    apart = F.least("low", "low2") != F.greatest("high", "high2")
    pairs = sums.withColumn("band", band("n", 0)).join(other, ["token", "band"]).filter(ordered & apart & may_link(F.col("n"), F.col("at"), F.col("n2"), F.col("at2"), t))
    pairs = work.saved(pairs.select("token", "n", "at", "n2", "at2"), "sum-pairs")
    left = pairs.join(at.select("token", "n", "at", F.col("key").alias("k1"), F.col("low").alias("l1"), F.col("high").alias("h1")), ["token", "n", "at"])
    right = at.select("token", F.col("n").alias("n2"), F.col("at").alias("at2"), F.col("key").alias("k2"), F.col("low").alias("l2"), F.col("high").alias("h2"))
    found = left.join(right, ["token", "n2", "at2"]).filter(F.least("l1", "l2") != F.greatest("h1", "h2"))
    # of different sums only one order is there, whichever of the two groups has the larger key
    found = work.saved(found.select(F.least("k1", "k2").alias("k1"), F.greatest("k1", "k2").alias("k2")).distinct(), "group-pairs")
    # members one by one, since those of a group may be in several components
    m = lambda x: label.select(F.col("key").alias(f"k{x}"), F.col("rep").alias("ab"[x - 1]), F.col("c").alias(f"c{x}"))
    inner = label.join(span.filter("low <> high"), "key").select(F.col("key").alias("k1"), F.col("key").alias("k2")).distinct()
    second = found.union(inner).distinct().join(m(1), "k1").join(m(2), "k2").filter("c1 <> c2 and a <> b")
    second = work.saved(bounded(second.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), classes, t), "second-pairs")
    work.drop("labels-of-groups", "met-labels", "met-sums", "sum-pairs", "group-pairs")
    return second


def jaccard_components(docs: DataFrame, k: int = 5, threshold: str = "0.8", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id of every document; threshold as a decimal (over 0, under 1), compared exactly."""
    t, work = Fraction(threshold), Scratch(docs.sparkSession)
    rows, total, size = placed(docs, id_col, text_col)
    docs_of = work.saved(summaries(rows, k, t, frequency_levels(rows, k)).withColumn("key", F.xxhash64("prefix", "n")), "summaries")
    some = docs_of.filter("n > 0 and doc_id is not null")
    answers = work.path("shared-shingles")
    answer(sent_prefixes(some, buckets_for(docs.sparkSession, size)), answers)
    tokens = work.saved(prefix_rows(some, answers), "prefixes")
    work.drop("shared-shingles")

    least = work.saved(some.groupBy("sig").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")), "least")
    # a set's key and parts are the same in all its documents: one of them stands for it
    one = some.select("sig", "n", "chunk", F.col("doc_id").alias("rep"), "key", "parts").join(least.drop("copies"), ["sig", "rep"]).dropDuplicates(["rep", "sig"])
    classes = work.saved(one, "classes")
    heads = work.saved(classes.groupBy("key").agg(F.min("rep").alias("grp")), "heads")
    head = lambda x, y: heads.select(F.col("key").alias(x), F.col("grp").alias(y))

    hub = tokens.groupBy("token").agg(F.min(F.struct("at", "n", "key")).alias("hub"))
    hubs = tokens.join(hub, "token").filter(F.col("key") != F.col("hub.key")).filter(may_link(F.col("n"), F.col("at"), F.col("hub.n"), F.col("hub.at"), t))
    hubs = hubs.select(F.col("hub.key").alias("k1"), F.col("key").alias("k2")).distinct().join(head("k1", "a"), "k1").join(head("k2", "b"), "k2")
    members = classes.join(heads, "key").filter("rep <> grp").select(F.col("grp").alias("a"), F.col("rep").alias("b"))
    first = work.saved(bounded(hubs.select("a", "b").union(members).filter("a <> b").distinct(), classes, t), "first-pairs")
    linked = verified(first, rows, k, t, work)
    known = components(linked)
    work.drop("first-pairs", "heads")

    second = second_look(tokens, classes, known, t, work)
    more = verified(second, rows, k, t, work)
    work.drop("second-pairs", "prefixes", "classes")

    whole = components(linked.union(more).union(known.select(F.col("node").alias("a"), F.col("component").alias("b"))))
    # the same doc_id in several rows is one node: its sets are joined through it
    rep_of = work.saved(least.join(whole.withColumnRenamed("node", "rep"), "rep", "left").select("sig", F.coalesce("component", "rep").alias("c"), "copies"), "components-of-sets")
    work.drop("least")
    # sets with over a thousandth of all documents are under a thousand: these are broadcast, the others have few rows each
    hot = (F.col("copies") * 1000 > total)
    own = docs_of.select("doc_id", "n", "sig").join(F.broadcast(rep_of.filter(hot).select("sig", F.col("c").alias("c_hot"))), "sig", "left")
    known_c = (F.col("n") == 0) | F.col("doc_id").isNull() | F.col("c_hot").isNotNull()
    out = own.filter(known_c).select("doc_id", "n", F.col("c_hot").alias("c"))
    out = out.union(own.filter(~known_c).join(rep_of.filter(~hot).select("sig", "c"), "sig", "left").select("doc_id", "n", "c"))
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("c")).otherwise(F.col("doc_id")).alias("component_id"))


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), k=4, threshold="0.85")


SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + 3], ' ') AS g FROM (SELECT doc_id, words, unnest(range(1, len(words) - 2)) AS i FROM w)
  UNION SELECT doc_id, array_to_string(words, ' ') FROM w WHERE len(words) BETWEEN 1 AND 3),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both_have FROM s AS a JOIN s AS b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS MATERIALIZED (SELECT a, b FROM o JOIN n AS x ON x.doc_id = a JOIN n AS y ON y.doc_id = b WHERE 100 * both_have >= 85 * (x.n + y.n - both_have)),
r(doc_id, to_id) AS (SELECT doc_id, doc_id FROM w UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.to_id)
SELECT w.doc_id, CAST(coalesce(max(n.n), 0) AS BIGINT) AS n_shingles, min(r.to_id) AS component_id
FROM w JOIN r ON r.doc_id = w.doc_id LEFT JOIN n ON n.doc_id = w.doc_id GROUP BY w.doc_id
"""
