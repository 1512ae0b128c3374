"""Substring dedup: word windows repeated across documents, found level by level.

Lengths double from level to level up to the asked one (7 and 13 words; 7, 13, 25 and 50). At each level
only windows are looked at whose parts were found in several documents at the level before; of the windows
inside one of the next length only the one of the least hash counts, so equal longer windows meet at the same
shorter one, and about a quarter of all places are looked at. Levels end at the asked length, since longer
windows would cover no other words, or as soon as no window is found in several documents.

Documents are handled in chunks that have a fixed place in their files, so that each level reads the
documents where they lie, without a shuffle of texts: a chunk sends its different hashes (one that all
documents share costs a row for each chunk, not for each document) to the bucket of the hash, and a bucket
answers with the hashes that other documents have as well. Answers are a table in the shared folder with one
folder for each chunk, from which a task reads its own chunk's part. A chunk holds about CHUNK_BYTES of
text by the average length, a task sends whenever it holds SEND_HASHES, and the number of buckets grows with the
bytes of text, so what a task holds doesn't grow with the input.

Defined results: null or empty text has no words; a text shorter than the window keeps all words; a window
that repeats only inside its document stays; rows of one doc_id count as one document; a null doc_id
counts as smallest; very long texts are handled whole; an empty table gives no rows; other columns are not
read, whatever their names. Hashes have 64 bits: two different windows would have to share one for a wrong
removal.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landweave.llm.common import Scratch, saved, table
from landweave.llm.files import read_folder
from landweave.llm.words import Words, hashed, slices

NULL_ID = -(1 << 63)
#: Bytes of text in a chunk of a file (by the average length), at most so many rows; hashes that are sent
#: together; bytes of text whose hashes meet in one bucket; words of the first level at most.
CHUNK_BYTES, CHUNK_ROWS = 24 << 20, 8192
SEND_HASHES = 4 << 20
BUCKET_BYTES = 32 << 20
FIRST = 8
_SENT = "bucket int, chunk long, h binary, doc binary"
_FOUND = "chunk long, h binary, doc binary"
_OUT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def placed(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int, int]:
    """doc_id, text and chunk; rows and bytes of text in all. Documents that don't come straight from files are written first."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    try:
        docs.select(F.col("_metadata.row_index"))
    except AnalysisException:
        docs = saved(rows, "placed-docs")
        id_col, text_col = "doc_id", "text"
    n, size = docs.agg(F.count("*"), F.coalesce(F.sum(F.octet_length(F.col(text_col).cast("string"))), F.lit(0))).first()
    some = max(16, min(CHUNK_ROWS, CHUNK_BYTES * n // max(size, 1)))
    where = F.xxhash64(F.col("_metadata.file_path"), F.floor(F.col("_metadata.row_index") / some))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), where.alias("chunk")), n, size


def buckets_for(spark: SparkSession, size: int) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // BUCKET_BYTES)


def lengths(size: int) -> list[int]:
    """Window lengths by level, about double from each to the next, up to size."""
    out = [size]
    while out[0] > FIRST or len(out) == 1:
        out.insert(0, -(-out[0] // 2))
    return out


def least_inside(short: np.ndarray, more: int) -> np.ndarray:
    """From each place on, the least of more + 1 values."""
    n = max(0, len(short) - more)
    least = short[:n].copy()
    for j in range(1, more + 1):
        np.minimum(least, short[j : j + n], out=least)
    return least


def all_inside(ok: np.ndarray, more: int) -> np.ndarray:
    """From each place on, whether all of more + 1 hold."""
    total = np.append(0, np.cumsum(~ok))
    n = max(0, len(ok) - more)
    return total[more + 1 : more + 1 + n] == total[:n]


def summed(h: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different hashes, ascending, with the least and the greatest document of each."""
    order = np.argsort(h, kind="stable")
    h, doc = h[order], doc[order]
    first = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.zeros(0, np.int64)
    if not len(first):
        return h, doc, doc
    return h[first], np.minimum.reduceat(doc, first), np.maximum.reduceat(doc, first)


class Answers:
    """The hashes a chunk got back, from the table of answers."""

    def __init__(self, path: str | None):
        self.path, self.chunk, self.found = path, None, None

    def of(self, chunk: int) -> tuple[np.ndarray, np.ndarray]:
        if chunk != self.chunk:
            rows = read_folder(f"{self.path}/chunk={chunk}", ["h", "doc"])
            h = np.concatenate([np.zeros(0, np.uint64), *(np.frombuffer(x, np.uint64) for x in rows["h"])])
            doc = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(x, np.int64) for x in rows["doc"])])
            order = np.argsort(h)
            self.chunk, self.found = chunk, (h[order], doc[order])
        return self.found


def among(h: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each h is in known (ascending), and where."""
    if not len(known):
        return np.zeros(len(h), bool), np.zeros(len(h), np.int64)
    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
    return known[at] == h, at


def chunks_of(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    chunk = batch.column("chunk").to_numpy()
    cut = [0, *(np.flatnonzero(np.diff(chunk)) + 1).tolist(), len(chunk)]
    for a, b in zip(cut, cut[1:], strict=False):
        if b > a:
            yield int(chunk[a]), batch.slice(a, b - a)


class Outbox:
    """Different hashes of a chunk with their documents, by bucket."""

    def __init__(self, buckets: int):
        self.buckets, self.chunk, self.held, self.n = buckets, None, [], 0

    def add(self, chunk: int, h: np.ndarray, doc: np.ndarray) -> Iterator[pa.RecordBatch]:
        if chunk != self.chunk or self.n > SEND_HASHES:
            yield from self.flush()
            self.chunk = chunk
        h, low, high = summed(h, doc)
        more = low != high  # sent with both documents: its bucket sees that it repeats
        self.held.append((np.concatenate([h, h[more]]), np.concatenate([low, high[more]])))
        self.n += len(h)

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.n:
            h, low, high = summed(*(np.concatenate(x) for x in zip(*self.held, strict=True)))
            more = low != high
            h, doc = np.concatenate([h, h[more]]), np.concatenate([low, high[more]])
            to = (h >> np.uint64(33)).astype(np.int64) % self.buckets
            order = np.argsort(to, kind="stable")
            cut = np.flatnonzero(np.append(True, np.diff(to[order]) != 0))
            parts = np.split(order, cut[1:])
            yield pa.RecordBatch.from_arrays([pa.array(to[order][cut], pa.int32()), pa.array([self.chunk] * len(cut), pa.int64()), pa.array([h[p].tobytes() for p in parts], pa.binary()), pa.array([doc[p].tobytes() for p in parts], pa.binary())], names=["bucket", "chunk", "h", "doc"])
        self.held, self.n = [], 0


def send(rows: DataFrame, sizes: list[int], level: int, answers: str | None, buckets: int) -> DataFrame:
    """Each chunk's different hashes by bucket: of the windows of this level that stand for one of the next (of the last: all) and whose parts were found."""
    size, before = sizes[level], sizes[level - 1] if level else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        back, out = Answers(answers), Outbox(buckets)
        for batch in batches:
            for chunk, part in chunks_of(batch):
                ids = part.column("doc_id").fill_null(NULL_ID).to_numpy()
                for first, texts in slices(part.column("text")):
                    w = hashed(texts)
                    ok, h = w.inside(size), w.windows(size)
                    if level:
                        ok[ok] = among(least_inside(w.windows(before), size - before)[ok], back.of(chunk)[0])[0]
                    doc = ids[first + w.doc[: len(h)]]
                    if level < len(sizes) - 1:
                        more = sizes[level + 1] - size
                        ok, h = all_inside(ok, more) & w.inside(size + more), least_inside(h, more)
                        doc = doc[: len(h)]
                        ok[1:] &= (h[1:] != h[:-1]) | (doc[1:] != doc[:-1]) | ~ok[:-1]
                    yield from out.add(chunk, h[ok], doc[ok])
        yield from out.flush()

    return rows.mapInArrow(run, _SENT)


def answer(sent: DataFrame, path: str) -> None:
    """Write to path, for each chunk, the hashes it sent that several documents have, with the least of them."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        h = np.concatenate([np.frombuffer(x, np.uint64) for x in pdf["h"]])
        doc = np.concatenate([np.frombuffer(x, np.int64) for x in pdf["doc"]])
        chunk = np.repeat(np.arange(len(pdf)), [len(x) // 8 for x in pdf["h"]])
        known, low, high = summed(h, doc)
        known, low = known[low != high], low[low != high]
        hit, at = among(h, known)
        at, chunk = at[hit], chunk[hit]
        out: dict[int, list[np.ndarray]] = {}
        for k in np.unique(chunk):
            out.setdefault(int(pdf["chunk"].iloc[k]), []).append(at[chunk == k])
        found = {c: np.unique(np.concatenate(x)) for c, x in out.items()}
        return pd.DataFrame({"chunk": list(found), "h": [known[x].tobytes() for x in found.values()], "doc": [low[x].tobytes() for x in found.values()]})

    found = sent.groupBy("bucket").applyInPandas(run, _FOUND)
    found.repartition("chunk").write.partitionBy("chunk").parquet(path)


def repeated(docs: DataFrame, size: int = 13, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, str]:
    """docs by chunk, and the answers for its windows of size words: all that several documents have, with the least doc_id."""
    if size < 2:
        raise ValueError("windows have two words at least")
    spark = docs.sparkSession
    rows, _, total = placed(docs, id_col, text_col)
    work, sizes, path = Scratch(spark), lengths(size), None
    for level, n in enumerate(sizes):
        before, path = path, work.path(f"windows-{n}")
        answer(send(rows, sizes, level, before, buckets_for(spark, total)), path)
        if before:
            work.drop(f"windows-{sizes[level - 1]}")
        if level < len(sizes) - 1 and spark.read.schema(_FOUND).parquet(path).isEmpty():
            break
    return rows, path


def removed(w: Words, ids: np.ndarray, size: int, answers: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Whether each word is covered by a window that a smaller document has."""
    known, low = answers
    inside, h = w.inside(size), w.windows(size)
    hit, at = among(h, known)
    hit &= inside
    hit[hit] = low[at[hit]] < ids[w.doc[: len(hit)][hit]]
    step = np.zeros(len(w.hashes) + 1, np.int64)
    start = np.flatnonzero(hit)
    np.add.at(step, start, 1)
    np.add.at(step, start + size, -1)
    return np.cumsum(step[:-1]) > 0


def dedup_substrings(docs: DataFrame, size: int = 13, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and, if asked for, kept: the words left, joined by one space."""
    rows, path = repeated(docs, size, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        back = Answers(path)
        for batch in batches:
            for chunk, part in chunks_of(batch):
                ids = part.column("doc_id").fill_null(NULL_ID).to_numpy()
                for first, texts in slices(part.column("text")):
                    w = hashed(texts)
                    own = ids[first : first + len(texts)]
                    gone = removed(w, own, size, back.of(chunk))
                    ends = np.cumsum(w.counts)
                    lost = np.bincount(w.doc[gone], minlength=len(own)) if len(gone) else np.zeros(len(own), np.int64)
                    kept = []
                    for k, text in enumerate(texts.to_pylist()):
                        all_words = text.split()
                        if lost[k]:
                            mask = gone[ends[k] - w.counts[k] : ends[k]]
                            all_words = [all_words[i] for i in np.flatnonzero(~mask)]
                        kept.append(b" ".join(all_words))
                    out = [pa.array(own, mask=own == NULL_ID), pa.array(w.counts.astype(np.int64)), pa.array(lost.astype(np.int64)), pa.array([hashlib.sha256(x).hexdigest() for x in kept])]
                    if with_text:
                        out.append(pa.array(kept, pa.binary()).cast(pa.string()))
                    yield pa.RecordBatch.from_arrays(out, names=["doc_id", "n_words", "n_removed", "kept_sha256", *["kept"] * with_text])

    return rows.mapInArrow(run, _OUT + ", kept string" * with_text)


def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(table(spark, sf_dir, "documents"), with_text=False)


SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM w),
g AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY array_to_string(words[i:i + 12], ' ')) AS low FROM s),
c AS (SELECT DISTINCT doc_id, i + k AS i FROM g, (SELECT unnest(range(13)) AS k) WHERE low < doc_id),
r AS (SELECT doc_id, list(i) AS gone FROM c GROUP BY doc_id)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
  sha256(array_to_string(CASE WHEN gone IS NULL THEN words
    ELSE list_filter(words, lambda x, i: NOT list_contains(gone, i)) END, ' ')) AS kept_sha256
FROM w LEFT JOIN r ON r.doc_id = w.doc_id
"""
