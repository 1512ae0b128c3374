"""Token-ID files: flat unsigned integers plus 64-bit document offsets, memory-mapped on reading.

A data set is a folder of parts. Part k holds the documents of one range of doc_id in ascending order as
three flat little-endian files: `.ids` (unsigned, 16 bits if the vocabulary allows, else 32), `.off`
(int64, n + 1 offsets into `.ids`) and `.doc` (int64 doc_ids). A part's base (ids of all documents before
it) comes from a prefix sum over the parts' totals; `manifest.json` lists parts and bases.

Defined results: a null text is an empty document (its end id alone); a null doc_id sorts first and is
written as the smallest int64, read back as null; equal doc_ids stay as separate documents in any order (and
may lie in several parts); very long texts are encoded whole; an empty table gives no parts. Other columns
are not read, whatever their names. A task that is run again writes files of new
names, and only the files named by the run that Spark counts are listed in the manifest.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landweave.llm.common import parts_for, scratch, table
from landweave.llm.files import Flat, out_stream
from landweave.llm.tokens import codec, vocabulary

NULL_ID = -(1 << 63)
#: Bytes of text for a part, and ids that are read at once.
PART_BYTES = 256 << 20
READ_IDS = 4 << 20
_PARTS = "part int, name string, dtype string, n_docs long, n_ids long"
_READ = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


@dataclass(frozen=True)
class Part:
    part: int
    name: str
    dtype: str
    n_docs: int
    n_ids: int
    base: int


def write_token_files(docs: DataFrame, out: str, tokenizer: str, end_id: int | None = None, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None) -> list[Part]:
    """Write docs as token files under out, a folder that driver and executors share; returns the parts in order.

    What the driver gets is one row for each part; texts are ranged by doc_id in one shuffle, rows of one
    doc_id also by their text's hash, so that none of them need to meet in one task. The number of parts
    grows with the bytes of text.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    n = parts or parts_for(rows, "text", PART_BYTES)
    ranged = rows.repartitionByRange(n, F.col("doc_id").asc_nulls_first(), F.xxhash64("text")).sortWithinPartitions(F.col("doc_id").asc_nulls_first())

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, c = TaskContext.get().partitionId(), codec(tokenizer)
        dtype = "<u2" if max(c.size, end_id or 0) <= 1 << 16 else "<u4"
        name, files, n_docs, n_ids = f"part-{part:06d}-{uuid.uuid4().hex[:12]}", None, 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if files is None:
                files = [out_stream(f"{out}/{name}.{kind}") for kind in ("ids", "off", "doc")]
                files[1].write(np.zeros(1, "<i8").tobytes())
            ids, counts = c.encode(batch.column(1))
            if end_id is not None:
                ids, counts = np.insert(ids, np.cumsum(counts), end_id), counts + 1
            files[0].write(ids.astype(dtype).tobytes())
            files[1].write((n_ids + np.cumsum(counts)).astype("<i8").tobytes())
            files[2].write(batch.column(0).fill_null(NULL_ID).to_numpy().astype("<i8").tobytes())
            n_docs, n_ids = n_docs + batch.num_rows, n_ids + int(counts.sum())
        if files is not None:
            for f in files:
                f.close()
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "name": [name], "dtype": [dtype], "n_docs": [n_docs], "n_ids": [n_ids]})

    done = sorted(ranged.mapInArrow(write, _PARTS).collect(), key=lambda r: r["part"])
    bases = np.cumsum([0, *(r["n_ids"] for r in done)]).tolist()
    found = [Part(r["part"], r["name"], r["dtype"], r["n_docs"], r["n_ids"], base) for r, base in zip(done, bases, strict=False)]
    with out_stream(f"{out}/manifest.json") as f:
        f.write(json.dumps([asdict(p) for p in found]).encode())
    return found


def read_manifest(spark: SparkSession, out: str) -> list[Part]:
    text = "".join(r[0] for r in spark.read.text(f"{out}/manifest.json").collect())
    return [Part(**p) for p in json.loads(text)]


def token_file_stats(spark: SparkSession, out: str) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens and ids_crc32 of every document, from the files alone."""
    parts = read_manifest(spark, out)
    rows = spark.createDataFrame([(p.name, p.dtype, p.base) for p in parts], "name string, dtype string, base long")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in batch.to_pylist():
                ids, off, doc = (Flat(f"{out}/{p['name']}.{kind}", t) for kind, t in (("ids", p["dtype"]), ("off", "<i8"), ("doc", "<i8")))
                a = 0
                while a < len(doc):
                    some_off = off.part(a, min(a + 4096, len(doc)) + 1)
                    n = max(1, int(np.searchsorted(some_off, some_off[0] + READ_IDS, "right")) - 1)
                    some_off = some_off[: n + 1]
                    some, at = ids.part(int(some_off[0]), int(some_off[-1])).astype("<u4"), (some_off - some_off[0]).tolist()
                    view = memoryview(some).cast("B") if len(some) else b""
                    crc = [zlib.crc32(view[4 * x : 4 * y]) for x, y in zip(at, at[1:], strict=False)]
                    d = doc.part(a, a + n)
                    yield pa.RecordBatch.from_arrays([pa.array(d, mask=d == NULL_ID), pa.array(p["base"] + some_off[:-1]), pa.array(np.diff(some_off)), pa.array(crc, pa.int64())], schema=_READ)
                    a += n

    return rows.repartition(max(1, len(parts))).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), out, vocabulary("word_bpe_49k.json"), end_id=2)
    return token_file_stats(spark, out)
