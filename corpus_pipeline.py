"""From raw documents to packed sequences: quality rules, near duplicates, secrets, mixing, packing.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before kept; each result is
written as Parquet to the shared folder and read back. All stages but the last return the columns of
documents, and further columns of any names with them.

Defined results, for every stage: an empty table gives no rows; repeated rows stay repeated rows (unless a
stage drops documents, then they go together); very long texts are handled whole. A null or empty text is
rejected by the quality rules; later stages, on their own input, keep it: as a document without links,
without secrets, of size 0 (never repeated) and of an end id alone. A null source is a source of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landweave.llm.common import saved, table
from landweave.llm.op3_mixing import mixed_documents
from landweave.llm.op4_quality import keep_good
from landweave.llm.op5_packing import pack, token_pieces
from landweave.llm.op6_secrets import find_secrets, redacted
from landweave.llm.op9_jaccard import jaccard_components
from landweave.llm.tokens import vocabulary


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a rule go; equal texts are judged alike."""
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by five-word shingles at 0.8, the document with the least doc_id stays.

    Rows that share a doc_id are one document: they stay or go together.
    """
    found = jaccard_components(docs, k=5, threshold="0.8")
    stays = found.filter(F.col("component_id").eqNullSafe(F.col("doc_id"))).select(F.col("doc_id").alias("__stays")).distinct()
    return docs.join(stays, docs["doc_id"].eqNullSafe(stays["__stays"]), "left_semi")


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts give way to a mark, and n_chars follows; every document stays, and so does a null text."""
    other = {c: f"__c{i}" for i, c in enumerate(docs.columns) if c != "text"}
    found, marked = find_secrets(docs.select("text", *(F.col(f"`{c}`").alias(x) for c, x in other.items()))), F.size("spans") > 0
    # made once and kept apart: one projection must not hold the same long expression twice
    made = found.select(*other.values(), marked.alias("__marked"), redacted(F.col("text"), F.col("spans")).alias("__text"))
    new = {c: F.col(x) for c, x in other.items()} | {"text": F.col("__text")}
    if "n_chars" in other:
        new["n_chars"] = F.when(F.col("__marked"), F.char_length("__text").cast("long")).otherwise(new["n_chars"])
    return made.select(*(new[c].alias(c) for c in docs.columns))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target asks for; rows of one doc_id are taken alike."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences of 2048; equal documents are packed each."""
    return pack(token_pieces(docs, vocabulary("byte_bpe_50k.json")), 2048)


STAGES = [("quality rules", quality), ("near duplicates", near_duplicates), ("secret scans", secrets), ("mixing", mixing), ("packing", packing)]

#: Tokenizing is not for SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = saved(docs, name.replace(" ", "-"))
    return docs
