"""Exact top-k search by inner product with multi-resolution segment statistics.

Vectors become floor(scale * x). For segments of m components with means a, b and deviations s, t of query
and candidate, the squared distance is at least the sum of m * ((a - b) ** 2 + (s - t) ** 2), and so, both
norms known, the inner product at most the sum of m * (a * b + s * t). Within a block of queries and a block
of candidates this bound is taken coarse to fine (4, then 16 segments); exact integer products are
made only for pairs whose bounds reach the query's k-th best score so far.

Blocks of queries and of candidates are bounded in bytes, whatever the vectors' length, and hold the
narrowest integers that fit. They meet in a grid of cells: some blocks of queries (a row) by some of
candidates (a chain). Which cells a block goes to is arithmetic on its number, so no table of pairs is made, and
a vector length shared by all rows is no hot key. A task reads its cell's queries, then takes one block of
candidates after the other for all of them, and hands the k best scores on, so later blocks are pruned more; it
gives at most k rows for each query, and the last step keeps the k best of these. A block of candidates is
moved once for each row of the grid: with a set of queries that grows with the table, rows grow as it does, and
the work as its square, as that of an exact search does anyway.

Defined results: vectors that are null, empty or hold null or non-finite components take no part; vectors
of another length than the query's are no candidates; ties go to the smaller id; a row of the query's own
id is no candidate, nor is a null id; rows of one id each count; scores are exact while products fit in 64
bits; very long vectors are blocks of their own; an empty table gives no rows. Only the two named columns
are read, whatever others there are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from landweave.llm.common import saved, table

LEVELS = (4, 16)
#: Bytes of a block of candidates and of queries, blocks of queries in a row of the grid, blocks of candidates in a chain, and queries at once.
BLOCK_BYTES, QUERY_BYTES = 16 << 20, 4 << 20
ROW, CHAIN = 4, 8
#: Cells at most: chains get longer, not tasks more, where there would be more of them.
CELLS = 20_000
AT_ONCE = 128


def scaled(vector: Column, scale: float) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))


def usable(vector: Column) -> Column:
    """Not null or empty, and every component a finite number."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vector) > 0) & ~bad, F.lit(False))


def narrow(x: np.ndarray) -> np.ndarray:
    """x in the narrowest integers that hold it."""
    most = int(max(x.max(initial=0), -x.min(initial=0)))
    return x.astype(next(t for t in (np.int16, np.int32, np.int64) if most <= np.iinfo(t).max))


def blocks(vectors: DataFrame, most_bytes: int, rows: int | None = None) -> DataFrame:
    """(block, dim, wide, ids, vectors) of one length each, most_bytes at most (or one vector), and at most rows vectors; numbered within a partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        no, part = 0, TaskContext.get().partitionId()
        held: dict[int, tuple[list[int], list[np.ndarray]]] = {}

        def out(dim: int) -> pa.RecordBatch:
            nonlocal no
            ids, own = held.pop(dim)
            no += 1
            x = narrow(np.concatenate(own))
            return pa.RecordBatch.from_pydict({"block": pa.array([(part << 32) + no], pa.int64()), "dim": pa.array([dim], pa.int32()), "wide": pa.array([x.itemsize], pa.int32()), "ids": pa.array([np.array(ids, np.int64).tobytes()], pa.binary()), "vectors": pa.array([x.tobytes()], pa.binary())})

        for batch in batches:
            lists = batch.column("v")
            flat, ends = lists.flatten().to_numpy(), np.cumsum(lists.value_lengths().to_numpy())
            for vec_id, end, dim in zip(batch.column("id").to_pylist(), ends.tolist(), lists.value_lengths().to_pylist(), strict=True):
                ids, own = held.setdefault(dim, ([], []))
                ids.append(vec_id)
                own.append(flat[end - dim : end].copy())
                if len(ids) * dim * 8 >= most_bytes or (rows and len(ids) >= rows):
                    yield out(dim)
            while sum(len(i) * d * 8 for d, (i, _) in held.items()) > 2 * most_bytes:  # many lengths side by side
                yield out(max(held, key=lambda d: len(held[d][0]) * d))
        for dim in list(held):
            yield out(dim)

    return vectors.mapInArrow(run, "block long, dim int, wide int, ids binary, vectors binary")


def segment_stats(x: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of segments, each times the root of its length: products sum to the bound."""
    cuts = np.linspace(0, x.shape[1], min(segments, x.shape[1]) + 1).astype(int)
    m = np.diff(cuts)
    mean = np.add.reduceat(x, cuts[:-1], axis=1) / m
    spread = np.sqrt(np.maximum(np.add.reduceat((x - np.repeat(mean, m, axis=1)) ** 2, cuts[:-1], axis=1) / m, 0))
    return np.concatenate([mean, spread], axis=1) * np.sqrt(np.tile(m, 2))


def exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products of rows: by doubles where these are exact, else by 64-bit integers."""
    if len(q) and len(x) and float(np.abs(q).max()) * float(np.abs(x).max()) * q.shape[1] < 2.0**52:
        return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    return q @ x.T


@dataclass
class Block:
    """Vectors with their ids and segment statistics, made once."""

    ids: np.ndarray
    x: np.ndarray

    def __post_init__(self) -> None:
        f = self.x.astype(np.float64)
        self.norms = np.linalg.norm(f, axis=1)
        self.coarse, self.fine = segment_stats(f, LEVELS[0]), segment_stats(f, LEVELS[1])


def block_topk(q: Block, at: slice, c: Block, k: int, known: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query of q[at] the positions of its k best candidates in c, and their scores; known: scores that others reached already (least allowed)."""
    slack = 1e-9 * q.norms[at] * c.norms.max(initial=0) + 1e-6
    coarse = q.coarse[at] @ c.coarse.T + slack[:, None]
    out = []
    for i, j in enumerate(range(*at.indices(len(q.ids)))):
        own, other = q.x[j : j + 1], c.ids != q.ids[j]
        first = np.argpartition(-coarse[i], min(4 * k, len(c.ids) - 1))[: 4 * k]
        first = first[other[first]]
        done = exact(own, c.x[first])[0]
        least = max(known[j], np.sort(done)[-k] if len(done) >= k else known[j])
        left = np.flatnonzero(other & (coarse[i] >= least))
        if len(left) > k:
            left = left[c.fine[left] @ q.fine[j] + slack[i] >= least]
        scores = exact(own, c.x[left])[0]
        best = np.lexsort((c.ids[left], -scores))[:k]
        out.append((left[best], scores[best]))
    return out


def topk(vectors: DataFrame, queries: Column, k: int = 10, scale: float = 1024.0, id_col: str = "vec_id", vector_col: str = "embedding", block_bytes: int = BLOCK_BYTES, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all vectors for each row where queries holds."""
    spark = vectors.sparkSession
    good = vectors.filter(F.col(id_col).isNotNull() & usable(F.col(vector_col)))
    made = good.select(F.col(id_col).cast("long").alias("id"), scaled(F.col(vector_col), scale).alias("v"), queries.alias("asked"))
    n, asked_size = made.agg(F.count("*"), F.coalesce(F.sum(F.when(F.col("asked"), F.size("v") * 8)), F.lit(0))).first()
    all_blocks = saved(blocks(made.select("id", "v"), block_bytes, max(1024, n // spark.sparkContext.defaultParallelism)), "vector-blocks")
    asked = made.filter("asked").select("id", "v")
    asked_blocks = saved(blocks(asked.coalesce(max(1, asked_size // query_bytes)), query_bytes), "query-blocks")
    # chains of several blocks, but never fewer tasks than cores while there are blocks for them
    n_all, n_asked = all_blocks.count(), asked_blocks.count()
    rows = max(1, -(-n_asked // ROW))
    chains = max(1, min(n_all, max(-(-spark.sparkContext.defaultParallelism // rows), min(n_all // CHAIN, CELLS // rows))))
    dealt = lambda parts: F.pmod(F.xxhash64("block"), F.lit(parts)).cast("int")
    each = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    sides = asked_blocks.select("*", F.lit(0).alias("side"), dealt(rows).alias("row"), each(chains).alias("chain"))
    sides = sides.unionByName(all_blocks.select("*", F.lit(1).alias("side"), dealt(chains).alias("chain"), each(rows).alias("row")))
    cell = F.col("row") * chains + F.col("chain")
    both = sides.select("block", "dim", "wide", "ids", "vectors", "side", cell.alias("cell")).repartitionById(rows * chains, "cell").sortWithinPartitions("side", "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked: dict[int, list[tuple[Block, list[tuple[np.ndarray, np.ndarray]]]]] = {}

        for batch in batches:
            for i in range(batch.num_rows):
                r = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                if r["side"] and r["dim"] not in asked:
                    continue
                c = Block(np.frombuffer(r["ids"], np.int64), np.frombuffer(r["vectors"], f"i{r['wide']}").reshape(-1, r["dim"]).astype(np.int64))
                if not r["side"]:
                    asked.setdefault(r["dim"], []).append((c, [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(c.ids)))
                    continue
                for q, best in asked[r["dim"]]:
                    known = np.array([s[-1] if len(s) >= k else np.iinfo(np.int64).min for _, s in best])
                    for a in range(0, len(q.ids), AT_ONCE):
                        for j, (at, scores) in enumerate(block_topk(q, slice(a, a + AT_ONCE), c, k, known), a):
                            ids, s = np.concatenate([best[j][0], c.ids[at]]), np.concatenate([best[j][1], scores])
                            top = np.lexsort((ids, -s))[:k]
                            best[j] = ids[top], s[top]
        for q, best in (x for own in asked.values() for x in own):
            yield pa.RecordBatch.from_pydict({"query_id": np.repeat(q.ids, [len(i) for i, _ in best]), "vec_id": np.concatenate([i for i, _ in best]), "score": np.concatenate([s for _, s in best])})

    found = both.mapInArrow(run, "query_id long, vec_id long, score long")
    best = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", best).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v AS q JOIN v AS c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v) WHERE q.vec_id % 100 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 10
"""
