"""Embedding whitening by exact integer cross-products from bit planes.

Each component becomes the integer floor(scale * c) + offset. A block of rows takes from each dimension its least
value and packs the bits of what is left across rows: one row of 64-bit words for each dimension and bit. The product
sum of two dimensions is the sum of 2 ** (a + b) * popcount(plane a AND plane b); adding the least values back gives exact
sums, which are added up in limbs of 30 bits. The driver gets d * (d + 1) / 2 sums, centres them as integers
(n * sum(xy) - sum(x) * sum(y)), and only then turns to doubles for eigh. A second pass projects the rows, and the
covariance of what is written out is measured from the rows themselves.

Defined results: vectors that are null, empty or hold null or non-finite entries, or numbers too large for a 64-bit
integer, take no part; nor do vectors of another length than most have (of equally frequent lengths the longest); rows of
one id, null ids and repeated rows count each; ties of eigenvalues are ordered as eigh gives them, and each component's
largest entry is positive; where an eigenvalue is at most 1e-12 of the trace nothing can be whitened, and whitened is
null (explained too, where the trace is 0); identity_error is over the other components; an empty table gives no rows.
Only the two named columns are read. The square matrix of the dimensions is the one thing that the driver holds whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landweave.llm.common import Scratch, table

#: Rows packed at once, bits of a limb, and limbs of a sum (150 bits).
BLOCK_ROWS = 8192
LIMB_BITS, LIMBS = 30, 5
SAFE = 1 << 62


def integers(vector: Column, scale: float, offset: int) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long") + F.lit(offset).cast("long"))


def usable(vector: Column, scale: float, offset: int) -> Column:
    """Not null or empty; every component a number whose integer fits in 62 bits."""
    most = (SAFE - abs(offset)) / abs(scale)
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) >= most))
    return F.coalesce((F.size(vector) > 0) & ~bad, F.lit(False))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def bit_planes(left: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Planes (a row of 64-bit words each, bits across the rows of left), and each plane's dimension and bit. left: not negative."""
    bits = np.maximum([int(x).bit_length() for x in left.max(axis=0)], 1)
    dims = np.repeat(np.arange(left.shape[1]), bits)
    shift = np.concatenate([np.arange(b) for b in bits])
    planes = np.zeros((len(dims), 8 * -(-len(left) // 64)), np.uint8)
    for k, (d, s) in enumerate(zip(dims, shift, strict=True)):
        packed = np.packbits((left[:, d] >> np.uint64(s) & np.uint64(1)).astype(bool))
        planes[k, : len(packed)] = packed
    return planes.view(np.uint64), dims, shift


def block_sums(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact sums over rows (objects or long): of each dimension, and of products of each two."""
    n, low = len(x), x.min(axis=0)
    left = (x - low).view(np.uint64)  # differences of 63-bit integers fit in 64 bits without sign
    planes, dims, shift = bit_planes(left)
    both = np.empty((len(planes), len(planes)), np.int64)
    for k, plane in enumerate(planes):
        both[k, k:] = np.bitwise_count(plane & planes[k:]).sum(axis=1, dtype=np.int64)
        both[k:, k] = both[k, k:]
    wide = int(left.max(initial=0)) ** 2 * n >= SAFE or max(abs(int(x.max())), abs(int(low.min()))) ** 2 * n >= SAFE
    kind = object if wide else np.int64
    weight = np.array([1 << int(s) for s in shift], kind)
    starts = np.flatnonzero(np.r_[True, np.diff(dims) > 0])
    ones = np.add.reduceat(np.bitwise_count(planes).sum(axis=1, dtype=np.int64).astype(kind) * weight, starts)
    product = np.add.reduceat(np.add.reduceat(both.astype(kind) * weight[:, None] * weight[None, :], starts, axis=0), starts, axis=1)
    low = low.astype(kind)
    shifted = low[:, None] * ones[None, :]
    return ones + n * low, product + shifted + shifted.T + n * low[:, None] * low[None, :]


def limbs(values: np.ndarray) -> list[np.ndarray]:
    """values as sums of limb * 2 ** (LIMB_BITS * k); the last limb carries the sign."""
    out = []
    for _ in range(LIMBS - 1):
        out.append((values & ((1 << LIMB_BITS) - 1)).astype(np.int64))
        values = values >> LIMB_BITS
    return [*out, values.astype(np.int64)]


@dataclass
class Sums:
    """n, and exact sums of the dimensions and of their products, as integers of any length."""

    n: int
    total: np.ndarray
    product: np.ndarray

    def covariance(self) -> np.ndarray:
        """Centred as integers, each entry rounded once."""
        centred = self.n * self.product - np.outer(self.total, self.total)
        return np.array([[int(c) / self.n**2 for c in row] for row in centred]).reshape(centred.shape)


def cross_products(vectors: DataFrame, dim: int, block_rows: int = BLOCK_ROWS) -> Sums:
    """Sums over x (array of long, dim long each)."""
    upper = np.triu_indices(dim)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, product = 0, np.zeros(dim, object), np.zeros(len(upper[0]), object)
        held: list[np.ndarray] = []

        def add() -> None:
            nonlocal n, total, product
            x = np.concatenate(held)
            held.clear()
            for a in range(0, len(x), block_rows):
                s, p = block_sums(x[a : a + block_rows])
                n, total, product = n + len(x[a : a + block_rows]), total + s, product + p[upper]

        for batch in batches:
            held.append(matrix(batch.column(0), dim))
            if sum(map(len, held)) >= block_rows:
                add()
        if held:
            add()
        if n:
            values = np.concatenate([np.array([n], object), total, product])
            place = np.arange(len(values))
            yield pa.RecordBatch.from_arrays([pa.array(place), *map(pa.array, limbs(values))], names=["place", *(f"l{k}" for k in range(LIMBS))])

    names = [f"l{k}" for k in range(LIMBS)]
    found = vectors.select("x").mapInArrow(run, "place long, " + ", ".join(f"{c} long" for c in names)).groupBy("place").agg(*(F.sum(c).alias(c) for c in names))
    values = np.zeros(1 + dim + len(upper[0]), object)
    for r in found.toLocalIterator():
        values[r["place"]] = sum(r[c] << LIMB_BITS * k for k, c in enumerate(names))
    product = np.zeros((dim, dim), object)
    product[upper] = values[1 + dim :]
    product.T[upper] = values[1 + dim :]
    return Sums(int(values[0]), values[1 : 1 + dim], product)


@dataclass
class Whitening:
    """Unit eigenvectors as columns, by falling eigenvalue; usable: those that can be whitened."""

    n: int
    total: np.ndarray
    vectors: np.ndarray
    values: np.ndarray
    trace: float

    @classmethod
    def of(cls, sums: Sums, components: int) -> Whitening:
        v = sums.covariance()
        values, vectors = np.linalg.eigh(v)
        order = np.argsort(-values, kind="stable")[:components]
        vectors = vectors[:, order]
        vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))])
        return cls(sums.n, sums.total, vectors, values[order], float(np.trace(v)))

    @property
    def usable(self) -> np.ndarray:
        return self.values > 1e-12 * self.trace

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact."""
        big = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) * self.n + max((abs(int(s)) for s in self.total), default=0) >= SAFE
        return x.astype(object) * self.n - self.total if big else x * self.n - self.total.astype(np.int64)

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(self.usable, (centred.astype(np.float64) / self.n) @ self.vectors / np.sqrt(np.abs(self.values)), np.nan)


def squared(centred: np.ndarray) -> list[int]:
    """Each row's sum of squares, exact."""
    most = max(abs(int(centred.max(initial=0))), abs(int(centred.min(initial=0))))
    kind = object if most**2 * centred.shape[1] >= SAFE else np.int64
    return [int(s) for s in (centred.astype(kind) ** 2).sum(axis=1)]


def identity_error(vectors: DataFrame, w: Whitening, dim: int) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity, measured from the rows."""
    use = np.flatnonzero(w.usable)
    k = len(use)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for batch in batches:
            own = w.whitened(w.centred(matrix(batch.column(0), dim)))[:, use]
            total += own.T @ own  # their means are 0: S / n was taken off
        i, j = np.triu_indices(k)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total[i, j])], names=["i", "j", "value"])

    found = vectors.select("x").mapInArrow(run, "i long, j long, value double").groupBy("i", "j").agg(F.sum("value").alias("value"))
    return found.agg(F.max(F.abs(F.col("value") / w.n - (F.col("i") == F.col("j")).cast("double")))).first()[0] or 0.0


def whiten(vectors: DataFrame, components: int = 32, scale: float = 64.0, offset: int = 1_000_000, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, n, deviation (decimal, null beyond 38 digits) and whitened (one double a component), and of the whole: explained, identity_error."""
    work = Scratch(vectors.sparkSession)
    v = F.col(vector_col)
    made = vectors.filter(usable(v, scale, offset)).select(F.col(id_col).alias("vec_id"), integers(v, scale, offset).alias("x"))
    # written once: narrow, and the same rows for the sums, the measured error and the result
    made = work.saved(made, "integers")
    lengths = made.groupBy(F.size("x").alias("dim")).count().orderBy(F.col("count").desc(), F.col("dim").desc()).first()
    dim = lengths["dim"] if lengths else 0
    kept = made.filter(F.size("x") == dim)
    w = Whitening.of(cross_products(kept, dim), components) if dim else None
    error = identity_error(kept, w, dim) if w is not None and w.usable.any() else 0.0
    kind = vectors.select(id_col).schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            c = w.centred(matrix(batch.column(1), dim))
            flat = w.whitened(c).ravel()
            ends = pa.array(np.arange(0, len(flat) + 1, len(w.values)), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([str(s) for s in squared(c)]), pa.ListArray.from_arrays(ends, pa.array(flat, mask=np.isnan(flat)))], names=["vec_id", "deviation", "whitened"])

    rows = kept.mapInArrow(run, f"vec_id {kind}, deviation string, whitened array<double>")
    share = [float(e / w.trace) for e in w.values] if w is not None and w.trace > 0 else [None] * (len(w.values) if w is not None else 0)
    return rows.select(
        "vec_id",
        F.lit(w.n if w is not None else 0).cast("long").alias("n"),
        F.expr("try_cast(deviation AS decimal(38, 0))").alias("deviation"),
        "whitened",
        F.array(*map(F.lit, share)).cast("array<double>").alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whiten(table(spark, sf_dir, "embeddings"), 32)
    each = found.select("vec_id", "n", F.expr("try_cast(deviation AS long)").alias("deviation"), F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "one"), "identity_error")
    return each.select("vec_id", (F.col("at") + 1).cast("int").alias("component"), "n", "deviation", F.col("one.whitened").alias("whitened"), F.col("one.explained").alias("explained"), "identity_error")
