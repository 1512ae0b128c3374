"""Best-fit packing of token sequences with Martello-Toth dominance reduction.

Item sizes are integers of at most the capacity, so an instance is a histogram: how many items there are
of each size. The driver packs the histogram (never the items): its work and memory depend on the
capacity alone. First, sets of up to three items that provably dominate every other set holding the
largest item are fixed for good; the rest is packed by best-fit decreasing, many equal bins at once. Spark
then gives every item its rank among the items of its size and so its place in a bin.

Defined results: a null or empty text is its end id alone, one piece; a very long text is cut into pieces of the capacity,
the first of them maybe shorter; equal documents, repeated rows and rows of one or no doc_id are packed each; items
of one size are alike, so a tie gives any of them either place, by their partition and their order in it; an empty table
gives no rows. Other columns pass through pack; those named sequence_id and offset are replaced, and __part, __at and
__size are the operator's own and not kept.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from landweave.llm.common import saved, table
from landweave.llm.tokens import codec, vocabulary


@dataclass
class Plan:
    """Bins by pattern: (item sizes in order, number of bins)."""

    capacity: int
    patterns: list[tuple[tuple[int, ...], int]] = field(default_factory=list)

    @property
    def n_bins(self) -> int:
        return sum(n for _, n in self.patterns)

    def slots(self) -> dict[int, np.ndarray]:
        """For each size, rows (first rank, first bin, offset): items of a size take slots in rank order."""
        used: dict[int, int] = {}
        out: dict[int, list[tuple[int, int, int]]] = {}
        first = 0
        for sizes, n in self.patterns:
            offset = 0
            for s in sizes:
                out.setdefault(s, []).append((used.get(s, 0), first, offset))
                used[s] = used.get(s, 0) + n
                offset += s
            first += n
        return {s: np.array(rows, np.int64) for s, rows in out.items()}


def reduce_dominated(counts: dict[int, int], capacity: int) -> tuple[list[tuple[tuple[int, ...], int]], dict[int, int]]:
    """Fix dominating sets around the largest item while one is found; returns fixed patterns and what is left.

    A set dominates another if the other's items can be spread over its own, none overfilled. For the
    largest item j and room r = capacity - j: nothing else fits, {j}; an item of size r exists, or no two
    others fit together, {j, k} with the largest k that fits; two fit but never three, {j, k} when k is at
    least any pair's sum, or {j, a, b} when a is the largest that fits, a + b = r, and no two items larger
    than b fit together.
    Sizes without such a set are set aside, and the next smaller one is tried.
    """
    left = {s: n for s, n in counts.items() if n > 0}
    order = sorted(left)
    fixed: list[tuple[tuple[int, ...], int]] = []

    def take(items: tuple[int, ...]) -> None:
        need = {s: items.count(s) for s in set(items)}
        n = min(left[s] // k for s, k in need.items())
        assert n > 0
        fixed.append((items, n))
        for s, k in need.items():
            left[s] -= n * k
            if not left[s]:
                del left[s]
                order.pop(bisect.bisect_left(order, s))

    def others(j: int, most: int) -> list[int]:
        """Sizes up to most that are there besides one item of size j."""
        found = order[: bisect.bisect_right(order, most)]
        return [s for s in found if s != j] if left[j] == 1 else found

    j = order[-1] if order else 0
    while j:
        room = capacity - j
        fits = others(j, room)
        if not fits:
            take((j,))
        elif fits[-1] == room:
            take((j, room))
        else:
            low = [x for s in fits[:3] for x in [s] * min(3, left[s] - (s == j))][:3]
            if len(low) < 2 or low[0] + low[1] > room:
                take((j, fits[-1]))
            else:
                best, pair = 0, None
                for a in reversed(fits):
                    at = bisect.bisect_right(fits, min(a, room - a)) - 1
                    if at >= 0 and fits[at] == a and left[a] - (a == j) < 2:
                        at -= 1
                    if at >= 0 and a + fits[at] > best:
                        best, pair = a + fits[at], (a, fits[at])
                three = len(low) == 3 and sum(low) <= room
                above = [x for s in fits[bisect.bisect_right(fits, pair[1]) :][:2] for x in [s] * min(2, left[s] - (s == j))][:2]
                if not three and fits[-1] >= best:
                    take((j, fits[-1]))
                elif not three and best == room and pair[0] == fits[-1] and (len(above) < 2 or sum(above) > room):
                    take((j, *pair))
                else:
                    j = order[at - 1] if (at := bisect.bisect_left(order, j)) else 0
                    continue
        at = bisect.bisect_right(order, j)
        j = order[at - 1] if at else 0
    return fixed, left


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing over a histogram: open bins are kept by room, equal bins together."""
    open_bins: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    rooms: list[int] = []

    def put(room: int, items: tuple[int, ...], n: int) -> None:
        if room not in open_bins:
            open_bins[room] = []
            bisect.insort(rooms, room)
        open_bins[room].append((items, n))

    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            at = bisect.bisect_left(rooms, size)
            if at == len(rooms):
                per = capacity // size
                if full := left // per:
                    put(capacity - per * size, (size,) * per, full)
                if rest := left - full * per:
                    put(capacity - rest * size, (size,) * rest, 1)
                break
            room = rooms[at]
            items, n = open_bins[room].pop()
            if not open_bins[room]:
                del open_bins[room]
                rooms.pop(at)
            moved = min(n, left)
            if n > moved:
                put(room, items, n - moved)
            put(room - size, (*items, size), moved)
            left -= moved
    return [x for bins in open_bins.values() for x in bins]


def plan_packing(counts: dict[int, int], capacity: int) -> Plan:
    if any(s < 1 or s > capacity for s in counts):
        raise ValueError("item sizes go from 1 to the capacity")
    fixed, left = reduce_dominated(counts, capacity)
    return Plan(capacity, fixed + best_fit(left, capacity))


def pack(items: DataFrame, capacity: int, length_col: str = "length") -> DataFrame:
    """items with sequence_id and offset: sequences of at most capacity, gapless from offset 0.

    Lengths go from 1 to capacity; null or other lengths are an error. items is read twice, so it should be
    a table (or cheap); columns of any names pass through, but for sequence_id and offset, which are
    replaced. Equal rows are separate items. Ranks come from counts by (size, partition) and an order
    inside each, both of which spread over the cluster; the driver gets one number for each size.
    """
    clash = [c for c in ("sequence_id", "offset") if c in items.columns]
    rows = saved(items.drop(*clash).withColumns({"__part": F.spark_partition_id(), "__at": F.monotonically_increasing_id(), "__size": F.col(length_col).cast("int")}), "pack-items")
    per = rows.groupBy("__size", "__part").agg(F.count("*").alias("__n"))
    per = saved(per, "pack-sizes")
    counts = {r[0]: r[1] for r in per.groupBy("__size").agg(F.sum("__n")).collect()}
    if None in counts:
        raise ValueError("a length is null")
    slots = plan_packing(counts, capacity).slots()
    shared = items.sparkSession.sparkContext.broadcast(slots)
    base = per.withColumn("__base", F.sum("__n").over(Window.partitionBy("__size").orderBy("__part")) - F.col("__n")).drop("__n")
    rank = F.row_number().over(Window.partitionBy("__part", "__size").orderBy("__at")) - 1
    # the bases grow with the partitions, so they are merged, never broadcast; items stay dealt as for their rank
    ranked = rows.withColumn("__rank", rank).join(base.hint("merge"), ["__part", "__size"])
    ranked = ranked.withColumn("__rank", F.col("__rank") + F.col("__base")).drop("__part", "__at", "__base")
    keep = [c for c in rows.columns if c not in ("__part", "__at", "__size")]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table_of = shared.value
        for batch in batches:
            sizes, ranks = batch.column("__size").to_numpy(), batch.column("__rank").to_numpy()
            seq, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
            order = np.argsort(sizes, kind="stable")
            cut = np.flatnonzero(np.diff(sizes[order])) + 1
            for own in np.split(order, cut):
                if len(own):
                    rows_of = table_of[int(sizes[own[0]])]
                    k = np.searchsorted(rows_of[:, 0], ranks[own], "right") - 1
                    seq[own], offset[own] = rows_of[k, 1] + ranks[own] - rows_of[k, 0], rows_of[k, 2]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(seq), pa.array(offset)], names=[*keep, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name in keep)
    return ranked.mapInArrow(place, f"{schema}, sequence_id long, offset long")


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int | None = 0, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of at most capacity tokens: doc_id, piece (from 0), start, length, ids_crc32 and, if asked for, ids.

    Null text: empty, so its end id alone. Only longer documents are cut; the first piece may be shorter.
    A document without ids (no end_id, empty text) has no piece. Other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(tokenizer)
        for batch in batches:
            ids, counts = c.encode(batch.column(1))
            if end_id is not None:
                ids, counts = np.insert(ids, np.cumsum(counts), end_id), counts + 1
            pieces = -(-counts // capacity)
            doc = np.repeat(np.arange(len(counts)), pieces)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            short = counts - capacity * (pieces - 1)
            start = np.where(piece == 0, 0, short[doc] + (piece - 1) * capacity)
            length = np.where(piece == 0, short[doc], capacity)
            at = ((np.cumsum(counts) - counts)[doc] + start).tolist()
            view = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B") if len(ids) else b""
            spans = [view[4 * a : 4 * (a + n)] for a, n in zip(at, length.tolist(), strict=True)]
            out = {"doc_id": batch.column(0).take(pa.array(doc)), "piece": pa.array(piece, pa.int32()), "start": pa.array(start), "length": pa.array(length), "ids_crc32": pa.array([zlib.crc32(x) for x in spans], pa.int64())}
            if with_ids:
                out["ids"] = pa.ListArray.from_arrays(pa.array(np.append(np.cumsum(length) - length, length.sum()), pa.int32()), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_pydict(out)

    return rows.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = token_pieces(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))
    return pack(pieces, 2048).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
