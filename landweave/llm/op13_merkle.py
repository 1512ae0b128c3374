"""Merkle manifest of a dataset: a tree a source, a tree over the sources, and changed rows folded by kept hash states.

A leaf is the SHA-256 of a row's fields. Within a source, leaves in order of doc_id, three at a time, become their
parent's digest until one node remains; the sources' nodes likewise give the root. A parent keeps its hash state before
each child slot. To fold a changed row, each parent on its way resumes the state before its slot with the new digest
and the siblings to the right only; siblings to the left are never hashed again. Digests enter as hex text, 64 bytes or
one block each, so a kept state is eight 32-bit numbers.

Leaves are hashed as the texts are read and texts are never shuffled. Rows get their places from one range shuffle and
prefix sums over parts. 3 ** LEVELS consecutive nodes form a block that one task climbs, many blocks at once in arrays; the
blocks' nodes form the next storey, and so on to the root. On the way down each block gets the path above it once. A hot
source is many blocks. No table of nodes passes through the driver, only the root.

Defined results: nulls in any field are hashed as such; null sources are a source of their own, before all
others; null doc_ids come first in their source; rows of one source and doc_id are ordered by leaf; equal rows are
equal leaves side by side; empty and very long texts are hashed whole; one row is leaf, subroot and root in one, with
an empty proof; an empty table gives no rows. Columns that aren't fields are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from landweave.llm.common import Scratch, table
from landweave.llm.sha256 import absorb, finish, hex_text, start

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FAN = 3
#: Levels of a storey: a block has FAN ** LEVELS nodes.
LEVELS = 7
#: Nodes that a task climbs at once, more by a block at most; rows of a part of the range shuffle.
AT_ONCE, PART_ROWS = 20_000, 1_000_000
#: One level of a node's way up: its slot among so many siblings, the parent's state before it, the siblings' digests.
STEP = np.dtype([("slot", "u1"), ("width", "u1"), ("state", "<u4", 8), ("others", "u1", (FAN - 1, 32))])


def leaf_digest(values: dict[str, Column]) -> Column:
    """SHA-256 (32 bytes) over fields in order: a null is `-`, others their UTF-8 byte count, a colon and the value."""
    shown = [F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-")) for c in values.values()]
    return F.unhex(F.sha2(F.concat(*shown), 256))


def starts(t: pa.Table) -> np.ndarray:
    """Where a new block begins."""
    key, block = t["key"].to_numpy(), t["block"].to_numpy()
    return np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (block[1:] != block[:-1])])


def whole_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows of whole blocks, about AT_ONCE of them, and where each block begins."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held += [batch] if batch.num_rows else []
        if sum(b.num_rows for b in held) >= AT_ONCE:
            t = pa.Table.from_batches(held).combine_chunks()
            s = starts(t)
            if len(s) > 1:
                yield t.slice(0, s[-1]).combine_chunks(), s[:-1]
            held = t.slice(s[-1]).to_batches()
    if held:
        t = pa.Table.from_batches(held).combine_chunks()
        yield t, starts(t)


def digests(column: pa.ChunkedArray) -> np.ndarray:
    """Digests as rows of 32 bytes."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, 32)


@dataclass
class Level:
    """What each node of a level needs to rise: whether it does, its parent's place among the next nodes, and its step."""

    rises: np.ndarray
    parent: np.ndarray
    step: np.ndarray


def climb(group: np.ndarray, place: np.ndarray, digest: np.ndarray, full: np.ndarray, levels: int) -> tuple[list[Level], np.ndarray]:
    """Levels of all blocks side by side, and one digest a block.

    group: block of each node, ascending; place: in the source's storey; full: blocks that rise all levels (those
    after their source's first), others rise until one node remains.
    """
    out = []
    for _ in range(levels):
        active = full | (np.bincount(group, minlength=len(full)) > 1)
        if not active.any():
            break
        rises = active[group]
        up = np.where(rises, place // FAN, place)
        first = np.r_[True, (np.diff(group) != 0) | (np.diff(up) != 0)]
        parent = np.cumsum(first) - 1
        width, slot = np.bincount(parent), np.where(rises, place % FAN, 0)
        step = np.zeros(len(group), STEP)
        step["slot"], step["width"] = slot, width[parent]
        kids = np.zeros((len(width), FAN, 32), np.uint8)
        kids[parent, slot] = digest
        state = start(len(width))
        for s in range(FAN):
            at = np.flatnonzero(rises & (slot == s))
            step["state"][at] = state[parent[at]]
            step["others"][at] = kids[parent[at]][:, [k for k in range(FAN) if k != s]]
            state[parent[at]] = absorb(state[parent[at]], digest[at])
        made = np.flatnonzero(rises[first])
        new = digest[first]
        new[made] = finish(state[made], width[made])
        out.append(Level(rises, parent, step))
        group, place, digest = group[first], up[first], new
    return out, digest


def resume(digest: np.ndarray, step: np.ndarray) -> np.ndarray:
    """The parents' digests with digest in the step's slot: the kept state, then what lies to the right."""
    state, slot, width = absorb(step["state"], digest), step["slot"].astype(int), step["width"].astype(int)
    for k in range(FAN - 1):
        at = np.flatnonzero(slot + k < width - 1)
        state[at] = absorb(state[at], step["others"][at, slot[at] + k])
    return finish(state, width)


def placed(rows: DataFrame, key: Column, order: list[Column], work: Scratch, name: str) -> DataFrame:
    """rows with key and place (from 0 within key, in order): one range shuffle, counts within parts, sums over parts."""
    spark = rows.sparkSession
    given = rows.withColumn("key", key)
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-given.count() // PART_ROWS))
    by = [F.col("key"), *order]
    ranged = given.repartitionByRange(n, *by).sortWithinPartitions(*by)
    names = ranged.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, last, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            own = batch.column("key").to_numpy(zero_copy_only=False)
            first = np.r_[own[0] != last, own[1:] != own[:-1]]
            since = np.maximum.accumulate(np.where(first, np.arange(len(own)), -1))
            at = np.where(since < 0, seen + np.arange(len(own)), np.arange(len(own)) - since)
            last, seen = own[-1], int(at[-1]) + 1
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(np.full(len(own), part)), pa.array(at)], names=[*names, "part", "at"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranged.schema)
    numbered = work.saved(ranged.mapInArrow(run, f"{fields}, part long, at long"), f"{name}-numbered")
    sizes = numbered.groupBy("key", "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    bases = sizes.select("key", "part", F.coalesce(before, F.lit(0)).alias("base"))
    out = numbered.join(bases, ["key", "part"]).select(*names, (F.col("base") + F.col("at")).alias("place"))
    out = work.saved(out, name)
    work.drop(f"{name}-numbered")
    return out


def in_blocks(nodes: DataFrame) -> DataFrame:
    """Nodes dealt by block, a block's rows side by side in order."""
    return nodes.repartition("key", "block").sortWithinPartitions("key", "block", F.col("place").asc_nulls_first())


def block_of(place: Column, levels: int) -> Column:
    return F.floor(place / F.lit(FAN**levels)).cast("long")


def next_storey(nodes: DataFrame, levels: int) -> DataFrame:
    """key, place and digest of the blocks' nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, s in whole_blocks(batches):
            block = t["block"].to_numpy()[s]
            group = np.repeat(np.arange(len(s)), np.diff(np.r_[s, t.num_rows]))
            _, top = climb(group, t["place"].to_numpy(), digests(t["digest"]), block > 0, levels)
            yield pa.RecordBatch.from_arrays([t["key"].take(pa.array(s)).combine_chunks(), pa.array(block), pa.array([x.tobytes() for x in top], pa.binary())], names=["key", "place", "digest"])

    return in_blocks(nodes.select("key", block_of(F.col("place"), levels).alias("block"), "place", "digest")).mapInArrow(run, "key string, place long, digest binary")


def storeys(nodes: DataFrame, work: Scratch, name: str, levels: int) -> list[DataFrame]:
    """nodes and the storeys above them; the last has one node a key."""
    out = [nodes]
    while (out[-1].agg(F.max("place")).first()[0] or 0) > 0:
        out.append(work.saved(next_storey(out[-1], levels), f"{name}-{len(out)}"))
    return out


def ways(nodes: DataFrame, above: DataFrame, levels: int) -> DataFrame:
    """Rows for a way down: each block's row of above (key, place = its block, path, subroot) before its nodes."""
    rows = nodes.withColumn("block", block_of(F.col("place"), levels))
    heads = above.select("key", F.col("place").alias("block"), "path", "subroot")
    return in_blocks(rows.unionByName(heads, allowMissingColumns=True))


def split(t: pa.Table, s: np.ndarray) -> tuple[pa.Table, np.ndarray, list[bytes], list[bytes], np.ndarray]:
    """Nodes, block of each, and the blocks' paths above and subroots; heads are the first rows of blocks."""
    heads = t.take(pa.array(s))
    keep = np.ones(t.num_rows, bool)
    keep[s] = False
    nodes = t.filter(pa.array(keep)).combine_chunks()
    group = np.repeat(np.arange(len(s)), np.diff(np.r_[s, t.num_rows]) - 1)
    return nodes, group, heads["path"].to_pylist(), heads["subroot"].to_pylist(), heads["block"].to_numpy() > 0


def own_steps(levels: list[Level], n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each level, the nodes that rise and their steps."""
    at, out = np.arange(n), []
    for level in levels:
        out.append((np.flatnonzero(level.rises[at]), level.step[at]))
        at = level.parent[at]
    return out


def paths_down(nodes: DataFrame, above: DataFrame, levels: int) -> DataFrame:
    """key, place, path (steps up to the root) and subroot of nodes; above: the same of the storey over them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, s in whole_blocks(batches):
            own, group, over, sub, full = split(t, s)
            risen, _ = climb(group, own["place"].to_numpy(), digests(own["digest"]), full, levels)
            path = [b""] * len(group)
            for rising, step in own_steps(risen, len(group)):
                for i in rising.tolist():
                    path[i] += step[i].tobytes()
            yield pa.RecordBatch.from_arrays(
                [own["key"].combine_chunks(), own["place"].combine_chunks(), pa.array([p + over[g] for p, g in zip(path, group.tolist(), strict=True)], pa.binary()), pa.array([sub[g] for g in group.tolist()], pa.binary())],
                names=["key", "place", "path", "subroot"],
            )

    return ways(nodes.select("key", "place", "digest"), above, levels).mapInArrow(run, "key string, place long, path binary, subroot binary")


def folded(leaves: DataFrame, above: DataFrame, id_type: str, levels: int) -> DataFrame:
    """doc_id, source, leaf, subroot, folded_root, proof and steps of every leaf, all hashes as hex text."""

    def text(x: np.ndarray, count: np.ndarray) -> pa.Array:
        """Strings from one run of bytes, count[i] of them in the i-th."""
        return pa.LargeStringArray.from_buffers(len(count), pa.py_buffer(np.r_[0, np.cumsum(count)].astype(np.int64)), pa.py_buffer(np.ascontiguousarray(x))).cast(pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, s in whole_blocks(batches):
            own, group, over, sub, full = split(t, s)
            leaf, n = digests(own["digest"]), len(group)
            steps = own_steps(climb(group, own["place"].to_numpy(), leaf, full, levels)[0], n)
            above_of = [np.frombuffer(p, STEP) for p in over]
            for u in range(max(map(len, above_of))):
                step = np.zeros(len(over), STEP)
                have = np.array([len(p) > u for p in above_of])
                step[have] = [p[u] for p in above_of if len(p) > u]
                steps.append((np.flatnonzero(have[group]), step[group]))
            now = leaf.copy()
            changed = own["replaced"].combine_chunks()
            at = np.flatnonzero(changed.is_valid().to_numpy(zero_copy_only=False))
            now[at] = digests(changed.drop_null())
            others = np.zeros((n, max(len(steps), 1), FAN - 1, 32), np.uint8)
            held = np.zeros(others.shape[:3], bool)
            marks = np.zeros((n, max(len(steps), 1), 2), np.uint8)
            for k, (rising, step) in enumerate(steps):
                own_step = step[rising]
                now[rising] = resume(now[rising], own_step)
                others[rising, k] = own_step["others"]
                held[rising, k] = np.arange(FAN - 1) < own_step["width"][:, None].astype(int) - 1
                marks[rising, k] = np.stack([own_step["slot"], own_step["width"]], axis=1) + ord("0")
            proof = text(hex_text(others[held]).ravel(), 64 * held.sum(axis=(1, 2)))
            shown = text(marks[marks > 0], (marks > 0).sum(axis=(1, 2)))
            full_hex = lambda d: text(hex_text(d).ravel(), np.full(len(d), 64))
            roots = full_hex(digests(pa.chunked_array([pa.array(sub, pa.binary())]))).take(pa.array(group))
            yield pa.RecordBatch.from_arrays([own["doc_id"].combine_chunks(), own["key"].combine_chunks(), full_hex(leaf), roots, full_hex(now), proof, shown], names=["doc_id", "key", "leaf", "subroot", "folded_root", "proof", "steps"])

    rows = ways(leaves.select("key", "place", "digest", "replaced", "doc_id"), above, levels)
    found = rows.mapInArrow(run, f"doc_id {id_type}, key string, leaf string, subroot string, folded_root string, proof string, steps string")
    return found.withColumn("source", F.when(F.col("key") != "", F.expr("substr(key, 2)"))).drop("key")


@dataclass
class Manifest:
    """root; sources: source, n_rows, subroot; rows: doc_id, source, leaf, subroot, folded_root, proof (siblings up to the root, 64 hex digits each) and steps (slot and width of each level, a digit each)."""

    root: str | None
    sources: DataFrame
    rows: DataFrame


def merkle_manifest(docs: DataFrame, revised: dict[str, Column] | None = None, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", source_col: str = "source", levels: int = LEVELS) -> Manifest:
    """The manifest of docs. revised: new values of some fields; folded_root is the root after a row's change alone; levels: of a storey."""
    work = Scratch(docs.sparkSession)
    old = {c: F.col(f"`{c}`") for c in fields}
    new = old | (revised or {})
    same = F.lit(True)
    for c in revised or {}:
        same = same & new[c].eqNullSafe(old[c])
    id_type = docs.select(id_col).schema[0].dataType.simpleString()
    key = F.coalesce(F.concat(F.lit("s"), F.col(f"`{source_col}`").cast("string")), F.lit(""))
    leaves = docs.select(key.alias("key"), F.col(f"`{id_col}`").alias("doc_id"), leaf_digest(old).alias("digest"), F.when(~same, leaf_digest(new)).alias("replaced"), F.monotonically_increasing_id().alias("row"))
    leaves = work.saved(leaves, "leaves")  # texts are read once; sampling for ranges reads these
    # the row number only splits runs of equal rows
    leaves = placed(leaves, F.col("key"), [F.col("doc_id").asc_nulls_first(), F.col("digest"), F.col("row")], work, "placed")
    trees = storeys(leaves.select("key", "place", "digest"), work, "storey", levels)
    subroots = trees[-1].select(F.col("key").alias("source_key"), "digest")
    tops = placed(subroots, F.lit(""), [F.col("source_key")], work, "sources")
    over = storeys(tops.select("key", "place", "digest"), work, "over", levels)
    root = over[-1].first()
    spark = docs.sparkSession
    path = spark.createDataFrame([("", 0, b"", None)], "key string, place long, path binary, subroot binary")
    for k, nodes in enumerate(reversed(over)):
        path = work.saved(paths_down(nodes, path, levels), f"over-path-{k}")
    path = path.drop("key", "subroot").join(tops, "place").select(F.col("source_key").alias("key"), F.lit(0).cast("long").alias("place"), "path", F.col("digest").alias("subroot"))
    path = work.saved(path, "source-paths")
    sizes = leaves.groupBy("key").agg(F.count("*").alias("n_rows"))
    sources = path.join(sizes, "key").select(F.when(F.col("key") != "", F.expr("substr(key, 2)")).alias("source"), "n_rows", F.lower(F.hex("subroot")).alias("subroot"))
    for k, nodes in enumerate(reversed(trees[1:])):
        path = work.saved(paths_down(nodes, path, levels), f"path-{k}")
    return Manifest(root["digest"].hex() if root else None, sources, folded(leaves, path, id_type, levels))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.translate("text", "\n", "")).otherwise(F.col("text"))
    m = merkle_manifest(docs, {"text": tampered})
    root = F.lit(m.root).cast("string")
    return m.rows.select("doc_id", "leaf", "subroot", root.alias("root"), F.sha2("proof", 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == root).alias("verified"))


_HASH = "coalesce(strlen({0}::VARCHAR) || ':' || {0}::VARCHAR, '-')"
_LEAF = "sha256(" + " || ".join(_HASH.format(c) for c in FIELDS) + ")"
#: crc32 of the decimal doc_id, bit by bit.
_CRC = """xor(4294967295, list_reduce(list_concat([4294967295], list_transform(range(1, strlen(doc_id::VARCHAR) + 1), lambda i: ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT)),
  lambda c, b: list_reduce(list_concat([xor(c, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))))"""
_UP = "SELECT lvl + 1, src, place // 3, sha256(string_agg(digest, '' ORDER BY place)) FROM (SELECT *, max(place) OVER (PARTITION BY src) AS m FROM {0}) WHERE m > 0 GROUP BY lvl, src, place // 3"
SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce('s' || source, '') AS src, {_LEAF} AS leaf, {_LEAF.replace("text", "new_text")} AS new_leaf
  FROM (SELECT *, CASE WHEN crc % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS new_text FROM (SELECT *, {_CRC} AS crc FROM documents))),
l AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY doc_id, leaf) - 1 AS place FROM d),
up AS (SELECT 0 AS lvl, src, place, leaf AS digest FROM l UNION ALL {_UP.format("up")}),
tops AS (SELECT src AS of, lvl AS height, digest, row_number() OVER (ORDER BY src) - 1 AS place FROM (SELECT *, max(lvl) OVER (PARTITION BY src) AS m FROM up) WHERE lvl = m),
over_ AS (SELECT 0 AS lvl, '' AS src, place, digest FROM tops UNION ALL {_UP.format("over_")}),
sums AS (SELECT max(lvl) AS height, arg_max(digest, lvl) AS root FROM over_),
nodes AS (SELECT 'doc' AS tree, * FROM up UNION ALL SELECT 'top', * FROM over_),
runs AS (SELECT tree, src, lvl, place // 3 AS up, list(digest ORDER BY place) AS kids FROM nodes GROUP BY ALL),
fold AS (SELECT l.doc_id, l.src, l.place AS leaf_place, l.place, 0 AS lvl, l.new_leaf AS now, '' AS proof FROM l
  UNION ALL SELECT f.doc_id, f.src, f.leaf_place, CASE WHEN f.lvl + 1 = t.height THEN t.place ELSE f.place // 3 END, f.lvl + 1,
    sha256(array_to_string(list_transform(r.kids, lambda x, i: CASE WHEN i = 1 + f.place % 3 THEN f.now ELSE x END), '')),
    f.proof || array_to_string(list_filter(r.kids, lambda x, i: i <> 1 + f.place % 3), '')
  FROM (SELECT f0.*, t.height FROM fold AS f0 JOIN tops AS t ON t.of = f0.src) AS f JOIN tops AS t ON t.of = f.src, sums,
    runs AS r WHERE f.lvl < t.height + sums.height AND r.tree = CASE WHEN f.lvl < t.height THEN 'doc' ELSE 'top' END
    AND r.src = CASE WHEN f.lvl < t.height THEN f.src ELSE '' END AND r.lvl = CASE WHEN f.lvl < t.height THEN f.lvl ELSE f.lvl - t.height END
    AND r.up = f.place // 3)
SELECT l.doc_id, l.leaf, t.digest AS subroot, sums.root, sha256(f.proof) AS proof_sha256, f.now AS folded_root, f.now = sums.root AS verified
FROM l JOIN tops AS t ON t.of = l.src, sums, fold AS f WHERE f.src = l.src AND f.leaf_place = l.place AND f.lvl = t.height + sums.height
"""
