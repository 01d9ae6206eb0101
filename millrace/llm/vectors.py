"""Near-duplicate vectors by Euclidean p-stable hashing and an exact cosine check."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm import words
from millrace.llm.graph import components
from millrace.llm.tables import stored

#: Width of a quantisation step, for vectors of length 1.
WIDTH = 2.0
#: Least chance with which a pair just at the threshold must meet in some table.
RECALL = 0.92
#: Vectors of a bucket that one task compares at once; larger buckets are tiled.
TILE = 1024


def collision(distance: float, width: float = WIDTH) -> float:
    """Chance that one quantised Gaussian projection is equal for two vectors."""
    if distance <= 0:
        return 1.0
    r = width / distance
    below = 0.5 * math.erfc(r / math.sqrt(2))
    return 1 - 2 * below - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def parameters(rows: int, cosine: float) -> tuple[int, int]:
    """Projections for each table, and tables.

    Unrelated vectors are about the square root of 2 apart. Projections grow with the
    logarithm of the rows, so that a vector meets about as many unrelated ones however
    many there are; tables follow from ``RECALL`` at the threshold.
    """
    near, far = collision(math.sqrt(2 - 2 * cosine)), collision(math.sqrt(2))
    depth = 12 + max(0, math.ceil(math.log(max(rows, 1) / 50_000) / -math.log(far)))
    return depth, math.ceil(math.log(1 - RECALL) / math.log(1 - near**depth))


def near_duplicates(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = 0.9, seed: int = 7) -> DataFrame:
    """``key, n_links, component_id, kept`` for every row.

    Rows link if their cosine, in double precision, is at least ``cosine``; found are
    pairs which share a bucket in one of several hash tables (at least ``RECALL`` of
    those just at the threshold, nearly all closer ones). Equal vectors are compared
    once and counted as often as they occur. Vectors that are null, empty, zero or hold
    null or non-finite components link with nothing, as do vectors of different
    lengths. ``component_id`` is the smallest key reached over links, the own one
    included; ``kept`` marks the row that has it. A row with a null key links with
    nothing, its component is null and it isn't kept. Rows that repeat a key are each
    a row of its own, in components that may differ. Other columns are ignored.
    """
    base = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<float>").alias("v"))
    bad = "exists(v, x -> x is null or isnan(x) or abs(x) = float('inf'))"
    usable = f"id is not null and size(v) > 0 and not {bad} and exists(v, x -> x != 0)"
    base = base.withColumn("ok", F.coalesce(F.expr(usable), F.lit(False)))
    single = base.where("ok").groupBy("v").agg(F.min("id").alias("first"), F.count("*").alias("times"))
    single = stored(single.select(F.monotonically_increasing_id().alias("g"), "v", "first", "times"))
    shape = single.agg(F.count("*"), F.max(F.size("v"))).first()
    depth, tables = parameters(shape[0], cosine)
    rows = single.mapInArrow(_hash(depth, tables, seed), "bucket long, g long, times long, v binary")
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("rows")).where("rows > 1")
    # A bucket of many rows becomes tiles: each row goes to every pair of blocks with its own block.
    tiled = (
        rows.join(sizes, "bucket")
        .withColumn("blocks", F.ceil(F.col("rows") / TILE).cast("int"))
        .withColumn("block", F.expr("cast(pmod(xxhash64(g, bucket), blocks) as int)"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("bucket", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "block", "g", "times", "v")
    )
    found = stored(
        tiled.groupBy("bucket", "x", "y").applyInArrow(_compare(depth, tables, seed, cosine), "g long, root long, links long")
    )
    links = found.groupBy("g").agg(F.sum("links").alias("links"))
    tied = components(found.where("g != root").select(F.col("g").alias("a"), F.col("root").alias("b")))
    member = (
        single.join(tied.withColumnRenamed("node", "g"), "g", "left")
        .join(links, "g", "left")
        .withColumn("component", F.coalesce("component", "g"))
    )
    least = member.groupBy("component").agg(F.min("first").alias("least"))
    member = member.join(least, "component").select(
        "v", "least", (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("links")
    )
    good = base.where("ok").join(member, "v").select("id", "links", "least")
    none = base.where("not ok").select("id", F.lit(0).cast("long").alias("links"), F.col("id").alias("least"))
    return good.unionByName(none).select(
        F.col("id").alias(key),
        F.col("links").alias("n_links"),
        F.col("least").alias("component_id"),
        F.coalesce(F.col("id") == F.col("least"), F.lit(False)).alias("kept"),
    )


def _codes(unit: np.ndarray, depth: int, tables: int, seed: int) -> np.ndarray:
    """A bucket number for each vector (rows) and table (columns)."""
    random = np.random.default_rng([seed, unit.shape[1]])
    lines = random.standard_normal((unit.shape[1], tables * depth))
    shifts = random.uniform(0, WIDTH, tables * depth)
    steps = np.floor((unit @ lines + shifts) / WIDTH).astype(np.int64).view(np.uint64)
    out = np.zeros((len(unit), tables), np.uint64)
    for k in range(depth):
        out = words.mix(out * np.uint64(0x9E3779B97F4A7C15) + steps[:, k::depth])
    return words.mix(out + np.arange(tables, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03), unit.shape[1])


def _units(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _hash(depth: int, tables: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                piece = batch.slice(at, 1024)
                lists = [np.asarray(v.values.to_numpy(zero_copy_only=False), dtype=np.float32) for v in piece.column("v")]
                ids, times = piece.column("g").to_numpy(), piece.column("times").to_numpy()
                for length in sorted({len(v) for v in lists}):
                    rows = [k for k, v in enumerate(lists) if len(v) == length]
                    codes = _codes(_units(np.stack([lists[k] for k in rows])), depth, tables, seed)
                    blobs = pa.array([lists[k].tobytes() for k in rows], pa.binary())
                    for t in range(tables):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(codes[:, t].view(np.int64).copy()), pa.array(ids[rows]), pa.array(times[rows]), blobs],
                            ["bucket", "g", "times", "v"],
                        )

    return run


def _compare(depth: int, tables: int, seed: int, cosine: float):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        bucket, bx, by = (k.as_py() for k in key)
        table = table.combine_chunks()
        ids = table.column("g").to_numpy()
        times, block = table.column("times").to_numpy(), table.column("block").to_numpy()
        unit = _units(np.stack([np.frombuffer(v.as_py(), dtype=np.float32) for v in table.column("v")]))
        codes = _codes(unit, depth, tables, seed)
        here = np.uint64(bucket & 0xFFFFFFFFFFFFFFFF)
        n = len(ids)
        counts, root = np.zeros(n, np.int64), np.arange(n)
        left, right = [], []
        rows_x = np.flatnonzero(block == bx)
        rows_y = np.flatnonzero(block == by)
        for at in range(0, len(rows_x), 256):
            rows = rows_x[at : at + 256]
            i, j = np.nonzero(unit[rows] @ unit[rows_y].T >= cosine)
            i, j = rows[i], rows_y[j]
            if bx == by:
                i, j = i[i < j], j[i < j]
            # A pair counts in the first table in which it meets, and there only.
            for part in range(0, len(i), 65536):
                a, b = i[part : part + 65536], j[part : part + 65536]
                same = codes[a] == codes[b]
                mine = codes[a, same.argmax(axis=1)] == here
                a, b = a[mine], b[mine]
                np.add.at(counts, a, times[b])
                np.add.at(counts, b, times[a])
                left.append(a.astype(np.int32))
                right.append(b.astype(np.int32))
        if left:
            a, b = np.concatenate(left), np.concatenate(right)
            while len(a):
                least = np.minimum(root[a], root[b])
                before = root.copy()
                np.minimum.at(root, a, least)
                np.minimum.at(root, b, least)
                root = root[root]
                if (root == before).all():
                    break
        use = (counts > 0) | (root != np.arange(n))
        return pa.table({"g": pa.array(ids[use]), "root": pa.array(ids[root[use]]), "links": pa.array(counts[use])})

    return run
