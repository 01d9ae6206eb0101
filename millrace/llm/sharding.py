"""Shards that all hold the same mixture of sources."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from millrace.llm.tables import stored

#: Rows that one bucket of an ordering holds at most, about.
BUCKET_ROWS = 1_000_000


def interleave(docs: DataFrame, shards: int = 16, key: str = "doc_id", source: str = "source", seed: str = "mix") -> DataFrame:
    """``docs`` with ``shard`` and ``slot``, replacing columns of these names.

    The rows of each source are shuffled by a seeded hash of the key and ranked; all
    rows are then ordered by rank relative to the source's size and cut into ``shards``
    stretches. So each shard has the same share of every source, and shards differ by
    at most one row. ``slot`` counts from 0 in each shard. A null source is a source of
    its own. Rows with a null key, and rows that repeat a key, are shuffled by their
    place in the input too. Every row is placed once, whatever its other columns are;
    an empty table gives an empty result.

    No task orders a whole source: the hash, and later the relative rank, is cut into
    buckets, rows are numbered within buckets, and the numbers of rows before each
    bucket are added. The columns given are written once to the shared folder, so that
    a row's place in the input stays the same whatever is recomputed; pass only those
    that the shards need.
    """
    carry = [c for c in docs.columns if c not in ("shard", "slot")]
    names = [f"c{k}" for k in range(len(carry))]
    base = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(carry, names)])
    key, source = names[carry.index(key)], names[carry.index(source)]
    base = stored(base.withColumn("row", F.monotonically_increasing_id()))
    total = base.count()
    digits = max(3, math.ceil(math.log(max(total, 1) / BUCKET_ROWS, 16)))
    repeated = base.groupBy(key).agg(F.count("*").alias("n")).where(f"n > 1 and {key} is not null")
    place = F.when(F.col(key).isNull() | F.col("twice").isNotNull(), F.concat(F.lit(":"), F.col("row"))).otherwise("")
    mixed = (
        base.join(repeated.select(key, F.lit(True).alias("twice")), key, "left")
        .withColumn("stratum", F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("")))
        .withColumn("h", F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")), place).cast("binary")))
        .withColumn("bucket", F.conv(F.substring("h", 1, digits), 16, 10).cast("long"))
    )
    inside = Window.partitionBy("stratum", "bucket")
    counts = mixed.groupBy("stratum", "bucket").agg(F.count("*").alias("n"))
    in_source = Window.partitionBy("stratum")
    counts = counts.select(
        "stratum",
        "bucket",
        (F.sum("n").over(in_source.orderBy("bucket")) - F.col("n")).alias("before"),
        F.sum("n").over(in_source).alias("size"),
    )
    ranked = (
        mixed.withColumn("number", F.row_number().over(inside.orderBy("h", "row")) - 1)
        .join(counts, ["stratum", "bucket"])
        .withColumn("rank", F.col("before") + F.col("number"))
        .withColumn("share", (F.col("rank") + 0.5) / F.col("size"))
        .withColumn("cell", F.floor(F.col("share") * 16**digits))
        .drop("before", "number", "bucket")
    )
    cells = ranked.groupBy("cell").agg(F.count("*").alias("n"))
    cells = cells.select("cell", (F.sum("n").over(Window.orderBy("cell")) - F.col("n")).alias("before"))
    order = Window.partitionBy("cell").orderBy("share", "stratum", "rank")
    placed = (
        ranked.withColumn("number", F.row_number().over(order) - 1)
        .join(cells, "cell")
        .withColumn("at", F.col("before") + F.col("number"))
        .withColumn("shard", F.expr(f"cast(at * {shards} div {max(total, 1)} as int)"))
        .withColumn("slot", F.expr(f"at - (cast(shard as bigint) * {total} + {shards - 1}) div {shards}"))
    )
    return placed.select(*[F.col(n).alias(c) for n, c in zip(names, carry)], "shard", "slot")


def digests(docs: DataFrame, shards: int = 16) -> DataFrame:
    """The shards of documents without their texts: sizes and checksums stand for them."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    narrow = docs.select(
        "doc_id",
        "source",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    return interleave(narrow, shards).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "source"
    )


def write(sharded: DataFrame, path: str) -> None:
    """One folder for each shard, rows in the order of their slots within files.

    A shard's rows are dealt over several tasks by slot, so no task holds a whole shard.
    """
    pieces = F.floor(F.col("slot") / BUCKET_ROWS)
    sharded.repartition("shard", pieces).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
