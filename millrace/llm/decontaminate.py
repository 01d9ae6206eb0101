"""Test items inside documents: MinHash nominates, exact shingle containment decides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from millrace.llm.tables import bounded, stored

#: Rows of item shingles or candidates that may be broadcast; more are joined by shuffle.
BROADCAST_ROWS = 200_000


def _words(text: Column) -> Column:
    """Runs of letters and digits, A-Z as a-z."""
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(lower, "[^\\p{L}\\p{N}]+"), lambda w: w != "")


def _shingles(words: Column, width: int) -> Column:
    """Hashes of runs of ``width`` words; a shorter text's whole sequence is its one."""
    runs = F.transform(
        F.sequence(F.lit(1), F.size(words) - (width - 1)), lambda i: F.xxhash64(F.slice(words, i, F.lit(width)))
    )
    return (
        F.when(F.size(words) >= width, runs)
        .when(F.size(words) > 0, F.array(F.xxhash64(F.lit(-1), words)))
        .otherwise(F.array().cast("array<bigint>"))
    )


def contained(docs: DataFrame, items: DataFrame, key: str = "doc_id", item: str = "item_id", text: str = "text", width: int = 5, share: float = 0.75) -> DataFrame:
    """``key, item, n_item, n_shared, containment`` for every document and test item
    of whose shingles the document holds at least ``share``.

    Words are runs of letters and digits, A-Z as a-z, so other signs and line breaks
    don't hide a passage. Items are parted by size, in powers of two. An item's MinHash
    sketch is its shingles with the least hash values, as many as an item of its part
    can lack and one more; so a document that holds enough of the item holds one of
    these. Documents are looked through for sketches, however long they are; only
    documents with a hit are looked at again, for all shingles of the items they hit.

    An item or document with fewer than ``width`` words has its whole sequence as its
    one shingle; without words it matches nothing, as do null texts and null keys.
    Repeated rows of a key or an item count as one text each with all shingles of the
    rows. Other columns are ignored.
    """
    goods = items.select(F.col(item).alias("item"), _words(F.col(text).cast("string")).alias("w")).where("item is not null")
    goods = goods.select("item", F.explode(_shingles(F.col("w"), width)).alias("h")).distinct()
    size = Window.partitionBy("item")
    goods = goods.withColumn("n", F.count("*").over(size))
    # The largest size of the item's part: sizes from 2^k to 2^(k+1)-1.
    part = F.floor(F.log2(F.col("n").cast("double"))).cast("int")
    most = F.pow(F.lit(2.0), part + 1) - 1
    goods = goods.withColumn("sketch", F.floor(most * (1 - share) + 1e-9) + 1)
    goods = goods.withColumn("order", F.row_number().over(size.orderBy(F.xxhash64(F.lit(5), "h"), "h")))
    goods = stored(goods.select("item", "h", "n", (F.col("order") <= F.col("sketch")).alias("probe")))
    base = docs.select(F.col(key).alias("id"), F.col(text).cast("string").alias("text")).where("id is not null and text is not null")
    # The words are a column of their own, so that they are split once for all shingles.
    rows = base.select("id", _words(F.col("text")).alias("w"))
    rows = rows.select("id", F.explode(_shingles(F.col("w"), width)).alias("h"))
    probes = goods.where("probe").groupBy("h").agg(F.collect_set("item").alias("items"))
    # A sketch value may be in many items; each then is a candidate.
    hits = rows.join(bounded(probes, BROADCAST_ROWS, goods), "h").select("id", F.explode("items").alias("item")).distinct()
    hits = stored(hits)
    several = hits.select("id").distinct()
    again = base.join(bounded(several, BROADCAST_ROWS), "id")
    rows = again.select("id", _words(F.col("text")).alias("w"))
    rows = rows.select("id", F.explode(_shingles(F.col("w"), width)).alias("h")).distinct()
    wanted = hits.join(bounded(goods, BROADCAST_ROWS).select("item", "h", "n"), "item")
    return (
        rows.join(wanted, ["id", "h"])
        .groupBy("id", "item", "n")
        .agg(F.count("*").alias("n_shared"))
        .where(f"n_shared >= {share} * n")
        .select(
            F.col("id").alias(key),
            F.col("item").alias(item),
            F.col("n").alias("n_item"),
            "n_shared",
            (F.col("n_shared") / F.col("n")).alias("containment"),
        )
    )
