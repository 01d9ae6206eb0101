"""Exact stratified and time splits, classification report."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace import constants as K
from millrace.session import checkpointed

# Rows are shuffled by a linear hash modulo a prime, and the hash range is cut
# into pieces; only the piece a class's cut falls into is ranked row by row.
PRIME, FACTOR = 2_147_483_647, 1_103_515_245
PIECES = 65_536
# Cuts of this many classes are broadcast; more are joined with a shuffle.
BROADCAST_CLASSES = 100_000


def hashed(column: str, seed: int = K.SPLIT_SEED) -> Column:
    """A repeatable shuffle of an integer column, from 0 to PRIME - 1."""
    return (F.pmod(F.col(column).cast("long"), F.lit(PRIME)) * FACTOR + seed) % PRIME


def stratified_split(
    df: DataFrame,
    label: str = K.LABEL,
    key: str = "event_id",
    test_share: float = K.TEST_SHARE,
    seed: int = K.SPLIT_SEED,
) -> DataFrame:
    """Add ``is_test``: exactly round(share * n) rows of each class.

    The test rows are the first ones in the order (hash, key), which is total
    for a unique key. Counts per piece of the hash range say in which piece the
    cut lies, and counts per key of that one piece at which key; both read the
    label and the key only. Earlier rows are test, later ones are not. Rows are
    ranked one by one only where the cut falls among rows of one repeated key.
    Rows without a key come last in that order, in a piece of their own. The
    cuts stay a table, one row per class.
    """
    # Keep the key's pieces as integers: the hash is below 2**31.
    piece = F.floor(hashed(key, seed) * PIECES / F.lit(PRIME)).cast("int")
    piece = F.coalesce(piece, F.lit(PIECES))
    place = F.struct(F.col(key).isNull().alias("no_key"), hashed(key, seed).alias("hash"), F.col(key).alias("key"))
    counts = (
        df.groupBy(F.col(label).alias("_class"), piece.alias("_piece"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    per_class = Window.partitionBy("_class")
    upto = F.sum("_n").over(per_class.orderBy("_piece"))
    take = F.round(F.sum("_n").over(per_class) * test_share).cast("long")
    cuts = (
        counts.withColumns({"_upto": upto, "_take": take})
        .where(F.col("_upto") >= F.col("_take"))
        .groupBy("_class")
        .agg(
            F.min("_piece").alias("_cut"),
            F.min_by(F.col("_take") - F.col("_upto") + F.col("_n"), "_piece").alias("_rest"),
        )
    )
    cuts = checkpointed(cuts)
    if few := cuts.count() <= BROADCAST_CLASSES:
        cuts = F.broadcast(cuts)
    # Of the keys in a cut's piece: the last that is wholly test, and the one that is in part.
    keys = df.select(F.col(label).alias("_label"), piece.alias("_piece"), place.alias("_place"))
    keys = keys.join(cuts, F.col("_label").eqNullSafe(F.col("_class")) & (F.col("_piece") == F.col("_cut")))
    keys = keys.groupBy("_class", "_cut", "_rest", "_place").agg(F.count(F.lit(1)).alias("_n"))
    upto = F.sum("_n").over(per_class.orderBy("_place"))
    before = F.col("_upto") - F.col("_n")
    split_key = (before < F.col("_rest")) & (F.col("_upto") > F.col("_rest"))
    cuts = (
        keys.withColumn("_upto", upto)
        .groupBy("_class", "_cut")
        .agg(
            F.max(F.when(F.col("_upto") <= F.col("_rest"), F.col("_place"))).alias("_last"),
            F.max(F.when(split_key, F.col("_place"))).alias("_part"),
            F.max(F.when(split_key, F.col("_rest") - before)).alias("_some"),
        )
    )
    cuts = checkpointed(cuts)
    in_part = cuts.where("_some is not null").limit(1).count() > 0
    if few:
        cuts = F.broadcast(cuts)
    placed = df.withColumns({"_piece": piece, "_place": place}).join(
        cuts, F.col(label).eqNullSafe(F.col("_class")), "left"
    )
    early = F.coalesce(F.col("_place") <= F.col("_last"), F.lit(False))
    placed = placed.withColumn(
        "is_test", F.when(F.col("_piece") == F.col("_cut"), early).otherwise(F.col("_piece") < F.col("_cut"))
    )
    helpers = ("_piece", "_place", "_class", "_cut", "_last", "_part", "_some")
    if not in_part:
        return placed.drop(*helpers)
    tied = F.coalesce(F.col("_place") == F.col("_part"), F.lit(False))
    within = Window.partitionBy(label).orderBy("_place")
    ranked = placed.where(tied).withColumn("is_test", F.row_number().over(within) <= F.col("_some"))
    return placed.where(~tied).unionByName(ranked).drop(*helpers)


def time_split(
    df: DataFrame, time: str = "t_us", test_share: float = K.TEST_SHARE
) -> DataFrame:
    """Add ``is_test`` for the latest rows, so neighbours do not leak.

    Of n rows with a time, the latest round(test_share * n) are the test; rows of one
    instant stay together, so if the cut falls on an instant, its rows are all trained
    on. Rows without a time are too. The cut is the exact one: counts per piece of the
    range of times say in which piece it lies, which is then cut in the same way until
    one instant is left.
    """
    times = df.select(F.col(time).alias("_t")).where("_t is not null")
    n, low, high = times.agg(F.count(F.lit(1)), F.min("_t"), F.max("_t")).first()
    # How many of the rows from low to high are at or before the cut.
    before = n - math.floor(n * test_share + 0.5)
    if before <= 0:
        return df.withColumn("is_test", F.col(time).isNotNull())
    while low < high:
        share = (F.col("_t") - F.lit(low)).cast("double") / F.lit(float(high - low))
        piece = F.least(F.floor(share * PIECES), F.lit(PIECES - 1))
        counts = (
            times.where(F.col("_t").between(low, high))
            .groupBy(piece.alias("_piece"))
            .agg(F.count(F.lit(1)).alias("_n"), F.min("_t").alias("_low"), F.max("_t").alias("_high"))
        )
        upto = F.sum("_n").over(Window.orderBy("_piece"))
        found = counts.withColumn("_upto", upto).where(F.col("_upto") >= before).orderBy("_piece").first()
        before -= found["_upto"] - found["_n"]
        low, high = found["_low"], found["_high"]
    return df.withColumn("is_test", F.coalesce(F.col(time) > F.lit(low), F.lit(False)))


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.groupBy(
        F.col(label).cast("int").alias("label"),
        F.col(prediction).cast("int").alias("predicted"),
    ).agg(F.count(F.lit(1)).alias("n"))


def classification_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Precision, recall, F1 and support per class, averages and accuracy.

    All from the confusion counts, at most one row per pair of classes. A class
    never predicted, or never present, scores 0 where the ratio is undefined.
    """
    pairs = confusion(df, label, prediction)
    hit = F.when(F.col("label") == F.col("predicted"), F.col("n")).otherwise(0)
    # Each count is seen once by its true class and once by its predicted one.
    sides = F.array(
        F.struct(
            F.col("label").alias("class_id"),
            F.col("n").alias("support"),
            F.lit(0).cast("long").alias("predicted"),
            hit.alias("hits"),
        ),
        F.struct(
            F.col("predicted").alias("class_id"),
            F.lit(0).cast("long").alias("support"),
            F.col("n").alias("predicted"),
            F.lit(0).cast("long").alias("hits"),
        ),
    )
    per_class = (
        pairs.select(F.inline(sides))
        .groupBy("class_id")
        .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
    )

    def ratio(top: str, bottom: str) -> Column:
        return F.when(F.col(bottom) > 0, F.col(top) / F.col(bottom)).otherwise(0.0)

    precision, recall = ratio("hits", "predicted"), ratio("hits", "support")
    scored = per_class.withColumns({"precision": precision, "recall": recall})
    both = F.col("precision") + F.col("recall")
    scored = scored.withColumn(
        "f1",
        F.when(both > 0, 2.0 * F.col("precision") * F.col("recall") / both).otherwise(0.0),
    )
    scores = ("precision", "recall", "f1")
    total = F.sum("support")
    summary = scored.agg(
        *[F.avg(c).alias(f"macro_{c}") for c in scores],
        *[(F.sum(F.col(c) * F.col("support")) / total).alias(f"weighted_{c}") for c in scores],
        (F.sum("hits") / total).alias("accuracy"),
        total.alias("support"),
    )

    def line(name: str, values: list[Column]) -> Column:
        fields = [v.alias(n) for v, n in zip(values, scores)]
        return F.struct(F.lit(name).alias("class_name"), *fields, "support")

    averages = F.array(
        line("accuracy", [F.col("accuracy")] * 3),
        line("macro avg", [F.col(f"macro_{c}") for c in scores]),
        line("weighted avg", [F.col(f"weighted_{c}") for c in scores]),
    )
    classes = scored.select(
        F.col("class_id").cast("string").alias("class_name"), *scores, "support"
    )
    return classes.unionByName(summary.select(F.inline(averages)))
