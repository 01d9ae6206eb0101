"""Bronze, silver and gold tables as Parquet datasets split by day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.functions.columns import coerce_numeric, parse_time
from millrace import constants as K

DAY = "day"


def with_time(df: DataFrame, text: str = K.TIME_TEXT) -> DataFrame:
    """Add ``timestamp``, its exact microseconds ``t_us`` and the ``day``."""
    timed = df.withColumn("timestamp", parse_time(F.col(text)))
    return timed.withColumns(
        {
            "t_us": F.unix_micros("timestamp"),
            DAY: F.to_date("timestamp"),
        }
    )


def write_layer(
    df: DataFrame, path: str, order: tuple[str, ...] = (), arrange: bool = True
) -> None:
    """Write a layer by day, replacing it.

    ``arrange`` first brings the rows of a day together; the rebalance hint
    lets the engine split a day that holds most of the rows and join small
    ones, so file sizes stay even. ``order`` sorts inside the files, which makes
    their min/max statistics useful to filters on line and time.
    """
    if arrange:
        df = df.hint("rebalance", DAY)
    if order:
        df = df.sortWithinPartitions(DAY, *order)
    df.write.mode("overwrite").partitionBy(DAY).parquet(path)


def read_layer(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_bronze(df: DataFrame, path: str) -> None:
    """Raw rows as loaded, by day; rows of unreadable time are kept too.

    Raw files are written in time order, so no exchange is needed here.
    """
    write_layer(
        df.withColumn(DAY, F.to_date(parse_time(F.col(K.TIME_TEXT)))),
        path,
        arrange=False,
    )


def read_bronze(
    spark: SparkSession, path: str, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Bronze rows ready to join: numbers as doubles, time parsed."""
    raw = read_layer(spark, path).drop(DAY)
    return with_time(coerce_numeric(raw, (*K.TEXT_COLUMNS, *keep)))


def load_gold(spark: SparkSession, path: str) -> DataFrame:
    """Gold for KPI use, with the zone stripped from ``timestamp``."""
    return read_layer(spark, path).withColumn(
        "timestamp", F.col("timestamp").cast("timestamp_ntz")
    )
