"""Intermediate tables in the shared folder, and joins that broadcast only what is small."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.session import scratch


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder as Parquet and read again.

    It is computed once, survives lost executors, and takes less space than a
    checkpoint, which isn't compressed. The folder is not removed, as the result may be
    read at any later time; scratch folders are named by their use.
    """
    path = scratch(df.sparkSession, "stored")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded(df: DataFrame, rows: int, counted: DataFrame | None = None) -> DataFrame:
    """``df`` marked for broadcast if it (or ``counted``) has at most ``rows`` rows.

    Beyond that it is left as it is, to be joined by shuffle; the result is the same.
    """
    return F.broadcast(df) if (counted or df).limit(rows + 1).count() <= rows else df


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Stages that run meanwhile send Python at most ``rows`` rows at a time.

    For wide rows: a batch is held several times over, by the executor and by its Python
    workers, which keep the memory when they are done.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    if not 0 < int(before) <= rows:
        spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)
