"""Tumbling-window KPIs and source alignment over streams.

Finished rows can be appended once the watermark has passed them (``run_append``), or
rows be put into a table as soon as they are known and replaced when they change
(``run_update``), which also gives what is still open when the input ends.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from millrace.functions.columns import downtime
from millrace.functions.energy import power_saving
from millrace.operators.kpi import down_seconds


def windowed_kpis(
    stream: DataFrame,
    time: str = "timestamp",
    length: str = "10 minutes",
    delay: str = "1 minute",
    line: str = "line_id",
    unique: list[str] | None = None,
) -> DataFrame:
    """Downtime and energy per line and tumbling window.

    The rows carry ``dt`` already (see :mod:`millrace.streaming.transit`). With
    ``unique``, a row delivered twice within the delay counts once. Rows later
    than the watermark are dropped, which is what a watermark means. Partial
    sums are formed before the exchange, so a busy line is one row per task.
    """
    marked = stream.withWatermark(time, delay)
    if unique:
        marked = marked.dropDuplicatesWithinWatermark(unique)
    dt = F.col("dt")
    sums = {"elapsed_s": dt, **down_seconds(dt), "saved_kwh": power_saving() * dt / 3600.0}
    return (
        marked.groupBy(line, F.window(time, length).alias("_window"))
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            *[F.sum(c).alias(name) for name, c in sums.items()],
        )
        .select(
            line,
            F.col("_window.start").alias("window_start"),
            F.col("_window.end").alias("window_end"),
            "n_rows",
            *sums,
        )
    )


def unify_streams(
    streams: list[DataFrame],
    keys: tuple[str, ...] = ("line_id", "timestamp"),
    delay: str = "1 minute",
) -> DataFrame:
    """Inner join of sources on (line, instant), each with its watermark.

    Time is part of the key, so the state of a row is dropped as soon as the
    slowest source has passed its instant. Every further source adds a join with a state
    of its own; many sources are better aligned with :func:`align_streams`.
    """
    *_, time = keys
    marked = [s.withWatermark(time, delay) for s in streams]
    return reduce(lambda left, right: left.join(right, list(keys), "inner"), marked)


def align_streams(
    streams: list[DataFrame],
    keys: tuple[str, ...] = ("line_id", "timestamp"),
    delay: str = "1 minute",
) -> DataFrame:
    """Any number of sources by (line, instant), with one stateful operator.

    The streams are united, each row with its own columns in a struct named after its
    source's place, and gathered by key: ``keys, _0, _1, ...``, a list of each source's
    rows. :func:`aligned` makes the joined rows of it. Every stream has its watermark;
    the state of an instant is dropped when the slowest one has passed it. Rows without
    a key match nothing. Columns that two sources share are refused.
    """
    *_, time = keys
    seen: set[str] = set()
    tagged = []
    for n, df in enumerate(streams):
        own = [c for c in df.columns if c not in keys]
        if seen & {c.lower() for c in own}:
            raise ValueError(f"columns in more than one source: {sorted(seen & {c.lower() for c in own})}")
        seen |= {c.lower() for c in own}
        known = reduce(lambda x, y: x & y, [F.col(k).isNotNull() for k in keys])
        row = df.withWatermark(time, delay).where(known)
        tagged.append(row.select(*keys, F.struct(*own).alias(f"_{n}")))
    united = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), tagged)
    # A list leaves out the nulls, which are the other sources' rows.
    return united.groupBy(*keys).agg(*[F.collect_list(f"_{n}").alias(f"_{n}") for n in range(len(streams))])


def aligned(gathered: DataFrame, keys: tuple[str, ...] = ("line_id", "timestamp")) -> DataFrame:
    """The joined rows of what :func:`align_streams` gathered: of every instant that all
    sources have, each combination of their rows, as in an inner join."""
    sources = [c for c in gathered.columns if c not in keys]
    df = gathered.where(reduce(lambda x, y: x & y, [F.size(s) > 0 for s in sources]))
    for s in sources:
        kept = [c for c in df.columns if c != s]
        df = df.select(*kept, F.inline(s))
    return df


class Upserts:
    """``foreachBatch`` sink for results in update mode.

    The rows of batch N go to ``{out}/changes/batch=N``; a batch delivered again replaces
    its own. :meth:`latest` has, for each key, the row of the last batch that had one.
    """

    def __init__(self, out: str, schema: StructType, keys: tuple[str, ...]):
        self.path, self.schema, self.keys = f"{out.rstrip('/')}/changes", schema, list(keys)

    def __call__(self, batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{self.path}/batch={number}")

    def latest(self, spark: SparkSession) -> DataFrame:
        stored = StructType([*self.schema.fields]).add("batch", "long")
        rows = spark.read.schema(stored).parquet(self.path)
        values = [c for c in self.schema.fieldNames() if c not in self.keys]
        last = rows.groupBy(*self.keys).agg(F.max_by(F.struct(*values), "batch").alias("_row"))
        return last.select(*self.keys, *[F.col("_row")[c].alias(c) for c in values])


def run_update(result: DataFrame, out: str, keys: tuple[str, ...]) -> DataFrame:
    """Keep a table of the newest row of each key until the input is used up.

    Unlike appended rows, these include windows and instants that are still open.
    """
    spark = result.sparkSession
    sink = Upserts(out, result.schema, keys)
    sink(spark.createDataFrame([], result.schema), -1)
    query = (
        result.writeStream.foreachBatch(sink)
        .outputMode("update")
        .option("checkpointLocation", f"{out}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return sink.latest(spark)


def run_append(result: DataFrame, out: str) -> DataFrame:
    """Write a finished-rows stream to Parquet until the input is used up."""
    query = (
        result.writeStream.format("parquet")
        .outputMode("append")
        .option("path", f"{out}/rows")
        .option("checkpointLocation", f"{out}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return result.sparkSession.read.schema(result.schema).parquet(f"{out}/rows")
