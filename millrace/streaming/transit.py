"""Gap, edges and transit time over a stream.

Each micro-batch runs the batch operators, sharded as usual, so one busy line
does not sit in a single task. What a line needs of its past is one row: time,
statuses, last release and last transit of its last row. That row is put in
front of the line's new rows. States are Parquet tables by batch number in the
shared folder; a repeated batch reads the same earlier state and writes the
same output again, so a restart after any failure changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from millrace import constants as K
from millrace.functions.columns import is_zero
from millrace.operators.ordered import RECEIPT, RELEASE, add_edges
from millrace.operators.shards import (
    SERIES,
    Series,
    attach,
    carry,
    previous_time,
    shard,
)

_SEED = "_is_seed"


def _state_schema(series: Series, df: DataFrame) -> list[str]:
    keys = [series.line, *series.order]
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    return [f"{k} {types[k]}" for k in keys] + [
        f"{K.STOPPER1} double",
        f"{K.STOPPER3} double",
        "last_release_us bigint",
        "transit_time_seconds double",
    ]


def transit_step(
    batch: DataFrame,
    state: DataFrame,
    series: Series = SERIES,
    rows_per_shard: int | None = None,
    first_dt: float = 0.1,
) -> DataFrame:
    """One batch with its past: adds ``dt``, the flags and the transit time.

    Seed rows from ``state`` stand in front of each line and are kept in the
    result, marked; their release and transit are taken over as they are.
    """
    seeds = state.withColumn(_SEED, F.lit(True))
    rows = batch.withColumn(_SEED, F.lit(False)).unionByName(
        seeds, allowMissingColumns=True
    )
    sharded = shard(rows, series, rows_per_shard)
    timed = previous_time(sharded)
    edged = add_edges(sharded.with_df(timed))
    time, seed = F.col(series.time), F.col(_SEED)
    running = sharded.running()
    df = edged.df.withColumns(
        {
            "dt": F.coalesce((time - F.col("_prev_time")) / 1e6, F.lit(first_dt)),
            "_release": F.when(seed, F.col("last_release_us")).when(
                F.col(RELEASE), time
            ),
            "_seed_transit": F.col("transit_time_seconds"),
        }
    ).drop("_prev_time", "last_release_us", "transit_time_seconds")
    # A release is never later than its row, so the last one is the greatest.
    df = df.withColumn("last_release_us", F.max("_release").over(running))
    before = F.lit(None).cast("double")
    if not sharded.single:
        at_receipt = F.col(RECEIPT) & ~seed
        summary = df.groupBy(*sharded.key).agg(
            F.max("_release").alias("_r"),
            F.max(F.when(at_receipt, time)).alias("_c"),
            F.max(F.when(at_receipt, F.col("last_release_us"))).alias("_s"),
            F.max("_seed_transit").alias("_t"),
        )
        carried = carry(sharded, summary, {"_r_before": F.max("_r")})
        measured = (F.col("_c") - F.coalesce("_s", "_r_before")) / 1e6
        carried = carry(
            sharded,
            carried.withColumn("_m", F.coalesce(measured, F.col("_t"))),
            {"_m_before": F.last("_m", ignorenulls=True)},
        )
        df = attach(sharded, df, carried, "_r_before", "_m_before")
        df = df.withColumn("last_release_us", F.coalesce("last_release_us", "_r_before"))
        before = F.col("_m_before")
    measured = F.when(F.col(RECEIPT), (time - F.col("last_release_us")) / 1e6)
    df = df.withColumn(
        "transit_time_seconds",
        F.when(seed, F.col("_seed_transit")).otherwise(measured),
    )
    local = F.last("transit_time_seconds", ignorenulls=True).over(running)
    filled = df.withColumn("_filled", F.coalesce(local, before))
    return filled.withColumn(
        K.TRANSIT, F.coalesce("_filled", F.lit(K.DEFAULT_TRANSIT_S))
    ).drop("_release", "_seed_transit", "_r_before", "_m_before", "shard")


def next_state(rows: DataFrame, series: Series = SERIES) -> DataFrame:
    """Last row of each line, with what the next batch needs."""
    order = F.struct(*series.order)
    last = F.struct(
        *series.order,
        K.STOPPER1,
        K.STOPPER3,
        "last_release_us",
        F.col("_filled").alias("transit_time_seconds"),
    )
    latest = rows.groupBy(series.line).agg(F.max_by(last, order).alias("_last"))
    return latest.select(series.line, "_last.*")


class TransitStream:
    """``foreachBatch`` sink that keeps one state row per line.

    Output goes to ``{out}/rows/batch=N``, rows older than the state of their
    line to ``{out}/late/batch=N``; no row is lost.
    """

    def __init__(
        self, out: str, series: Series = SERIES, rows_per_shard: int | None = None
    ):
        self.out = out.rstrip("/")
        self.series = series
        self.rows_per_shard = rows_per_shard

    def path(self, kind: str, batch: int) -> str:
        return f"{self.out}/{kind}/batch={batch}"

    def __call__(self, batch: DataFrame, number: int) -> None:
        spark, series = batch.sparkSession, self.series
        if number == 0:
            schema = ", ".join(_state_schema(series, batch))
            state = spark.createDataFrame([], schema)
        else:
            state = spark.read.parquet(self.path("state", number - 1))
        # One row per line; Spark picks the join by its size.
        marks = state.select(
            series.line, F.struct(*series.order).alias("_mark")
        )
        marked = batch.join(marks, series.line, "left")
        late = F.coalesce(F.struct(*series.order) <= F.col("_mark"), F.lit(False))
        marked = marked.withColumn("_late", late).drop("_mark").persist()
        rows = transit_step(
            marked.where(~F.col("_late")).drop("_late"),
            state,
            series,
            self.rows_per_shard,
        ).persist()
        marked.where("_late").drop("_late").write.mode("overwrite").parquet(
            self.path("late", number)
        )
        next_state(rows, series).write.mode("overwrite").parquet(
            self.path("state", number)
        )
        rows.where(~F.col(_SEED)).drop(_SEED, "_filled").write.mode(
            "overwrite"
        ).parquet(self.path("rows", number))
        rows.unpersist()
        marked.unpersist()


def run_transit(
    stream: DataFrame,
    out: str,
    series: Series = SERIES,
    rows_per_shard: int | None = None,
) -> DataFrame:
    """Process what is there, then stop; returns the rows written so far."""
    sink = TransitStream(out, series, rows_per_shard)
    query = (
        stream.writeStream.foreachBatch(sink)
        .option("checkpointLocation", f"{out}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.parquet(f"{out}/rows").drop("batch")
