"""Cutting long time series into shards that windows can run on in parallel.

Every ordered operator of this library needs the rows of a line in time order.
A window partitioned by the line alone would put a whole line into one task,
however long it is. Here each line is cut into *shards*, pieces of its time
axis that hold about ``rows_per_shard`` rows (fewer where rows are wide), and
windows are partitioned by (line, shard). What a shard must know of its past comes in one of two ways:

``carry``      one summary row per shard, folded over the earlier shards of
               the line and joined back (last value, running sum, count);
``with_halo``  copies of the last few rows before a shard, for row frames.

Both give exactly the result of one window over the whole line. Summaries have
one row per shard, so the folding windows over a line see a table smaller than
the data by the shard size.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass, replace

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F
from pyspark.sql.types import NumericType

from millrace.session import checkpointed

ROWS_PER_SHARD = 1_000_000
# A task sorts whole shards, so of wide rows a shard holds about this many bytes.
SHARD_BYTES = 64 << 20
# Cut points are chosen from about this many sampled rows per shard. The sample
# only decides where the cuts lie; every row goes to a shard.
SAMPLES_PER_SHARD = 50
# Lines are spread over this many stretches of the axis the cuts are made on.
LINE_SLOTS = 1 << 14
# A halo plan with at most this many (shard, later shard) pairs, each a few
# dozen bytes, is broadcast; a larger one is joined with a shuffle.
BROADCAST_PAIRS = 250_000

SHARD = "shard"
HALO = "is_halo"


@dataclass(frozen=True)
class Series:
    """Names of the columns that identify a line and order its rows."""

    line: str = "line_id"
    time: str = "t_us"
    ties: tuple[str, ...] = ("event_id",)

    @property
    def order(self) -> list[str]:
        return [self.time, *self.ties]


SERIES = Series()


@dataclass(frozen=True)
class Sharded:
    """A table with its ``shard`` column, and whether there is only one shard."""

    df: DataFrame
    series: Series
    single: bool

    @property
    def key(self) -> list[str]:
        return [self.series.line, SHARD]

    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.key).orderBy(*self.series.order)

    def running(self) -> WindowSpec:
        return self.window().rowsBetween(Window.unboundedPreceding, 0)

    def over(self, rows: int | None = None) -> str:
        """The same window as SQL text; with ``rows``, the frame of the last rows."""
        frame = f" ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW" if rows else ""
        keys, order = ", ".join(self.key), ", ".join(self.series.order)
        return f"OVER (PARTITION BY {keys} ORDER BY {order}{frame})"

    def with_df(self, df: DataFrame) -> "Sharded":
        return replace(self, df=df)


def shard(
    df: DataFrame, series: Series = SERIES, rows_per_shard: int | None = None
) -> Sharded:
    """Add ``shard``, a number that never falls along a line.

    Cuts are equal-depth quantiles of (slot of the line, time), so a line with
    a third of all rows gets a third of the shards, and so does a burst. Where
    one position repeats over several quantiles, its rows are cut again by
    exact time and then by the tie columns. A table with a ``shard`` column of
    its own (a stored layer) keeps it.

    Runs one narrow job for the row count, and one per level of cuts if the
    table is larger than a shard. The driver gets the cut points only, one per
    shard. Tie columns may be numbers or text; of text the first six bytes place
    the cuts. The cuts are constants of the plan, so a task that runs
    again after a lost executor puts its rows where they were.
    """
    if SHARD in df.columns:
        first, last = df.agg(F.min(SHARD), F.max(SHARD)).first()
        return Sharded(df, series, single=first == last)
    limit = rows_per_shard or rows_for(df)
    time = F.col(series.time)
    total, low, high = df.agg(F.count(F.lit(1)), F.min(time), F.max(time)).first()
    pieces = math.ceil(total / limit)
    if pieces <= 1:
        return Sharded(df.withColumn(SHARD, F.lit(0).cast("long")), series, single=True)

    slot = F.pmod(F.xxhash64(F.col(series.line)), F.lit(LINE_SLOTS)).cast("double")
    levels = [slot + (time - F.lit(low)) / F.lit(float(high - low + 1))]
    levels += [_axis(df, c) for c in series.order]
    probabilities = [i / pieces for i in range(1, pieces)]
    fraction = min(1.0, SAMPLES_PER_SHARD * pieces / total)
    number, hot = F.lit(0).cast("long"), None
    for value in levels:
        scope = (df if hot is None else df.where(hot)).select(value.alias("_at"))
        if fraction < 1.0:
            scope = scope.sample(fraction, seed=17)
        cuts = scope.approxQuantile("_at", probabilities, 0.25 / pieces)
        repeated = [v for v, n in Counter(cuts).items() if n > 1]
        edges = sorted({*cuts, *(math.nextafter(v, math.inf) for v in repeated)})
        if not edges:
            break
        df = Bucketizer(
            splits=[-math.inf, *edges, math.inf],
            inputCol="_at",
            outputCol="_bucket",
            handleInvalid="keep",
        ).transform(df.drop("_bucket").withColumn("_at", value))
        bucket = F.col("_bucket").cast("long")
        if hot is not None:
            bucket = F.when(hot, bucket).otherwise(F.lit(0))
        df = df.withColumn("_number", number * (len(edges) + 2) + bucket)
        number = F.col("_number")
        if not repeated:
            break
        within = F.col("_at").isin(repeated)
        df = df.withColumn("_hot", within if hot is None else F.col("_hot") & within)
        hot = F.col("_hot")
    df = df.withColumn(SHARD, number).drop("_at", "_bucket", "_number", "_hot")
    return Sharded(df, series, single=False)


def rows_for(df: DataFrame) -> int:
    """Rows of a shard: a million, or as many as ``SHARD_BYTES`` hold of wide ones.

    Numbers count as 8 bytes, other columns as 24.
    """
    width = sum(8 if isinstance(f.dataType, NumericType) else 24 for f in df.schema)
    return max(1, min(ROWS_PER_SHARD, SHARD_BYTES // max(1, width)))


def _axis(df: DataFrame, column: str) -> Column:
    """A column as a number in the same order, for placing cuts."""
    if df.schema[column].dataType.typeName() != "string":
        return F.col(column).cast("double")
    head = F.hex(F.substring(F.col(column).cast("binary"), 1, 6))
    return F.conv(F.rpad(head, 12, "0"), 16, 10).cast("double")


def carry(
    sharded: Sharded, summary: DataFrame, folded: dict[str, Column]
) -> DataFrame:
    """Fold per-shard summaries over the earlier shards of each line.

    ``summary`` has one row per (line, shard). Each column of ``folded`` is an
    aggregate over the summary rows *before* the shard, added to the summary;
    join the wanted columns back with :func:`attach`.
    """
    line, number = sharded.key
    earlier = (
        Window.partitionBy(line)
        .orderBy(number)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return summary.withColumns({name: c.over(earlier) for name, c in folded.items()})


def attach(
    sharded: Sharded, rows: DataFrame, carried: DataFrame, *names: str
) -> DataFrame:
    """Join the named carried values to the rows on (line, shard).

    The carried table, one row per shard, is worked out and stored here, so that a
    chain of operators reads its source once for each of them and once for the rows,
    not twice as often with each. While it is small the rows aren't exchanged for it.
    """
    carried = checkpointed(carried.select(*sharded.key, *names))
    return rows.join(small(carried), sharded.key, "left")


def small(df: DataFrame) -> DataFrame:
    """Broadcast a table that is counted to be small; else leave the join to Spark.

    Give it a stored table, as it is run for the count."""
    return F.broadcast(df) if df.count() <= BROADCAST_PAIRS else df


def previous(sharded: Sharded, names: dict[str, str]) -> DataFrame:
    """Values of the row before, as ``names[column]``; NULL on a line's first row."""
    w = sharded.window()
    local = {n: F.lag(c).over(w) for c, n in names.items()}
    if sharded.single:
        return sharded.df.withColumns(local)
    last = sharded.df.groupBy(*sharded.key).agg(
        F.max_by(F.struct(*names), F.struct(*sharded.series.order)).alias("_last")
    )
    carried = carry(sharded, last, {"_before": F.last("_last", ignorenulls=True)})
    rows = attach(sharded, sharded.df, carried, "_before")
    # The time is never NULL, so a NULL before it marks a shard's first row.
    first = F.lag(sharded.series.time).over(w).isNull()
    rows = rows.withColumns({**local, "_first": first})
    return rows.withColumns(
        {
            n: F.when(F.col("_first"), F.col("_before")[c]).otherwise(F.col(n))
            for c, n in names.items()
        }
    ).drop("_before", "_first")


def previous_time(sharded: Sharded, name: str = "_prev_time") -> DataFrame:
    """Add the time of the row before; needs no row values, only a maximum."""
    time = sharded.series.time
    local = F.lag(time).over(sharded.window())
    if sharded.single:
        return sharded.df.withColumn(name, local)
    last = sharded.df.groupBy(*sharded.key).agg(F.max(time).alias("_last"))
    carried = carry(sharded, last, {"_before": F.max("_last")})
    rows = attach(sharded, sharded.df, carried, "_before")
    return rows.withColumn(name, F.coalesce(local, F.col("_before"))).drop("_before")


def _halo_plan(sharded: Sharded, rows: int) -> DataFrame:
    """Which shards pass rows on to which later shards, and from which row.

    Reads the key columns only. Keeps the last ``rows`` keys of each shard
    (limited before the shuffle as well as after), then looks ``rows`` keys
    back from the start of each shard; that may reach over several short ones.
    """
    series, (line, number) = sharded.series, sharded.key
    backwards = Window.partitionBy(line, number).orderBy(
        *[F.col(c).desc() for c in series.order]
    )
    tails = (
        sharded.df.select(line, number, *series.order)
        .withColumn("_back", F.row_number().over(backwards))
        .where(F.col("_back") <= rows)
    )
    ordered = Window.partitionBy(line).orderBy(number, *series.order)
    key = F.struct(*series.order)
    starts = tails.select(
        line,
        F.col(number).alias("_target"),
        F.lag(number).over(ordered).alias("_before"),
        F.coalesce(
            F.lag(key, rows).over(ordered),
            F.first(key).over(ordered.rowsBetween(Window.unboundedPreceding, 0)),
        ).alias("_cut"),
        F.collect_set(number).over(ordered.rowsBetween(-rows, -1)).alias("_from"),
    ).where(F.col("_target") != F.col("_before"))
    return (
        starts.select(line, F.explode("_from").alias(number), "_target", "_cut")
        .groupBy(line, number)
        .agg(F.collect_list(F.struct("_target", "_cut")).alias("_targets"))
    )


def with_halo(sharded: Sharded, rows: int) -> DataFrame:
    """Copy the last ``rows`` rows before each shard into it, marked ``is_halo``.

    Drop the marked rows after the window. The wide rows are exchanged once,
    by the window that follows; the plan of the copies comes from a pass over
    the key columns and is small (one entry per shard).
    """
    if sharded.single:
        return sharded.df.withColumn(HALO, F.lit(False))
    line, number = sharded.key
    plan = checkpointed(_halo_plan(sharded, rows))
    pairs = plan.agg(F.coalesce(F.sum(F.size("_targets")), F.lit(0))).first()[0]
    if pairs <= BROADCAST_PAIRS:
        plan = F.broadcast(plan)
    key = F.struct(*sharded.series.order)
    own = F.array(F.struct(F.col(number).alias(SHARD), F.lit(False).alias(HALO)))
    copies = F.transform(
        F.filter("_targets", lambda t: key >= t["_cut"]),
        lambda t: F.struct(t["_target"].alias(SHARD), F.lit(True).alias(HALO)),
    )
    places = F.when(F.col("_targets").isNull(), own).otherwise(F.concat(own, copies))
    rest = [c for c in sharded.df.columns if c != SHARD]
    return sharded.df.join(plan, sharded.key, "left").select(*rest, F.inline(places))
