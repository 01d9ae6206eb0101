"""KPIs and histories as of any moment, from prefix summaries beside a stored layer.

The index has a row for each (line, shard) of the layer: its first and last instant, the
rows and the time before it, its sums, and its last counter and power draw; and a row for
each (line, cycle) with a defect: when it first showed. As of an instant, shards that
ended are taken from the index, and only the one shard of each line that the instant
falls into is read. A replay of n moments so costs n look-ups instead of n prefixes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from millrace import constants as K
from millrace.functions.energy import power_draw, power_saving
from millrace.operators import kpi
from millrace.operators.ordered import add_dt
from millrace.operators.shards import SERIES, SHARD, Series, shard, small
from millrace.sources.layers import DAY

# So many shard numbers are handed to the scan as a list.
LISTED_SHARDS = 1000
_SUMS = ("elapsed_s", "estop_s", "door1_s", "door2_s", "downtime_s", "saved", "transit", "timed")


def _sums(df: DataFrame, series: Series) -> list:
    """Aggregates of rows with their gap ``dt``; those without columns for them are null."""
    dt = F.col("dt")
    energy = K.temperature(2) in df.columns
    none = F.lit(None).cast("double")
    last = F.struct(
        F.col(K.CYCLE_COUNT).alias("counter"), (power_draw() if energy else none).alias("draw_kw")
    )
    transit = F.col(K.TRANSIT) if K.TRANSIT in df.columns else none
    return [
        F.count(F.lit(1)).alias("rows"),
        F.sum(dt).alias("elapsed_s"),
        *[F.sum(c).alias(n) for n, c in kpi.down_seconds(dt).items()],
        F.sum(power_saving() * dt if energy else none).alias("saved"),
        F.sum(transit).alias("transit"),
        F.count(transit).alias("timed"),
        F.max_by(last, F.struct(*series.order)).alias("last"),
    ]


def build(gold: DataFrame, path: str, series: Series = SERIES, label: str | None = None) -> None:
    """Writes the index of a layer below ``path``, replacing an older one.

    A layer that has its ``shard`` column keeps its cuts; another one is cut here, but
    then the rows of a shard can't be told apart at the scan. Rows without a time have no
    moment and are left out. Running it again after a crash gives the same tables.
    """
    if SHARD not in gold.columns:
        raise ValueError("the layer needs its shard column")
    line, time = series.line, F.col(series.time)
    sharded = shard(gold.where(time.isNotNull()), series)
    timed = add_dt(sharded, first=0.1, zero_as=None).df
    edges = [F.min(time).alias("first_t"), F.max(time).alias("last_t")]
    shards = timed.groupBy(line, SHARD).agg(*edges, *_sums(timed, series))
    earlier = Window.partitionBy(line).orderBy(SHARD).rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.withColumns(
        {
            "prev_t": F.max("last_t").over(earlier),
            "rows_before": F.coalesce(F.sum("rows").over(earlier), F.lit(0)),
        }
    )
    shards.write.mode("overwrite").parquet(f"{path}/shards")
    defect = (kpi._label(gold, label) > 0) & F.col(K.CYCLE_COUNT).isNotNull() & time.isNotNull()
    defects = gold.where(defect).groupBy(line, K.CYCLE_COUNT).agg(F.min(time).alias("first_t"))
    defects.write.mode("overwrite").parquet(f"{path}/defects")


def _shards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/shards")


def _rows_of(gold: DataFrame, chosen: DataFrame, time_us: int, series: Series) -> DataFrame:
    """Rows up to the instant of some shards of the index, with ``chosen``'s columns.

    The instants and days they span, and their numbers if there are not many, go to the
    scan; the driver sees these few values only.
    """
    line, time = series.line, F.col(series.time)
    low = chosen.agg(F.min("first_t")).first()[0]
    if low is None:
        low = time_us + 1
    rows = gold.where((time >= low) & (time <= time_us))
    if DAY in gold.columns:
        days = [F.to_date(F.timestamp_micros(F.lit(t))) for t in (low, time_us)]
        rows = rows.where(F.col(DAY).between(*days))
    numbers = chosen.select(SHARD).distinct().limit(LISTED_SHARDS + 1).collect()
    if len(numbers) <= LISTED_SHARDS:
        rows = rows.where(F.col(SHARD).isin([n[0] for n in numbers]))
    wanted = chosen.withColumnsRenamed({line: "_line", SHARD: "_shard"})
    same = F.col(line).eqNullSafe(F.col("_line")) & (F.col(SHARD) == F.col("_shard"))
    return rows.join(small(wanted), same).drop("_line", "_shard")


def open_rows(gold: DataFrame, path: str, time_us: int, series: Series = SERIES) -> DataFrame:
    """Rows up to the instant of the shards it falls into, one for each line at most."""
    at = F.lit(time_us)
    chosen = _shards(gold.sparkSession, path).where((F.col("first_t") <= at) & (F.col("last_t") > at))
    return _rows_of(gold, chosen.select(series.line, SHARD, "first_t", "prev_t", "rows_before"), time_us, series)


def line_kpis(gold: DataFrame, path: str, time_us: int, series: Series = SERIES) -> DataFrame:
    """What :func:`millrace.operators.kpi.line_kpis` gives for the rows up to an instant.

    Lines without a row by then are left out. Defect cycles are by the label the index
    was built with.
    """
    spark, line, time = gold.sparkSession, series.line, F.col(series.time)
    ended = _shards(spark, path).where(F.col("last_t") <= time_us)
    rows = open_rows(gold, path, time_us, series)
    order = Window.partitionBy(line, SHARD).orderBy(*series.order)
    before = F.coalesce(F.lag(time).over(order), F.col("prev_t"))
    rows = rows.withColumn("dt", F.coalesce((time - before) / 1e6, F.lit(0.1)))
    part = rows.groupBy(line, SHARD).agg(*_sums(rows, series))
    both = ended.select(*part.columns).unionByName(part)
    total = both.groupBy(line).agg(*[F.sum(c).alias(c) for c in _SUMS], F.max_by("last", SHARD).alias("last"))
    shown = spark.read.parquet(f"{path}/defects").where(F.col("first_t") <= time_us)
    shown = shown.groupBy(F.col(line).alias("_line")).agg(F.count(F.lit(1)).alias("defect_cycles"))
    kpis = total.join(shown, F.col(line).eqNullSafe(F.col("_line")), "left").drop("_line")
    kpis = kpis.withColumns(
        {
            "defect_cycles": F.coalesce("defect_cycles", F.lit(0).cast("long")),
            "counter": F.col("last")["counter"],
        }
    )
    if K.temperature(2) in gold.columns:
        kpis = kpis.withColumns(
            {"saved_kwh": F.coalesce("saved", F.lit(0.0)) / 3600.0, "draw_kw": F.col("last")["draw_kw"]}
        )
    if K.TRANSIT in gold.columns:
        kpis = kpis.withColumn("avg_transit_s", F.col("transit") / F.col("timed"))
    return kpi.finished(kpis.drop("last", "saved", "transit", "timed"))


def trailing(gold: DataFrame, path: str, rows: int, time_us: int, series: Series = SERIES) -> DataFrame:
    """The last ``rows`` rows of each line up to an instant, ``rel_index`` 0 at the oldest,
    and ``idx``, the position in the line.

    Read are the shard the instant falls into and as many before it as hold that many rows.
    """
    line = series.line
    seen = _shards(gold.sparkSession, path).where(F.col("first_t") <= time_us)
    later = Window.partitionBy(line).orderBy(F.desc(SHARD)).rowsBetween(Window.unboundedPreceding, -1)
    whole = F.when(F.col("last_t") <= time_us, F.col("rows")).otherwise(0)
    chosen = seen.withColumn("_later", F.coalesce(F.sum(whole).over(later), F.lit(0))).where(F.col("_later") < rows)
    found = _rows_of(gold, chosen.select(line, SHARD, "first_t", "rows_before"), time_us, series)
    within = Window.partitionBy(line, SHARD).orderBy(*series.order)
    found = found.withColumn("idx", F.col("rows_before") + F.row_number().over(within) - 1)
    end = F.max("idx").over(Window.partitionBy(line))
    found = found.withColumn("_end", end).where(F.col("idx") > F.col("_end") - rows)
    start = F.greatest(F.lit(0), F.col("_end") - (rows - 1))
    return found.withColumn("rel_index", F.col("idx") - start).drop("_end", "first_t", "rows_before", SHARD)
