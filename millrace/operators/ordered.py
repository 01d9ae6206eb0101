"""Time-ordered operators: gaps, edges, fills, transit, motion, rolling, index.

Each takes a :class:`~millrace.operators.shards.Sharded` table and returns one
with columns added, so that a chain of them shares one exchange and one sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace import constants as K
from millrace.operators import chain
from millrace.functions.columns import (
    bottleneck,
    defect_label,
    interpolated_drive2,
    with_exprs,
)
from millrace.sources.layers import DAY
from millrace.operators.shards import (
    HALO,
    SHARD,
    Sharded,
    attach,
    carry,
    previous,
    previous_time,
    small,
    with_halo,
)
from millrace.session import checkpointed

RELEASE, RECEIPT = "is_release1", "is_receipt3"


def add_previous(sharded: Sharded, names: dict[str, str]) -> Sharded:
    """Value of the row before, as ``names[column]``; NULL on a line's first row."""
    return sharded.with_df(previous(sharded, names))


def add_dt(
    sharded: Sharded,
    first: float = 1.0,
    zero_as: float | None = 1.0,
    name: str = "dt",
) -> Sharded:
    """Seconds since the row before.

    Features use ``first=1.0, zero_as=1.0``; KPIs use ``first=0.1,
    zero_as=None``, which keeps zero gaps.
    """
    df = previous_time(sharded)
    gap = (F.col(sharded.series.time) - F.col("_prev_time")) / 1e6
    dt = F.coalesce(gap, F.lit(first))
    if zero_as is not None:
        dt = F.when(dt == 0.0, zero_as).otherwise(dt)
    return sharded.with_df(df.withColumn(name, dt).drop("_prev_time"))


def add_edges(sharded: Sharded) -> Sharded:
    """Release: stopper 1 goes 1 -> 0. Receipt: stopper 3 goes 0 -> 1."""
    df = previous(sharded, {K.STOPPER1: "_prev1", K.STOPPER3: "_prev3"})
    release = (F.col(K.STOPPER1) == 0.0) & (F.col("_prev1") == 1.0)
    receipt = (F.col(K.STOPPER3) == 1.0) & (F.col("_prev3") == 0.0)
    return sharded.with_df(
        df.withColumns(
            {
                RELEASE: F.coalesce(release, F.lit(False)),
                RECEIPT: F.coalesce(receipt, F.lit(False)),
            }
        ).drop("_prev1", "_prev3")
    )


def forward_fill(sharded: Sharded, column: str, name: str | None = None) -> Sharded:
    """Last non-NULL value up to and including the row."""
    value = F.col(column)
    local = F.last(value, ignorenulls=True).over(sharded.running())
    if sharded.single:
        return sharded.with_df(sharded.df.withColumn(name or column, local))
    order = F.when(value.isNotNull(), F.struct(*sharded.series.order))
    summary = sharded.df.groupBy(*sharded.key).agg(F.max_by(value, order).alias("_last"))
    carried = carry(sharded, summary, {"_before": F.last("_last", ignorenulls=True)})
    rows = attach(sharded, sharded.df, carried, "_before")
    filled = rows.withColumn(name or column, F.coalesce(local, F.col("_before")))
    return sharded.with_df(filled.drop("_before"))


def add_transit(
    sharded: Sharded,
    default: float = K.DEFAULT_TRANSIT_S,
    whole_seconds: bool = False,
    keep_events: bool = False,
) -> Sharded:
    """Seconds from the last release to each receipt, carried forward.

    A release is not used up: every later receipt measures from the last one.
    A receipt with no release before it measures nothing. Rows before the first
    measurement get ``default``. ``whole_seconds`` floors both times first.
    ``keep_events`` keeps the flags, ``last_release_us`` and
    ``transit_time_seconds``.

    A sharded source is read twice: once for the state that every shard starts
    with, once for the rows.
    """
    time = F.col(sharded.series.time)
    if whole_seconds:
        time = F.floor(time / 1_000_000) * 1_000_000
    running = sharded.running()
    if sharded.single:
        df = add_edges(sharded).df
        known, before = F.lit(None).cast("long"), F.lit(None).cast("double")
    else:
        state = chain.transit_state(sharded, time)
        df = attach(sharded, sharded.df, state, "_prev1", "_prev3", "_release_before", "_transit_before")
        window = sharded.window()
        # The time is never NULL, so a NULL before it marks a shard's first row.
        df = df.withColumns(
            {
                "_first": F.lag(sharded.series.time).over(window).isNull(),
                "_lag1": F.lag(K.STOPPER1).over(window),
                "_lag3": F.lag(K.STOPPER3).over(window),
            }
        )
        previous1, previous3 = (
            F.when(F.col("_first"), F.col(f"_prev{n}")).otherwise(F.col(f"_lag{n}")) for n in (1, 3)
        )
        df = df.withColumns(
            {
                RELEASE: chain.falls(K.STOPPER1, previous1),
                RECEIPT: chain.rises(K.STOPPER3, previous3),
            }
        ).drop("_first", "_lag1", "_lag3", "_prev1", "_prev3")
        known, before = F.col("_release_before"), F.col("_transit_before")
    df = df.withColumn(
        "last_release_us", F.coalesce(F.max(F.when(F.col(RELEASE), time)).over(running), known)
    )
    df = df.withColumn(
        "transit_time_seconds",
        F.when(F.col(RECEIPT), (time - F.col("last_release_us")) / 1e6),
    )
    local = F.last("transit_time_seconds", ignorenulls=True).over(running)
    df = df.withColumn(K.TRANSIT, F.coalesce(local, before, F.lit(default)))
    df = df.drop("_release_before", "_transit_before")
    if not keep_events:
        df = df.drop(RELEASE, RECEIPT, "last_release_us", "transit_time_seconds")
    return sharded.with_df(df)


def add_running(sharded: Sharded, sums: dict[str, Column]) -> Sharded:
    """Running sums up to and including each row; missing values add nothing."""
    running = sharded.running()
    local = {n: F.coalesce(F.sum(c).over(running), F.lit(0.0)) for n, c in sums.items()}
    if sharded.single:
        return sharded.with_df(sharded.df.withColumns(local))
    summary = sharded.df.groupBy(*sharded.key).agg(
        *[F.sum(c).alias(f"_{n}") for n, c in sums.items()]
    )
    carried = carry(sharded, summary, {f"_{n}_before": F.sum(f"_{n}") for n in sums})
    befores = [f"_{n}_before" for n in sums]
    rows = attach(sharded, sharded.df, carried, *befores)
    added = {
        n: local[n] + F.coalesce(F.col(f"_{n}_before"), F.lit(0.0)) for n in sums
    }
    return sharded.with_df(rows.withColumns(added).drop(*befores))


def add_index(sharded: Sharded, name: str = "idx", total: str | None = None) -> Sharded:
    """Position of the row in its line, from 0; with ``total``, the line's length."""
    local = F.row_number().over(sharded.window()).cast("long") - 1
    one = F.count(F.lit(1))
    if sharded.single:
        added = {name: local}
        if total:
            added[total] = one.over(Window.partitionBy(*sharded.key))
        return sharded.with_df(sharded.df.withColumns(added))
    counts = sharded.df.groupBy(*sharded.key).agg(one.alias("_rows"))
    carried = carry(sharded, counts, {"_before": F.sum("_rows")})
    kept = ["_before"]
    if total:
        whole = F.sum("_rows").over(Window.partitionBy(sharded.series.line))
        carried = carried.withColumn(total, whole)
        kept.append(total)
    rows = attach(sharded, sharded.df, carried, *kept)
    index = local + F.coalesce(F.col("_before"), F.lit(0).cast("long"))
    return sharded.with_df(rows.withColumn(name, index).drop("_before"))


def _over_halo(
    sharded: Sharded,
    rows: int,
    windowed: dict[str, str],
    lagged: dict[str, str],
    *then: dict[str, str],
) -> Sharded:
    """Window columns over rows with their halo, then plain columns on top.

    ``lagged`` holds window columns over the results of ``windowed``. Each
    window function is named once and referred to afterwards; written inline it
    would be evaluated once per mention. Helpers start with ``_``.
    """
    df = with_exprs(with_halo(sharded, rows), windowed)
    if lagged:
        df = with_exprs(df, lagged)
    df = df.where(~F.col(HALO)).drop(HALO)
    for columns in then:
        df = with_exprs(df, columns)
    helpers = [
        c for columns in (windowed, lagged, *then) for c in columns if c.startswith("_")
    ]
    return sharded.with_df(df.drop(*helpers))


def _motion(sharded: Sharded, robots, joints, speed=True, change=True):
    """Velocity and acceleration from the angles and times of two rows back.

    Acceleration is the change of the unfilled velocity, so a line's first two
    rows give 0. Everything comes from plain lags: one window operator, then
    three steps of arithmetic.
    """
    over, time = sharded.over(), sharded.series.time
    names = [(K.angle(r, j), r, j) for r in robots for j in joints]
    lags = (1, 2) if change else (1,)
    windowed = {f"_t{n}": f"lag({time}, {n}) {over}" for n in lags}
    windowed |= {f"_{x}_{n}": f"lag({x}, {n}) {over}" for x, _, _ in names for n in lags}

    def seconds(later: str, earlier: str) -> str:
        gap = f"{later} - {earlier}"
        return f"CASE WHEN {gap} IS NULL OR {gap} = 0 THEN 1D ELSE ({gap}) / 1e6 END"

    gaps = {"_dt1": seconds(time, "_t1")}
    speeds = {f"_v_{x}": f"({x} - _{x}_1) / _dt1" for x, _, _ in names}
    result = {}
    if change:
        gaps["_dt2"] = seconds("_t1", "_t2")
        for x, r, j in names:
            result[K.acceleration(r, j)] = (
                f"coalesce((_v_{x} - (_{x}_1 - _{x}_2) / _dt2) / _dt1, 0D)"
            )
    if speed:
        result |= {K.velocity(r, j): f"coalesce(_v_{x}, 0D)" for x, r, j in names}
    return windowed, {}, gaps, speeds, result


# Long means are put together from sums of this many rows.
CHUNK = 10


def _mean(
    sharded: Sharded, column: str, rows: int
) -> tuple[dict[str, str], dict[str, str], str]:
    """Window columns, columns lagged over them, and the mean of the last rows.

    A sliding frame is added up again for every row, so its cost is its length.
    A long frame is instead the sum of chunks of ten rows, each added up once
    and looked up again by ``lag`` 10, 20, ... rows later: about ten additions
    and a few look-ups per row for any length. Nothing is subtracted, so no
    digits are lost.
    """
    if rows < CHUNK:
        return {}, {}, f"avg({column}) {sharded.over(rows)}"
    over, chunk = sharded.over(), sharded.over(CHUNK)
    total, count = f"_sum_{column}", f"_count_{column}"
    windowed = {total: f"sum({column}) {chunk}", count: f"count({column}) {chunk}"}
    lagged, totals, counts = {}, [f"coalesce({total}, 0D)"], [count]
    chunks, rest = divmod(rows, CHUNK)
    for n in range(CHUNK, chunks * CHUNK, CHUNK):
        lagged[f"{total}_{n}"] = f"lag({total}, {n}) {over}"
        lagged[f"{count}_{n}"] = f"lag({count}, {n}) {over}"
        totals.append(f"coalesce({total}_{n}, 0D)")
        counts.append(f"coalesce({count}_{n}, 0)")
    for n in range(chunks * CHUNK, chunks * CHUNK + rest):
        one = f"_one_{column}_{n}"
        lagged[one] = f"lag({column}, {n}) {over}"
        totals.append(f"coalesce({one}, 0D)")
        counts.append(f"int({one} IS NOT NULL)")
    number = " + ".join(counts)
    mean = f"CASE WHEN {number} > 0 THEN ({' + '.join(totals)}) / ({number}) END"
    return windowed, lagged, mean


def _deviation(sharded: Sharded, column: str, rows: int) -> str:
    return f"coalesce(stddev_samp({column}) {sharded.over(rows)}, 0D)"


def add_motion(
    sharded: Sharded,
    robots=K.ROBOTS,
    joints=K.JOINTS,
    speed: bool = True,
    change: bool = True,
) -> Sharded:
    steps = _motion(sharded, robots, joints, speed, change)
    return _over_halo(sharded, 2 if change else 1, *steps)


def add_rolling_mean(
    sharded: Sharded, rows: int, names: dict[str, str], include_extra: bool = False
) -> Sharded:
    """Mean of the last ``rows`` rows; ``include_extra`` takes one row more."""
    rows += include_extra
    windowed, lagged, means = {}, {}, {}
    for column, name in names.items():
        sums, looked_up, means[name] = _mean(sharded, column, rows)
        windowed |= sums
        lagged |= looked_up
    if rows < CHUNK:
        return _over_halo(sharded, rows - 1, means, {})
    return _over_halo(sharded, rows - 1, windowed, lagged, means)


def add_rolling_deviation(
    sharded: Sharded, rows: int, names: dict[str, str], include_extra: bool = False
) -> Sharded:
    """Sample deviation of the last ``rows`` rows; 0 where there is only one."""
    rows += include_extra
    columns = {n: _deviation(sharded, c, rows) for c, n in names.items()}
    return _over_halo(sharded, rows - 1, columns, {})


def add_features(sharded: Sharded, include_extra: bool = False) -> Sharded:
    """All gold features in one pass: motion, rolling loads, rolling transit.

    Expects the transit column. One halo, one exchange, one window operator.
    """
    short, long, mid = (
        n + include_extra for n in (K.MEAN_SHORT, K.MEAN_LONG, K.TRANSIT_MEAN)
    )
    windowed, lagged, *steps, result = _motion(sharded, K.ROBOTS, K.JOINTS)
    wanted = [(K.TRANSIT, K.TRANSIT_MA50, mid)]
    for r in K.ROBOTS:
        name = K.load(r)
        wanted += [(name, f"{name}_MA10", short), (name, f"{name}_MA60", long)]
        windowed[f"{name}_Std10"] = _deviation(sharded, name, short)
    for column, name, rows in wanted:
        sums, looked_up, result[name] = _mean(sharded, column, rows)
        windowed |= sums
        lagged |= looked_up
    featured = _over_halo(sharded, long - 1, windowed, lagged, *steps, result)
    return featured.with_df(
        featured.df.withColumns({K.BOTTLENECK: bottleneck(), K.LABEL: defect_label()})
    )


def rebuild_hidden(sharded: Sharded, whole_seconds: bool = False) -> Sharded:
    """The two signals of the uninstrumented station: temperature and transit."""
    df = sharded.df.withColumn(K.temperature(2), interpolated_drive2())
    return add_transit(sharded.with_df(df), whole_seconds=whole_seconds)


def at_index(sharded: Sharded, index: int) -> DataFrame:
    """The row at one position of each line; only the shards that hold it are ordered."""
    if not sharded.single:
        sharded = _holding(sharded, F.lit(index), F.lit(index))
    indexed = add_index(sharded).df if sharded.single else _numbered(sharded).drop("_before", "_rows")
    return indexed.where(F.col("idx") == index).drop(SHARD)


def _holding(sharded: Sharded, first: Column, last: Column) -> Sharded:
    """The shards with rows at positions ``first`` to ``last`` of their line, with
    ``_before``, the rows before the shard, and ``_rows``, the rows of the line.

    Found from the numbers of rows by shard, one narrow pass.
    """
    line, number_ = sharded.key
    counts = sharded.df.groupBy(*sharded.key).agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(line)
    upto = F.sum("_n").over(whole.orderBy(number_))
    counts = counts.withColumns({"_before": upto - F.col("_n"), "_rows": F.sum("_n").over(whole)})
    chosen = counts.where((F.col("_before") <= last) & (F.col("_before") + F.col("_n") > first))
    chosen = checkpointed(chosen.select(F.col(line).alias("_line"), F.col(number_).alias("_shard"), "_before", "_rows"))
    same = F.col(line).eqNullSafe(F.col("_line")) & (F.col(number_) == F.col("_shard"))
    return sharded.with_df(sharded.df.join(small(chosen), same).drop("_line", "_shard"))


def _numbered(held: Sharded) -> DataFrame:
    """``idx``, the position in the line, for the rows of some shards."""
    local = F.row_number().over(held.window()).cast("long") - 1
    return held.df.withColumn("idx", F.col("_before") + local)


def up_to_index(sharded: Sharded, index: int) -> Sharded:
    """All rows up to and including one position of each line."""
    indexed = add_index(sharded)
    return indexed.with_df(indexed.df.where(F.col("idx") <= index))


def up_to_time(df: DataFrame, time_us: int, column: str = "t_us") -> DataFrame:
    """All rows up to an instant; on a stored layer later days are not listed."""
    rows = df.where(F.col(column) <= time_us)
    if DAY in df.columns and column == "t_us":
        rows = rows.where(F.col(DAY) <= F.to_date(F.timestamp_micros(F.lit(time_us))))
    return rows


def trailing_history(
    sharded: Sharded, rows: int, index: int | None = None, from_zero: bool = True
) -> DataFrame:
    """The last ``rows`` rows up to a position, or of the whole line.

    ``rel_index`` counts from 0 at the oldest row, or, with
    ``from_zero=False``, up to 0 at the newest.
    """
    if sharded.single:
        indexed = add_index(sharded, total="_rows").df
    else:
        end = F.col("_rows") - 1 if index is None else F.lit(index)
        indexed = _numbered(_holding(sharded, end - (rows - 1), end)).drop("_before")
    if index is None:
        indexed = indexed.withColumn("_end", F.col("_rows") - 1)
    else:
        # A line shorter than the position has no current row and no history.
        indexed = indexed.where(F.col("_rows") > index)
        indexed = indexed.withColumn("_end", F.lit(index).cast("long"))
    start = F.greatest(F.lit(0), F.col("_end") - (rows - 1))
    origin = start if from_zero else F.col("_end")
    return (
        indexed.where(F.col("idx").between(start, F.col("_end")))
        .withColumn("rel_index", F.col("idx") - origin)
        .drop("_end", "_rows", SHARD)
    )
