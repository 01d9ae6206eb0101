"""What a shard must know of its past, for a whole chain of operators from one narrow pass.

A shard is summed up as a transition of state: the status and time of its first and last
row, and what its other rows did by themselves (their last release and receipt, their sums
over time). Only the first row depends on the shard before, and only through that shard's
last row. So transitions compose, and windows over the table of shards, a row each, give
every shard its state on entry; the rows are then read once more with that state attached.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace import constants as K
from millrace.operators.shards import Sharded, attach, carry
from millrace.session import checkpointed


def _first(sharded: Sharded) -> Column:
    # The time is never NULL, so a NULL before it marks a shard's first row.
    return F.lag(sharded.series.time).over(sharded.window()).isNull()


def falls(status: str | Column, before: str | Column) -> Column:
    """The status goes from 1 to 0; unknown values are no edge."""
    now, then = (F.col(c) if isinstance(c, str) else c for c in (status, before))
    return F.coalesce((now == 0.0) & (then == 1.0), F.lit(False))


def rises(status: str | Column, before: str | Column) -> Column:
    now, then = (F.col(c) if isinstance(c, str) else c for c in (status, before))
    return F.coalesce((now == 1.0) & (then == 0.0), F.lit(False))


def transit_state(sharded: Sharded, time: Column) -> DataFrame:
    """For each shard: ``_prev1`` and ``_prev3``, the stopper status before it,
    ``_release_before``, the last release, and ``_transit_before``, the last measurement.

    Reads the source once, its keys and the two status columns.
    """
    window = sharded.window()
    rows = sharded.df.select(
        *sharded.key,
        *sharded.series.order,
        K.STOPPER1,
        K.STOPPER3,
        time.alias("_t"),
        _first(sharded).alias("_first"),
        F.lead(sharded.series.time).over(window).isNull().alias("_end"),
        F.lag(K.STOPPER1).over(window).alias("_lag1"),
        F.lag(K.STOPPER3).over(window).alias("_lag3"),
    )
    inner = ~F.col("_first")
    rows = rows.withColumn("_released", F.when(inner & falls(K.STOPPER1, "_lag1"), F.col("_t")))
    rows = rows.withColumn("_from", F.max("_released").over(sharded.running()))
    receipt = inner & rises(K.STOPPER3, "_lag3")
    summary = rows.groupBy(*sharded.key).agg(
        F.max("_released").alias("_release"),
        F.max(F.when(receipt, F.col("_t"))).alias("_receipt"),
        F.max(F.when(receipt, F.col("_from"))).alias("_start"),
        *[F.max(F.when(F.col("_first"), F.col(c))).alias(n) for c, n in (("_t", "_t0"), (K.STOPPER1, "_s1"), (K.STOPPER3, "_s3"))],
        F.max(F.when(F.col("_end"), F.struct(F.col(K.STOPPER1).alias("s1"), F.col(K.STOPPER3).alias("s3")))).alias("_last"),
    )
    state = carry(sharded, summary, {"_before": F.last("_last", ignorenulls=True)})
    state = state.withColumns({"_prev1": F.col("_before")["s1"], "_prev3": F.col("_before")["s3"]})
    state = state.withColumn("_released0", F.when(falls("_s1", "_prev1"), F.col("_t0")))
    state = state.withColumn("_upto", F.greatest("_release", "_released0"))
    state = carry(sharded, state, {"_release_before": F.max("_upto")})
    known = F.coalesce("_released0", "_release_before")
    first = F.when(rises("_s3", "_prev3"), (F.col("_t0") - known) / 1e6)
    later = (F.col("_receipt") - F.coalesce("_start", known)) / 1e6
    state = state.withColumn("_transit", F.coalesce(later, first))
    return carry(sharded, state, {"_transit_before": F.last("_transit", ignorenulls=True)})


def time_steps(
    sharded: Sharded, weights: dict[str, Column], by: tuple[str, ...] = (), more: tuple[Column, ...] = ()
) -> DataFrame:
    """For each shard (and value of ``by``), stored: sums of weight times gap.

    The first row of a shard has no gap yet; its time and weights are kept beside the
    sums (``_t0``, ``_first_<name>``), and the last time (``_t9``). ``more`` are other
    aggregates of the same pass.
    """
    time = F.col(sharded.series.time)
    rows = sharded.df.withColumns(
        {"_gap": (time - F.lag(time).over(sharded.window())) / 1e6}
        | {f"_weight_{n}": w for n, w in weights.items()}
    )
    first = F.col("_gap").isNull()
    summary = rows.groupBy(*sharded.key, *by).agg(
        F.max(F.when(first, time)).alias("_t0"),
        F.max(time).alias("_t9"),
        *[F.sum(F.col(f"_weight_{n}") * F.col("_gap")).alias(f"_sum_{n}") for n in weights],
        *[F.max(F.when(first, F.col(f"_weight_{n}"))).alias(f"_first_{n}") for n in weights],
        *more,
    )
    return checkpointed(summary)


def time_state(
    sharded: Sharded, steps: DataFrame, names: tuple[str, ...], first: float, others: tuple[str, ...] = ()
) -> DataFrame:
    """For each shard: ``_prev_t``, the time before it, and ``_before_<name>``, the sum of
    weight times gap over all earlier rows. ``others`` are columns of ``steps`` that are
    summed up as they are. The first gap of a line is ``first``.
    """
    whole = steps.groupBy(*sharded.key).agg(
        F.max("_t0").alias("_t0"),
        F.max("_t9").alias("_t9"),
        *[F.coalesce(F.sum(f"_sum_{n}"), F.lit(0.0)).alias(f"_sum_{n}") for n in names],
        *[F.max(f"_first_{n}").alias(f"_first_{n}") for n in names],
        *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in others],
    )
    whole = carry(sharded, whole, {"_prev_t": F.max("_t9")})
    gap = F.coalesce((F.col("_t0") - F.col("_prev_t")) / 1e6, F.lit(first))
    whole = whole.withColumns(
        {f"_sum_{n}": F.col(f"_sum_{n}") + F.coalesce(F.col(f"_first_{n}") * gap, F.lit(0.0)) for n in names}
    )
    folded = {f"_before_{n}": F.sum(f"_sum_{n}") for n in names} | {f"_before_{n}": F.sum(n) for n in others}
    return carry(sharded, whole, folded)


def add_running_time(sharded: Sharded, weights: dict[str, Column], first: float = 0.1, name: str = "dt") -> Sharded:
    """Seconds since the row before as ``name``, and running sums of weight times these.

    Missing weights add nothing. A sharded source is read twice, once for the state of
    all shards and once for the rows.
    """
    steps = None if sharded.single else time_steps(sharded, weights)
    state = None if sharded.single else time_state(sharded, steps, tuple(weights), first)
    timed = with_gaps(sharded, state, tuple(weights), first, name)
    running = sharded.running()
    sums = {n: F.sum(w * F.col(name)).over(running) for n, w in weights.items()}
    rows = timed.withColumns({n: F.coalesce(s, F.lit(0.0)) for n, s in sums.items()})
    if state is not None:
        rows = rows.withColumns({n: F.col(n) + F.coalesce(F.col(f"_before_{n}"), F.lit(0.0)) for n in weights})
        rows = rows.drop(*[f"_before_{n}" for n in weights])
    return sharded.with_df(rows)


def with_gaps(sharded: Sharded, state: DataFrame | None, names: tuple[str, ...], first: float, name: str) -> DataFrame:
    """Rows with the gap to the row before, and the ``_before`` sums of their shard."""
    time = F.col(sharded.series.time)
    before = F.lag(time).over(sharded.window())
    rows = sharded.df
    if state is not None:
        rows = attach(sharded, rows, state, "_prev_t", *[f"_before_{n}" for n in names])
        before = F.coalesce(before, F.col("_prev_t"))
    rows = rows.withColumn(name, F.coalesce((time - before) / 1e6, F.lit(first)))
    return rows.drop("_prev_t")
