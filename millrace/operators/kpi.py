"""Line KPIs as of a moment, and for every row of the replay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace import constants as K
from millrace.functions.columns import (
    defect_label,
    downtime,
    is_zero,
    unit_interval,
)
from millrace.functions.energy import power_draw, power_saving
from millrace.operators import chain
from millrace.operators.ordered import add_dt
from millrace.operators.shards import SHARD, Series, Sharded

_SIGNALS = {"estop_s": K.ESTOP, "door1_s": K.DOOR1, "door2_s": K.DOOR2}


def _label(df: DataFrame, label: str | None) -> Column:
    """Class of the row: a given column, the stored label, or from the text."""
    if label:
        return F.col(label)
    return F.col(K.LABEL) if K.LABEL in df.columns else defect_label()


def down_seconds(seconds: Column) -> dict[str, Column]:
    """Seconds lost per cause, and to any cause; causes may overlap."""
    lost = {
        name: F.when(is_zero(signal), seconds).otherwise(0.0)
        for name, signal in _SIGNALS.items()
    }
    lost["downtime_s"] = F.when(downtime(), seconds).otherwise(0.0)
    return lost


def _rates(df: DataFrame) -> DataFrame:
    """Availability, performance, quality and OEE from sums and counts."""
    operating, cycles = F.col("operating_s"), F.col("cycles")
    return (
        df.withColumn("operating_s", F.col("elapsed_s") - F.col("downtime_s"))
        .withColumns(
            {
                "availability": F.when(
                    F.col("elapsed_s") > 0.0, operating / F.col("elapsed_s")
                ).otherwise(1.0),
                "performance_ratio": F.when(
                    operating > 0.0, K.IDEAL_CYCLE_S * cycles / operating
                ).otherwise(1.0),
                "quality_ratio": (cycles - F.col("defect_cycles")) / cycles,
                "yield_pct": (1.0 - F.col("defect_cycles") / cycles) * 100.0,
            }
        )
        .withColumns(
            {
                "performance": unit_interval(F.col("performance_ratio")),
                "quality": unit_interval(F.col("quality_ratio")),
            }
        )
        .withColumn(
            "oee", F.col("availability") * F.col("performance") * F.col("quality")
        )
    )


def _cycles(counter: Column) -> Column:
    """Whole cycles shown by the counter, at least 1."""
    return F.greatest(F.lit(1).cast("long"), counter.cast("long"))


def line_kpis(sharded: Sharded, label: str | None = None) -> DataFrame:
    """One row per line with every KPI the columns at hand allow.

    Give it the rows up to the moment of interest (``up_to_time`` or
    ``up_to_index``). Unused KPIs are pruned from the plan by the caller's
    ``select``.

    Rows are added up per (line, cycle) first and per line second. The first
    step makes the distinct count of defect cycles exact and spreads a line
    with most of the rows over many tasks.
    """
    line = sharded.series.line
    rows = add_dt(sharded, first=0.1, zero_as=None)
    latest = F.lead(F.col(sharded.series.time)).over(rows.window()).isNull()
    # Only the last row of each shard carries its number, the rest NULL.
    df = rows.df.withColumn("_end", F.when(latest, F.col(SHARD)))
    dt, end = F.col("dt"), F.col("_end")
    first = [F.sum(dt).alias("elapsed_s"), F.max("_end").alias("_end")]
    first += [F.sum(c).alias(n) for n, c in down_seconds(dt).items()]
    first += [F.max(_label(df, label) > 0).alias("_defect")]
    sums = ["elapsed_s", *_SIGNALS, "downtime_s"]
    then = [F.sum(n).alias(n) for n in sums]
    then += [
        F.count(F.when(F.col("_defect"), F.col(K.CYCLE_COUNT))).alias("defect_cycles"),
        F.max_by(K.CYCLE_COUNT, "_end").alias("counter"),
    ]
    if K.temperature(2) in df.columns:
        first += [
            F.sum(power_saving() * dt).alias("_saved"),
            F.max_by(power_draw(), end).alias("_draw"),
        ]
        then += [
            (F.coalesce(F.sum("_saved"), F.lit(0.0)) / 3600.0).alias("saved_kwh"),
            F.max_by("_draw", "_end").alias("draw_kw"),
        ]
    if K.TRANSIT in df.columns:
        first += [F.sum(K.TRANSIT).alias("_transit"), F.count(K.TRANSIT).alias("_timed")]
        then += [(F.sum("_transit") / F.sum("_timed")).alias("avg_transit_s")]
    kpis = df.groupBy(line, K.CYCLE_COUNT).agg(*first).groupBy(line).agg(*then)
    return finished(kpis)


def finished(kpis: DataFrame) -> DataFrame:
    """Rates and carbon from the sums, the defect cycles and the ``counter`` of each line."""
    kpis = _rates(kpis.withColumn("cycles", _cycles(F.col("counter"))))
    if "saved_kwh" in kpis.columns:
        kpis = kpis.withColumn("saving_kw", K.LEGACY_KW - F.col("draw_kw"))
        kpis = kpis.withColumns(
            {
                "carbon_drives_kg": F.col("saved_kwh") * K.CO2_KG_PER_KWH,
                "carbon_scrap_kg": F.col("defect_cycles") * K.SCRAP_CO2_KG,
                "scrap_lbs": F.col("defect_cycles") * K.SCRAP_LBS,
            }
        ).withColumn(
            "carbon_total_kg", F.col("carbon_drives_kg") + F.col("carbon_scrap_kg")
        )
    return kpis.drop("counter")


def downtime_breakdown(kpis: DataFrame, line: str = "line_id") -> DataFrame:
    """Long form: one row per line and state with time in it."""
    states = [
        F.struct(F.lit(state).alias("state"), F.col(column).alias("seconds"))
        for state, column in K.BREAKDOWN_STATES
    ]
    return kpis.select(line, F.inline(F.array(*states))).where(F.col("seconds") > 0.0)


def carbon_shares(kpis: DataFrame, line: str = "line_id") -> DataFrame:
    """Long form of the two carbon savings, each at least the display floor."""
    parts = [
        F.struct(
            F.lit(name).alias("part"),
            F.greatest(F.lit(K.SHARE_FLOOR), F.col(column)).alias("kg_co2e"),
        )
        for name, column in (
            ("VFD Savings", "carbon_drives_kg"),
            ("Material Scrap Saved", "carbon_scrap_kg"),
        )
    ]
    return kpis.select(line, F.inline(F.array(*parts)))


def label_distribution(df: DataFrame, label: str = K.LABEL) -> DataFrame:
    """Rows per class, most frequent first."""
    return df.groupBy(label).count().orderBy(F.desc("count"), label)


def running_oee(sharded: Sharded, label: str | None = None) -> DataFrame:
    """OEE as of every row, as if the replay stopped there.

    A cycle counts as defective from its first defect row on. Those rows come
    from an aggregate over (line, cycle) and enter the running sums as extra
    rows just before the row they belong to, so no row-by-row join is needed.
    A sharded source is read twice: the state of the shards and the first defect
    rows come from one pass, by shard and cycle.
    """
    series = sharded.series
    line = series.line
    source = sharded.df.select(
        *sharded.key,
        *series.order,
        K.CYCLE_COUNT,
        K.ESTOP,
        K.DOOR1,
        K.DOOR2,
        (_label(sharded.df, label) > 0).alias("_defect"),
    )
    weights = {"elapsed_s": F.lit(1.0), "downtime_s": F.when(downtime(), 1.0).otherwise(0.0)}
    defect = F.col("_defect") & F.col(K.CYCLE_COUNT).isNotNull()
    at = F.min(F.when(defect, F.struct(*series.order, SHARD))).alias("_at")
    ordered = sharded.with_df(source)
    state = None
    if sharded.single:
        steps = source.groupBy(line, K.CYCLE_COUNT).agg(at)
    else:
        steps = chain.time_steps(ordered, weights, (K.CYCLE_COUNT,), (at,))
    first = steps.groupBy(line, K.CYCLE_COUNT).agg(F.min("_at").alias("_at")).where("_at is not null")
    first = first.select(line, *[F.col("_at")[c].alias(c) for c in (SHARD, *series.order)])
    if not sharded.single:
        found = first.groupBy(line, SHARD).agg(F.count(F.lit(1)).alias("_defects"))
        counted = steps.unionByName(found, allowMissingColumns=True)
        state = chain.time_state(ordered, counted, tuple(weights), 0.1, ("_defects",))
    timed = chain.with_gaps(ordered, state, (*weights, "_defects"), 0.1, "dt")
    extra = first.withColumns({"_seq": F.lit(0), "_new_defect": F.lit(1)})
    both = timed.withColumns({"_seq": F.lit(1), "_new_defect": F.lit(0)}).unionByName(extra, allowMissingColumns=True)
    both = Sharded(both, Series(line, series.time, (*series.ties, "_seq")), sharded.single)
    running = both.running()
    sums = {n: F.sum(w * F.col("dt")).over(running) for n, w in weights.items()}
    sums["_defects"] = F.sum("_new_defect").over(running)
    rows = both.df.withColumns({f"_now_{n}": s for n, s in sums.items()}).where(F.col("_seq") == 1)
    for name, shown in (("elapsed_s", "elapsed_s"), ("downtime_s", "downtime_s"), ("_defects", "defect_cycles")):
        before = F.lit(0) if sharded.single else F.coalesce(F.col(f"_before_{name}"), F.lit(0))
        rows = rows.withColumn(shown, F.coalesce(F.col(f"_now_{name}"), F.lit(0)) + before)
    rows = rows.withColumns(
        {
            "defect_cycles": F.col("defect_cycles").cast("long"),
            "cycles": _cycles(F.col(K.CYCLE_COUNT)),
        }
    )
    return _rates(rows).select(
        line,
        *series.order,
        "elapsed_s",
        "downtime_s",
        "cycles",
        "defect_cycles",
        "availability",
        "performance_ratio",
        "performance",
        "quality",
        "oee",
    )


def running_energy(sharded: Sharded) -> DataFrame:
    """Energy and carbon saved by the drives up to every row."""
    series = sharded.series
    source = sharded.df.select(
        *sharded.key,
        *series.order,
        power_draw().alias("draw_kw"),
        power_saving().alias("saving_kw"),
    )
    summed = chain.add_running_time(sharded.with_df(source), {"_saved": F.col("saving_kw")}).df
    return summed.withColumn("saved_kwh", F.col("_saved") / 3600.0).select(
        series.line,
        *series.order,
        "draw_kw",
        "saving_kw",
        "saved_kwh",
        (F.col("saved_kwh") * K.CO2_KG_PER_KWH).alias("carbon_drives_kg"),
    )
