"""One callable per query: (spark, folder of the tables) -> DataFrame."""

from __future__ import annotations

import math
from collections.abc import Callable
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession, functions as F

from catalog.telemetry import raw_source, tel
from catalog.workbooks import write_workbooks
from millrace import constants as K
from millrace.functions import columns as C, energy as E, scores as S
from millrace.operators import evaluate, forecast, kpi, ordered as O, status, unify
from millrace.operators.shards import SHARD, Series, Sharded, shard
from millrace.plans import asof, boosting, daily, pipeline, training
from millrace.session import scratch, state_on_disk, use_utc
from millrace.sources import layers, raw
from millrace.streaming import transit as live, windows

Query = Callable[[SparkSession, str], DataFrame]
KEYS = ["line_id", "event_id"]
# Shard size of the *_sharded queries, small enough to cut the test tables.
SMALL_SHARD = 700
# As-of point of the replay queries: position, and the same as an instant.
AS_OF_INDEX = 60
AS_OF_US = 8_526_000_000_000

_queries: dict[str, Query] = {}
_small: ContextVar[bool] = ContextVar("small", default=False)
# Queries over whole lines that are registered a second time over small shards.
TWINS = (
    "lag_status",
    "transit_events",
    "transit_time_whole_seconds",
    "joint_velocity",
    "rolling_mean10",
    "rolling_std10",
    "rolling_transit50",
    "trailing_history",
    "trailing_transits",
    "row_at_index",
    "robot_health",
    "kpi_avg_transit",
    "kpi_defect_cycles",
    "esg_energy",
    "esg_current_power",
    "esg_carbon",
    "esg_carbon_shares",
    "running_energy",
)


def query(build: Query) -> Query:
    _queries[build.__name__] = build
    return build


def queries() -> dict[str, Query]:
    return _queries | {f"{name}_sharded": _over_shards(_queries[name]) for name in TWINS}


def _over_shards(build: Query) -> Query:
    """The same query with lines cut into small shards."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        before = _small.set(True)
        try:
            return build(spark, sf_dir)
        finally:
            _small.reset(before)

    return run


def series(spark, sf_dir, small: bool = False) -> Sharded:
    small = small or _small.get()
    return shard(tel(spark, sf_dir), rows_per_shard=SMALL_SHARD if small else None)


def rebuilt(spark, sf_dir, small: bool = False) -> Sharded:
    """Telemetry with the hidden temperature and transit rebuilt."""
    return O.rebuild_hidden(series(spark, sf_dir, small))


def rounded(*names: str, places: int = 6) -> list[str]:
    """SQL text of rounded columns, for ``selectExpr``."""
    return [f"round({n}, {places}) AS {n}" for n in names]


def off_tie(name: str) -> str:
    """Rounded with a small shift.

    Means of microsecond times often end exactly half-way between two rounded
    values, where the engines' last bits decide; the shift moves them off.
    """
    return f"round({name} + 3e-8, 6) AS {name}"


# ---- Sources, layers -----------------------------------------------------


@query
def load_raw(spark, sf_dir):
    """The cycle source written as CSV with plant headers, and loaded back."""
    path = scratch(spark, "raw")
    source = raw_source(spark, sf_dir, "cycle").withColumnRenamed(
        K.CYCLE_COUNT, " Q_Cell (CycleCount) "
    )
    source.write.option("header", True).csv(path)
    loaded = raw.load_raw(spark, path)
    return loaded.select(
        "line_id",
        K.TIME_TEXT,
        F.col("Q_Cell_CycleCount").alias(K.CYCLE_COUNT),
        K.CYCLE_STATE,
        K.DESCRIPTION,
    )


@query
def load_workbooks(spark, sf_dir):
    """The safety source written as workbooks named .csv, and loaded back."""
    path = scratch(spark, "books")
    write_workbooks(raw_source(spark, sf_dir, "safety"), path, ending=".csv")
    names = ["line_id", K.TIME_TEXT, K.ESTOP, K.DOOR1, K.DOOR2]
    return raw.load_raw(spark, path, names)


@query
def clean_headers(spark, sf_dir):
    df = tel(spark, sf_dir).select(
        "line_id",
        F.col("event_id").alias(" event id "),
        F.col(K.load("R01")).alias("Load (R01) N"),
        F.col(K.ESTOP).alias(K.ESTOP),
    )
    return raw.clean_headers(df)


@query
def coerce_numeric(spark, sf_dir):
    text = F.when(F.col("event_id") % 7 == 0, F.lit("bad")).when(
        F.col("event_id") % 7 == 1, F.lit("NaN")
    )
    df = tel(spark, sf_dir).select(
        F.col("event_id").cast("string").alias("event_id"),
        K.DESCRIPTION,
        F.coalesce(text, F.col(K.load("R01")).cast("string")).alias("load_n"),
    )
    return C.coerce_numeric(df)


@query
def mask_columns(spark, sf_dir):
    df = tel(spark, sf_dir).select(
        *KEYS, K.temperature(1), K.temperature(2), K.stopper(1), K.stopper(2)
    )
    return raw.mask(df)


@query
def parse_timestamp(spark, sf_dir):
    """Text with milliseconds, without, and unreadable."""
    at = F.timestamp_micros("t_us")
    text = (
        F.when(F.col("event_id") % 13 == 0, F.lit("no signal"))
        .when(
            F.col("event_id") % 4 == 0, F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'")
        )
        .otherwise(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
    )
    df = tel(spark, sf_dir).select("event_id", text.alias("time_text"))
    parsed = F.unix_micros(C.parse_time(F.col("time_text")))
    return df.withColumn("parsed_us", parsed)


def _pipeline_raw(spark, sf_dir) -> dict[str, DataFrame]:
    return {name: raw_source(spark, sf_dir, name) for name in K.SOURCES}


@query
def bronze_roundtrip(spark, sf_dir):
    root = scratch(spark, "bronze")
    source = raw.mask(raw_source(spark, sf_dir, "conveyor"))
    layers.write_bronze(source, root)
    return layers.read_layer(spark, root).drop(layers.DAY)


def _bronze(spark, sf_dir) -> str:
    root = scratch(spark, "layers")
    pipeline.bronze(spark, _pipeline_raw(spark, sf_dir), root)
    return root


_KEPT = ("line_id", "event_id")


@query
def unify_sources(spark, sf_dir):
    """The seven sources, each with time as text, joined on line and instant."""
    sources = []
    for name in K.SOURCES:
        df = raw_source(spark, sf_dir, name)
        if name == "conveyor":
            df = raw.mask(df)
        df = df.withColumn("t_us", F.unix_micros(C.parse_time(F.col(K.TIME_TEXT))))
        sources.append(df.drop(K.TIME_TEXT))
    return unify.unify(sources)


@query
def unify_hot_instant(spark, sf_dir):
    """Sources of which one has a third of a line's rows at one instant, and another a few."""
    df = tel(spark, sf_dir)
    chosen = df.where("line_id = 0 AND event_id % 41 = 8").select("event_id")
    few = [r[0] for r in chosen.orderBy("event_id").limit(3).collect()]
    moved = {
        "conveyor": (F.col("line_id") == 0) & (F.col("event_id") % 3 == 0),
        "safety": F.col("event_id").isin(few),
        "cycle": F.col("event_id").isin(few[:1]),
    }
    sources = [
        df.withColumn("t_us", F.when(at, 0).otherwise(F.col("t_us"))).select(
            "line_id", "t_us", F.col("event_id").alias(f"{name}_id"), *K.SOURCE_COLUMNS[name][:2]
        )
        for name, at in moved.items()
    ]
    return unify.unify(sources, hot_rows=20)


def _silver(spark, sf_dir, small: bool = False) -> tuple[str, DataFrame]:
    root = _bronze(spark, sf_dir)
    limit = SMALL_SHARD if small else None
    stored = pipeline.silver(
        spark, root, ties=("event_id",), keep=_KEPT, rows_per_shard=limit
    )
    return root, stored


@query
def silver_roundtrip(spark, sf_dir):
    _, stored = _silver(spark, sf_dir)
    return stored.select(
        *KEYS, "t_us", K.temperature(2), K.TRANSIT, K.STOPPER1, K.DESCRIPTION
    )


def _gold_report(gold: DataFrame) -> DataFrame:
    features = [
        *[K.velocity(r, j) for r in K.ROBOTS for j in K.JOINTS],
        *[K.acceleration(r, j) for r in K.ROBOTS for j in K.JOINTS],
        *[f"{K.load(r)}_{s}" for r in K.ROBOTS for s in ("MA10", "MA60", "Std10")],
    ]
    return gold.selectExpr(
        *KEYS,
        K.TRANSIT,
        *rounded(*features),
        off_tie(K.TRANSIT_MA50),
        K.BOTTLENECK,
        K.LABEL,
    )


@query
def gold_roundtrip(spark, sf_dir):
    """All layers from raw rows to stored gold features."""
    root, _ = _silver(spark, sf_dir)
    return _gold_report(pipeline.gold(spark, root, ties=("event_id",)))


@query
def gold_roundtrip_sharded(spark, sf_dir):
    """The same with the lines cut into shards; equal result."""
    root, _ = _silver(spark, sf_dir, small=True)
    return _gold_report(pipeline.gold(spark, root, ties=("event_id",)))


def _parted(spark, sf_dir, root: str, parts: int) -> daily.PartedLayers:
    """Layers refreshed in stretches of time one after another, over small shards."""
    stored = _bronze(spark, sf_dir)
    made = daily.PartedLayers(spark, root, Series("line_id", "t_us", ("event_id",)))
    sources = []
    for name in K.SOURCES:
        df = layers.read_bronze(spark, pipeline.layer_path(stored, "bronze", name), _KEPT)
        sources.append(df if name == "conveyor" else df.drop(K.TIME_TEXT, "timestamp", layers.DAY))
    low, high = sources[0].agg(F.min("t_us"), F.max("t_us")).first()
    part = F.floor((F.col("t_us") - low) * parts / (high - low + 1))
    for number in range(parts):
        made.refresh(f"{number:03d}", [s.where(part == number) for s in sources], SMALL_SHARD)
    return made


@query
def gold_by_part(spark, sf_dir):
    """Gold refreshed in three parts, each from its own rows and the state before it."""
    return _gold_report(_parted(spark, sf_dir, scratch(spark, "parts"), 3).read(daily.GOLD))


@query
def asof_prefix_gold(spark, sf_dir):
    """Stored gold as of an instant; the days after it are not read."""
    root, _ = _silver(spark, sf_dir)
    gold = pipeline.gold(spark, root, ties=("event_id",))
    early = O.up_to_time(gold, AS_OF_US)
    return early.selectExpr(*KEYS, "t_us", K.TRANSIT, *rounded(K.load("R01") + "_MA60"), K.LABEL)


@query
def load_gold(spark, sf_dir):
    """Gold read for KPIs: zone stripped, gap with the KPI defaults."""
    path = scratch(spark, "gold")
    timed = layers.with_time(raw_source(spark, sf_dir, "conveyor"))
    layers.write_layer(timed.where(F.col("t_us").isNotNull()), path, ("line_id", "t_us"))
    gold = layers.load_gold(spark, path)
    with_dt = O.add_dt(shard(gold), first=0.1, zero_as=None).df
    return with_dt.selectExpr(*KEYS, "timestamp", *rounded("dt"))


# ---- Ordered operators ---------------------------------------------------


@query
def lag_status(spark, sf_dir):
    names = {K.STOPPER1: "prev_stopper1", K.STOPPER3: "prev_stopper3"}
    return O.add_previous(series(spark, sf_dir), names).df.select(*KEYS, *names.values())


def _edges(sharded):
    flags = [F.col(c).cast("int").alias(c) for c in (O.RELEASE, O.RECEIPT)]
    return O.add_edges(sharded).df.select(*KEYS, *flags)


@query
def edge_events(spark, sf_dir):
    return _edges(series(spark, sf_dir))


@query
def edge_events_sharded(spark, sf_dir):
    return _edges(series(spark, sf_dir, small=True))


def _filled(sharded):
    filled = O.forward_fill(sharded, K.temperature(1), "filled_temperature")
    return filled.df.select(*KEYS, "filled_temperature")


@query
def forward_fill(spark, sf_dir):
    return _filled(series(spark, sf_dir))


@query
def forward_fill_sharded(spark, sf_dir):
    return _filled(series(spark, sf_dir, small=True))


@query
def transit_events(spark, sf_dir):
    """Measured transits only: one row per receipt."""
    timed = O.add_transit(series(spark, sf_dir), keep_events=True).df
    return timed.where(O.RECEIPT).select(*KEYS, "transit_time_seconds")


@query
def transit_time(spark, sf_dir):
    return O.add_transit(series(spark, sf_dir)).df.select(*KEYS, K.TRANSIT)


@query
def transit_time_sharded(spark, sf_dir):
    return O.add_transit(series(spark, sf_dir, small=True)).df.select(*KEYS, K.TRANSIT)


@query
def transit_time_whole_seconds(spark, sf_dir):
    timed = O.add_transit(series(spark, sf_dir), whole_seconds=True)
    return timed.df.select(*KEYS, K.TRANSIT)


@query
def row_dt(spark, sf_dir):
    """Both gap rules: for features and for KPIs."""
    first = O.add_dt(series(spark, sf_dir), name="dt_feature")
    both = O.add_dt(first, first=0.1, zero_as=None, name="dt_kpi")
    return both.df.select(*KEYS, "dt_feature", "dt_kpi")


@query
def row_dt_sharded(spark, sf_dir):
    timed = O.add_dt(series(spark, sf_dir, small=True), name="dt_feature")
    return timed.df.select(*KEYS, "dt_feature")


_SPEEDS = [K.velocity(r, j) for r in K.ROBOTS for j in K.JOINTS]
_CHANGES = [K.acceleration(r, j) for r in K.ROBOTS for j in K.JOINTS]


@query
def joint_velocity(spark, sf_dir):
    moved = O.add_motion(series(spark, sf_dir), change=False)
    return moved.df.selectExpr(*KEYS, *rounded(*_SPEEDS))


@query
def joint_acceleration(spark, sf_dir):
    moved = O.add_motion(series(spark, sf_dir), speed=False)
    return moved.df.selectExpr(*KEYS, *rounded(*_CHANGES))


@query
def joint_acceleration_sharded(spark, sf_dir):
    moved = O.add_motion(series(spark, sf_dir, small=True), speed=False)
    return moved.df.selectExpr(*KEYS, *rounded(*_CHANGES))


def _load_names(suffix: str) -> dict[str, str]:
    return {K.load(r): f"{K.load(r)}_{suffix}" for r in K.ROBOTS}


def _means(sharded, rows, suffix, extra=False):
    names = _load_names(suffix)
    rolled = O.add_rolling_mean(sharded, rows, names, include_extra=extra)
    return rolled.df.selectExpr(*KEYS, *rounded(*names.values()))


@query
def rolling_mean10(spark, sf_dir):
    return _means(series(spark, sf_dir), K.MEAN_SHORT, "MA10")


@query
def rolling_mean10_extra(spark, sf_dir):
    return _means(series(spark, sf_dir), K.MEAN_SHORT, "MA10", extra=True)


@query
def rolling_mean60(spark, sf_dir):
    return _means(series(spark, sf_dir), K.MEAN_LONG, "MA60")


@query
def rolling_mean60_extra(spark, sf_dir):
    return _means(series(spark, sf_dir), K.MEAN_LONG, "MA60", extra=True)


@query
def rolling_mean60_sharded(spark, sf_dir):
    return _means(series(spark, sf_dir, small=True), K.MEAN_LONG, "MA60")


def _deviations(sharded, extra=False):
    names = _load_names("Std10")
    rolled = O.add_rolling_deviation(sharded, K.MEAN_SHORT, names, include_extra=extra)
    return rolled.df.selectExpr(*KEYS, *rounded(*names.values()))


@query
def rolling_std10(spark, sf_dir):
    return _deviations(series(spark, sf_dir))


@query
def rolling_std10_extra(spark, sf_dir):
    return _deviations(series(spark, sf_dir), extra=True)


def _transit_mean(spark, sf_dir, extra):
    timed = O.add_transit(series(spark, sf_dir))
    names = {K.TRANSIT: K.TRANSIT_MA50}
    rolled = O.add_rolling_mean(timed, K.TRANSIT_MEAN, names, include_extra=extra)
    return rolled.df.selectExpr(*KEYS, off_tie(K.TRANSIT_MA50))


@query
def rolling_transit50(spark, sf_dir):
    return _transit_mean(spark, sf_dir, extra=False)


@query
def rolling_transit50_extra(spark, sf_dir):
    return _transit_mean(spark, sf_dir, extra=True)


@query
def position_index(spark, sf_dir):
    return O.add_index(series(spark, sf_dir)).df.select(*KEYS, "idx")


@query
def position_index_sharded(spark, sf_dir):
    return O.add_index(series(spark, sf_dir, small=True)).df.select(*KEYS, "idx")


@query
def row_at_index(spark, sf_dir):
    row = O.at_index(series(spark, sf_dir), AS_OF_INDEX)
    return row.select(*KEYS, "idx", K.temperature(1), K.CYCLE_COUNT)


@query
def asof_prefix(spark, sf_dir):
    rows = O.up_to_time(tel(spark, sf_dir), AS_OF_US)
    return rows.select(*KEYS, "t_us", K.CYCLE_COUNT)


@query
def trailing_history(spark, sf_dir):
    """The last 50 temperatures of each line, oldest first."""
    df = rebuilt(spark, sf_dir)
    rows = O.trailing_history(df, K.HISTORY_TEMPS)
    temps = [K.temperature(d) for d in (1, 2, 3)]
    return rows.select(*KEYS, "rel_index", *temps)


@query
def trailing_transits(spark, sf_dir):
    """100 transit times up to the as-of row, newest at 0."""
    df = O.add_transit(series(spark, sf_dir))
    rows = O.trailing_history(df, K.HISTORY_TRANSITS, AS_OF_INDEX, from_zero=False)
    return rows.select(*KEYS, "rel_index", K.TRANSIT)


@query
def load_deviation(spark, sf_dir):
    """Loads against their rolling mean, drive 2 against drive 1."""
    names = _load_names("MA10")
    df = C.interpolated_drive2()
    sharded = series(spark, sf_dir)
    sharded = sharded.with_df(sharded.df.withColumn(K.temperature(2), df))
    rolled = O.add_rolling_mean(sharded, K.MEAN_SHORT, names).df
    loads = [
        F.round(F.col(c) - F.col(n), 6).alias(f"{r}_load_vs_mean")
        for r, (c, n) in zip(K.ROBOTS, names.items())
    ]
    delta = F.round(F.col(K.temperature(2)) - F.col(K.temperature(1)), 6)
    return rolled.select(*KEYS, *loads, delta.alias("vfd2_vs_vfd1"))


# ---- Expressions on rows -------------------------------------------------


@query
def vfd2_interpolated(spark, sf_dir):
    return tel(spark, sf_dir).select(
        *KEYS, C.interpolated_drive2().alias(K.temperature(2))
    )


@query
def bottleneck_flag(spark, sf_dir):
    timed = O.add_transit(series(spark, sf_dir)).df
    return timed.select(*KEYS, C.bottleneck().alias(K.BOTTLENECK))


@query
def transit_verdict(spark, sf_dir):
    timed = O.add_transit(series(spark, sf_dir)).df
    return timed.select(
        *KEYS,
        S.transit_verdict().alias("verdict"),
        S.transit_trend().alias("trend"),
        S.jammed().cast("int").alias("jam"),
    )


@query
def defect_label(spark, sf_dir):
    return tel(spark, sf_dir).select(*KEYS, C.defect_label().alias(K.LABEL))


@query
def downtime_rows(spark, sf_dir):
    return tel(spark, sf_dir).where(C.downtime()).select(*KEYS, K.ESTOP, K.DOOR1, K.DOOR2)


@query
def clip_temps(spark, sf_dir):
    """Temperatures spread over a wider range first, so that both limits act."""
    df = tel(spark, sf_dir).withColumns(
        {K.temperature(d): F.col(K.temperature(d)) * 3.0 - 140.0 for d in K.DRIVES}
    )
    clipped = [E.clipped_temperature(d).alias(f"clipped{d}") for d in K.DRIVES]
    return df.select(*KEYS, *clipped)


@query
def stop_causes(spark, sf_dir):
    return tel(spark, sf_dir).select(
        *KEYS, S.line_state().alias("line_state"), S.stop_causes().alias("causes")
    )


@query
def stopper_text(spark, sf_dir):
    texts = [S.stopper_text(K.stopper(n)).alias(f"stopper{n}") for n in (1, 3, 4, 5)]
    return tel(spark, sf_dir).select(*KEYS, *texts)


def _scored(spark, sf_dir):
    sharded = series(spark, sf_dir)
    return status.robot_scores(
        O.add_rolling_deviation(sharded, K.MEAN_SHORT, _load_names("Std10")).df
    )


@query
def robot_health(spark, sf_dir):
    names = [f"{r}_health" for r in K.ROBOTS]
    return _scored(spark, sf_dir).selectExpr(*KEYS, *rounded(*names))


def _drives(spark, sf_dir):
    hidden = tel(spark, sf_dir).withColumn(K.temperature(2), C.interpolated_drive2())
    return status.drive_scores(hidden)


@query
def vfd_health(spark, sf_dir):
    return _drives(spark, sf_dir).selectExpr(*KEYS, *rounded(*[f"VFD{d}_health" for d in K.DRIVES]))


@query
def health_band(spark, sf_dir):
    bands = [
        S.health_band(F.round(f"VFD{d}_health", 6)).alias(f"VFD{d}_band") for d in K.DRIVES
    ]
    return _drives(spark, sf_dir).select(*KEYS, *bands)


@query
def scenario_overlay(spark, sf_dir):
    """Drive health of the as-of row under each named scenario."""
    row = O.at_index(rebuilt(spark, sf_dir), AS_OF_INDEX).withColumns(
        {K.LABEL: C.defect_label(), K.BOTTLENECK: C.bottleneck()}
    )
    shown = status.drive_scores(status.scenario_overlay(row))
    return shown.selectExpr(
        *KEYS,
        "scenario",
        K.temperature(1),
        K.temperature(2),
        K.TRANSIT,
        K.BOTTLENECK,
        K.load("R03"),
        K.angle("R04", "S"),
        K.LABEL,
        *rounded("VFD1_health", "VFD2_health"),
    )


@query
def number_texts(spark, sf_dir):
    """Numbers as cards show them; eighths and halves have exact decimals."""
    value, change = F.col("event_id") * 0.125, (F.col("event_id") % 21 - 10) * 0.5
    return tel(spark, sf_dir).select(
        "event_id",
        S.fixed_text(value, 3).alias("value_text"),
        S.fixed_text(change, 1, sign=True).alias("change_text"),
    )


@query
def vfd_power(spark, sf_dir):
    hidden = tel(spark, sf_dir).withColumn(K.temperature(2), C.interpolated_drive2())
    return hidden.select(
        *KEYS,
        F.round(E.power_draw(), 6).alias("draw_kw"),
        F.round(E.power_saving(), 6).alias("saving_kw"),
    )


@query
def defect_lookup(spark, sf_dir):
    df = tel(spark, sf_dir).select(*KEYS, C.defect_label().alias(K.LABEL))
    return status.defect_lookup(df)


@query
def label_confidence(spark, sf_dir):
    df = tel(spark, sf_dir).select(*KEYS, C.defect_label().alias(K.LABEL))
    return status.label_confidence(df)


# ---- KPIs ----------------------------------------------------------------


def _kpis(spark, sf_dir) -> DataFrame:
    return kpi.line_kpis(rebuilt(spark, sf_dir))


@query
def kpi_oee(spark, sf_dir):
    rates = rounded("availability", "performance", "quality", "oee")
    kpis = kpi.line_kpis(series(spark, sf_dir))
    return kpis.selectExpr("line_id", "cycles", "defect_cycles", *rates)


@query
def kpi_oee_sharded(spark, sf_dir):
    rates = rounded("availability", "performance", "quality", "oee")
    kpis = kpi.line_kpis(series(spark, sf_dir, small=True))
    return kpis.selectExpr("line_id", "cycles", "defect_cycles", *rates)


@query
def kpi_oee_as_of(spark, sf_dir):
    """OEE as of an instant; the filter runs before anything is ordered."""
    rates = rounded("availability", "performance", "quality", "oee")
    rows = O.up_to_time(tel(spark, sf_dir), AS_OF_US)
    return kpi.line_kpis(shard(rows)).selectExpr("line_id", "cycles", "defect_cycles", *rates)


def _replay_layer(spark, sf_dir) -> tuple[DataFrame, str]:
    """Rows stored by day and shard, and the index beside them."""
    rows = shard(rebuilt(spark, sf_dir).df.drop(SHARD), rows_per_shard=SMALL_SHARD).df
    rows = rows.withColumn(layers.DAY, F.to_date(F.timestamp_micros("t_us")))
    path = scratch(spark, "replay")
    layers.write_layer(rows, path, ("line_id", SHARD, "t_us", "event_id"), arrange=False)
    asof.build(layers.read_layer(spark, path), f"{path}-index")
    return layers.read_layer(spark, path), f"{path}-index"


@query
def kpi_oee_as_of_indexed(spark, sf_dir):
    """OEE, energy and transit as of an instant from the index and one shard of each line."""
    gold, index = _replay_layer(spark, sf_dir)
    rates = rounded("availability", "performance", "quality", "oee", "saved_kwh", "avg_transit_s")
    return asof.line_kpis(gold, index, AS_OF_US).selectExpr("line_id", "cycles", "defect_cycles", *rates)


@query
def trailing_as_of_indexed(spark, sf_dir):
    """The 50 rows of each line up to an instant, from the shards that hold them."""
    gold, index = _replay_layer(spark, sf_dir)
    rows = asof.trailing(gold, index, K.HISTORY_TEMPS, AS_OF_US)
    return rows.select(*KEYS, "idx", "rel_index", *[K.temperature(d) for d in (1, 2, 3)])


@query
def kpi_availability(spark, sf_dir):
    return kpi.line_kpis(series(spark, sf_dir)).selectExpr(
        "line_id", *rounded("elapsed_s", "operating_s", "availability")
    )


@query
def kpi_downtime(spark, sf_dir):
    return kpi.line_kpis(series(spark, sf_dir)).selectExpr(
        "line_id", *rounded("estop_s", "door1_s", "door2_s", "downtime_s")
    )


@query
def kpi_performance(spark, sf_dir):
    return kpi.line_kpis(series(spark, sf_dir)).selectExpr(
        "line_id", "cycles", *rounded("performance_ratio", "performance")
    )


@query
def kpi_defect_cycles(spark, sf_dir):
    return kpi.line_kpis(series(spark, sf_dir)).select("line_id", "defect_cycles")


@query
def kpi_quality(spark, sf_dir):
    return kpi.line_kpis(series(spark, sf_dir)).selectExpr(
        "line_id", *rounded("quality_ratio", "quality", "yield_pct")
    )


@query
def downtime_breakdown(spark, sf_dir):
    rows = kpi.downtime_breakdown(kpi.line_kpis(series(spark, sf_dir)))
    return rows.selectExpr("line_id", "state", *rounded("seconds"))


@query
def kpi_avg_transit(spark, sf_dir):
    return _kpis(spark, sf_dir).selectExpr("line_id", off_tie("avg_transit_s"))


@query
def label_distribution(spark, sf_dir):
    df = tel(spark, sf_dir).select(C.defect_label().alias(K.LABEL))
    return kpi.label_distribution(df).withColumnRenamed("count", "n_rows")


@query
def esg_energy(spark, sf_dir):
    return _kpis(spark, sf_dir).selectExpr("line_id", *rounded("saved_kwh"))


@query
def esg_current_power(spark, sf_dir):
    return _kpis(spark, sf_dir).selectExpr("line_id", *rounded("draw_kw", "saving_kw"))


@query
def esg_carbon(spark, sf_dir):
    names = ("carbon_drives_kg", "carbon_scrap_kg", "scrap_lbs", "carbon_total_kg")
    return _kpis(spark, sf_dir).selectExpr("line_id", *rounded(*names))


@query
def esg_carbon_shares(spark, sf_dir):
    shares = kpi.carbon_shares(_kpis(spark, sf_dir))
    return shares.selectExpr("line_id", "part", *rounded("kg_co2e"))


_RUNNING = (
    "elapsed_s",
    "downtime_s",
    "availability",
    "performance_ratio",
    "quality",
    "oee",
)


@query
def running_oee(spark, sf_dir):
    rows = kpi.running_oee(series(spark, sf_dir))
    return rows.selectExpr(*KEYS, "cycles", "defect_cycles", *rounded(*_RUNNING))


@query
def running_oee_sharded(spark, sf_dir):
    rows = kpi.running_oee(series(spark, sf_dir, small=True))
    return rows.selectExpr(*KEYS, "cycles", "defect_cycles", *rounded(*_RUNNING))


@query
def running_energy(spark, sf_dir):
    sharded = series(spark, sf_dir)
    hidden = sharded.df.withColumn(K.temperature(2), C.interpolated_drive2())
    rows = kpi.running_energy(sharded.with_df(hidden))
    return rows.selectExpr(*KEYS, *rounded("draw_kw", "saved_kwh", "carbon_drives_kg"))


@query
def rule_alerts(spark, sf_dir):
    """Line rules on the KPIs, machine rules on the as-of row."""
    keys = ["line_id"]
    lines = kpi.line_kpis(series(spark, sf_dir)).selectExpr(
        "line_id", *rounded("availability", "performance", "quality")
    )
    row = O.at_index(
        O.add_rolling_deviation(
            rebuilt(spark, sf_dir), K.MEAN_SHORT, _load_names("Std10")
        ),
        AS_OF_INDEX,
    )
    machines = status.drive_scores(status.robot_scores(row))
    metrics = status.metrics_long(lines, keys).unionByName(
        status.metrics_long(machines, keys)
    )
    rounded_metrics = metrics.withColumn("value", F.round("value", 6))
    return status.rule_alerts(rounded_metrics).select(
        "line_id", "metric", "subject", "value", "limit", "advice"
    )


@query
def transit_forecast(spark, sf_dir):
    timed = O.add_transit(series(spark, sf_dir)).df
    rows = forecast.transit_forecast(timed)
    return rows.selectExpr("line_id", "step", *rounded("last_transit_s", "forecast_s"))


# ---- Learning ------------------------------------------------------------


@query
def classification_report(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = evaluate.classification_report(labels, "quality", "toxic")
    return rows.selectExpr("class_name", *rounded("precision", "recall", "f1"), "support")


@query
def stratified_split(spark, sf_dir):
    df = tel(spark, sf_dir).select("event_id", C.defect_label().alias(K.LABEL))
    rows = evaluate.stratified_split(df)
    return rows.withColumn("is_test", F.col("is_test").cast("int"))


@query
def time_split(spark, sf_dir):
    rows = evaluate.time_split(tel(spark, sf_dir).select("event_id", "t_us"))
    return rows.withColumn("is_test", F.col("is_test").cast("int"))


@query
def feature_matrix(spark, sf_dir):
    df = tel(spark, sf_dir).select(
        "event_id",
        K.DESCRIPTION,
        *[K.load(r) for r in K.ROBOTS],
        K.temperature(1),
        K.stopper(5),
    )
    return training.feature_matrix(df).drop(K.DESCRIPTION)


def _training_rows(spark, sf_dir) -> DataFrame:
    path = scratch(spark, "features")
    features = O.add_features(rebuilt(spark, sf_dir)).df
    split = evaluate.stratified_split(features.drop(SHARD))
    split.write.parquet(path)
    return spark.read.parquet(path)


@query
def train_score(spark, sf_dir):
    """Fit on the training rows, store and reload the model, score the rest.

    Returned is what must hold whatever the fitted trees are: which rows are scored,
    that their class probabilities add up to 1, and that the class is the likeliest.
    """
    rows = _training_rows(spark, sf_dir)
    model = training.train(rows.where(~F.col("is_test")))
    path = scratch(spark, "model")
    training.save(model, path)
    scored = training.score(training.load(path), rows.where("is_test"))
    return _score_facts(scored)


@query
def boosted_score(spark, sf_dir):
    """The same for one-against-rest boosted trees, small ones."""
    rows = _training_rows(spark, sf_dir)
    small = training.classifier("boosted")
    small.setClassifier(small.getClassifier().setMaxIter(3).setMaxDepth(3))
    model = training.train(rows.where(~F.col("is_test")), estimator=small)
    return _score_facts(training.score(model, rows.where("is_test")))


@query
def softmax_score(spark, sf_dir):
    """The same for one ensemble over all classes, with the operator's defaults, and that
    it explains its training rows better than the class shares do."""
    rows = _training_rows(spark, sf_dir)
    path = scratch(spark, "softmax")
    training.save(training.train(rows.where(~F.col("is_test")), "softmax"), path)
    model = boosting.Booster.load(spark, path)
    own = training.score(model, rows.where(~F.col("is_test")))
    chance = F.element_at("probabilities", F.col(K.LABEL) + 1)
    loss = own.agg(F.avg(-F.log(chance))).first()[0]
    # The same rows as those scored, counted without scoring them again.
    counts = [r["count"] for r in rows.where(~F.col("is_test")).groupBy(K.LABEL).count().collect()]
    prior = sum(-n / sum(counts) * math.log(n / sum(counts)) for n in counts)
    facts = _score_facts(training.score(model, rows.where("is_test")))
    trees = sum(map(len, model.rounds))
    return facts.withColumns({"beats_prior": F.lit(loss < prior), "n_trees": F.lit(trees)})


def _score_facts(scored: DataFrame) -> DataFrame:
    shares, best = F.col("probabilities"), F.array_max("probabilities")
    total = F.aggregate(shares, F.lit(0.0), lambda a, b: a + b)
    return scored.select(
        *KEYS,
        K.LABEL,
        F.size(shares).alias("n_classes"),
        F.round(total, 6).alias("total"),
        (F.element_at(shares, F.col("prediction") + 1) == best).alias("is_likeliest"),
        F.forall(shares, lambda p: p.between(0.0, 1.0)).alias("in_range"),
    )


# ---- Streams -------------------------------------------------------------


STREAM_SLICES, SLICE_FILES = 3, 2


def _stream_session(spark) -> SparkSession:
    """A session of its own for streams with state, one state partition per core.

    The number of state partitions is fixed when a stream first runs and every
    one of them is committed in every micro-batch. The state is on disk, as it has a
    row for each instant or event of the batches that are still open.
    """
    session = state_on_disk(use_utc(spark.newSession()))
    cores = str(spark.sparkContext.defaultParallelism)
    session.conf.set("spark.sql.shuffle.partitions", cores)
    return session


def _stream_source(session, df: DataFrame) -> DataFrame:
    """The rows as a stream that delivers one slice of time per micro-batch."""
    path = scratch(session, "stream")
    low, high = df.agg(F.min("t_us"), F.max("t_us")).first()
    part = F.floor((F.col("t_us") - low) * STREAM_SLICES / (high - low + 1))
    for number in range(STREAM_SLICES):
        slice_ = df.where(part == number).repartition(SLICE_FILES)
        slice_.write.mode("append").parquet(path)
        # A thin slice writes fewer files. Empty ones make up for them, so that no
        # micro-batch takes files of the next slice.
        files = session.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
        for _ in range((number + 1) * SLICE_FILES - files.count()):
            df.limit(0).coalesce(1).write.mode("append").parquet(path)
    return (
        session.readStream.schema(df.schema)
        .option("maxFilesPerTrigger", SLICE_FILES)
        .parquet(path)
    )


@query
def stream_transit(spark, sf_dir):
    """Transit and gap over micro-batches; equals the batch result."""
    df = tel(spark, sf_dir).select(*KEYS, "t_us", K.STOPPER1, K.STOPPER3)
    out = scratch(spark, "transit")
    rows = live.run_transit(_stream_source(_stream_session(spark), df), out)
    return rows.selectExpr(*KEYS, *rounded("dt"), K.TRANSIT)


@query
def stream_downtime(spark, sf_dir):
    """Downtime and energy per line and window, the open ones included, over streamed gaps."""
    df = tel(spark, sf_dir).select(
        *KEYS,
        "t_us",
        K.STOPPER1,
        K.STOPPER3,
        K.ESTOP,
        K.DOOR1,
        K.DOOR2,
        K.temperature(1),
        C.interpolated_drive2().alias(K.temperature(2)),
        K.temperature(3),
        K.temperature(4),
    )
    out = scratch(spark, "gaps")
    session = _stream_session(spark)
    timed = live.run_transit(_stream_source(session, df), out)
    stamped = timed.withColumn("timestamp", F.timestamp_micros("t_us"))
    stream = _stream_source(session, stamped)
    result = windows.windowed_kpis(stream, unique=["event_id"])
    rows = windows.run_update(result, scratch(spark, "windows"), ("line_id", "window_start"))
    sums = ("elapsed_s", "estop_s", "door1_s", "door2_s", "downtime_s", "saved_kwh")
    return rows.selectExpr(
        "line_id",
        "unix_micros(window_start) AS window_start_us",
        "n_rows",
        *rounded(*sums),
    )


@query
def stream_unify(spark, sf_dir):
    """All seven source streams aligned on line and instant; equals the batch join."""
    session, streams = _stream_session(spark), []
    for name in K.SOURCES:
        source = raw_source(spark, sf_dir, name)
        stamped = source.withColumn("timestamp", C.parse_time(F.col(K.TIME_TEXT)))
        timed = stamped.drop(K.TIME_TEXT).withColumn("t_us", F.unix_micros("timestamp"))
        stream = _stream_source(session, timed.where(F.col("t_us").isNotNull()))
        streams.append(stream if name == "conveyor" else stream.drop("t_us"))
    keys = ("line_id", "timestamp")
    gathered = windows.run_update(windows.align_streams(streams, keys), scratch(spark, "aligned"), keys)
    columns = [c for n in K.SOURCES for c in K.SOURCE_COLUMNS[n]]
    return windows.aligned(gathered, keys).select(*KEYS, "t_us", *columns)
