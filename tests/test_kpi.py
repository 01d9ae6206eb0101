"""KPI, score and status rules on hand-made rows."""

import pytest
from pyspark.sql import functions as F

from millrace import constants as K
from millrace.functions import columns as C, energy as E, scores as S
from millrace.operators import evaluate, forecast, kpi, ordered as O, status
from millrace.operators.shards import shard

S_US = 1_000_000
SCHEMA = (
    f"line_id int, event_id int, t_us bigint, {K.ESTOP} double, {K.DOOR1} double, "
    f"{K.DOOR2} double, {K.CYCLE_COUNT} double, {K.DESCRIPTION} string"
)
SIZES = pytest.mark.parametrize("size", [None, 2])


def rows(spark, data):
    return spark.createDataFrame([(1, i, *r) for i, r in enumerate(data)], SCHEMA)


@SIZES
def test_causes_overlap(spark, size):
    df = rows(
        spark,
        [
            (0 * S_US, 0.0, 1.0, 1.0, 1.0, "Good"),  # first row counts 0.1 s
            (1 * S_US, 1.0, 0.0, 1.0, 1.0, "NoNose"),
            (3 * S_US, 0.0, 0.0, 1.0, 1.0, "NoNose,NoBody2"),  # two causes at once
            (6 * S_US, 1.0, 1.0, None, 2.0, "NoNose "),  # missing: not down; no defect
            (7 * S_US, 1.0, 1.0, 0.0, 2.0, None),
            (9 * S_US, 1.0, 1.0, 1.0, 2.9, "NoNose,NoBody2,NoBody1"),
        ],
    )
    got = kpi.line_kpis(shard(df, rows_per_shard=size)).first()
    assert got.elapsed_s == pytest.approx(9.1)
    assert got.estop_s == pytest.approx(2.1)
    assert got.door1_s == pytest.approx(3.0)
    assert got.door2_s == pytest.approx(1.0)
    assert got.downtime_s == pytest.approx(4.1)
    assert got.availability == pytest.approx(5.0 / 9.1)
    # The counter is cut to whole cycles; cycles with a defect are counted once.
    assert (got.cycles, got.defect_cycles) == (2, 2)
    assert got.performance_ratio == pytest.approx(120.0) and got.performance == 1.0
    assert got.quality == 0.0 and got.oee == 0.0
    shown = {r.state: r.seconds for r in kpi.downtime_breakdown(kpi.line_kpis(shard(df))).collect()}
    assert set(shown) == {s for s, _ in K.BREAKDOWN_STATES}


def test_always_down(spark):
    df = rows(spark, [(i * S_US, 0.0, 1.0, 1.0, None, "Good") for i in range(3)])
    got = kpi.line_kpis(shard(df)).first()
    assert (got.availability, got.performance_ratio, got.cycles) == (0.0, 1.0, 1)
    states = [r.state for r in kpi.downtime_breakdown(kpi.line_kpis(shard(df))).collect()]
    assert states == ["E-Stop Downtime"]


def test_counter_reset_clamps_quality(spark):
    df = rows(
        spark,
        [(i * S_US, 1.0, 1.0, 1.0, float(c), "NoNose") for i, c in enumerate((5, 6, 7, 1))],
    )
    got = kpi.line_kpis(shard(df)).first()
    assert (got.cycles, got.defect_cycles) == (1, 4)
    assert got.quality_ratio == -3.0 and got.quality == 0.0 and got.yield_pct == -300.0


@SIZES
def test_running_row_equals_prefix(spark, size, sf_dir):
    from catalog.telemetry import tel

    sharded = shard(tel(spark, sf_dir), rows_per_shard=size and 200)
    at = 40
    prefix = kpi.line_kpis(O.up_to_index(sharded, at)).select(
        "line_id", "cycles", "defect_cycles", "availability", "oee"
    )
    row = O.at_index(sharded, at).select("line_id", "event_id")
    every = kpi.running_oee(sharded)
    got = sorted(every.join(row, ["line_id", "event_id"]).select(*prefix.columns).collect())
    want = sorted(prefix.collect())
    assert len(got) == len(want) == 8
    for g, w in zip(got, want):
        assert tuple(g) == pytest.approx(tuple(w))
    assert every.count() == 1_000


def test_scores(spark):
    name = K.load("R01")
    df = spark.createDataFrame(
        [
            (1500.0, 120.0, 72.0),
            (4500.0, 0.0, 92.0),
            (1800.0, 320.0, 82.0),
            (2100.0, 130.0, 76.0),
            (None, None, None),
        ],
        f"{name} double, {name}_Std10 double, {K.temperature(1)} double",
    )
    got = df.select(S.robot_health("R01"), S.drive_health(1)).collect()
    assert [tuple(r) for r in got] == [
        (100.0, 100.0),
        (0.0, 0.0),
        (0.0, 50.0),
        (80.0, 80.0),
        (100.0, 100.0),
    ]
    bands = df.select(S.health_band(S.drive_health(1))).collect()
    assert [r[0] for r in bands] == ["good", "bad", "bad", "warn", "good"]


def test_clip_keeps_gaps(spark):
    df = spark.createDataFrame([(49.0,), (50.0,), (111.0,), (None,)], f"{K.temperature(1)} double")
    got = [r[0] for r in df.select(E.clipped_temperature(1)).collect()]
    assert got == [50.0, 50.0, 110.0, None]


def test_transit_texts(spark):
    df = spark.createDataFrame([(13.9,), (14.0,), (15.5,), (16.1,), (20.1,)], f"{K.TRANSIT} double")
    got = df.select(S.transit_verdict(), S.transit_trend(), S.jammed(), C.bottleneck()).collect()
    assert [tuple(r) for r in got] == [
        ("normal", "-0.2s", False, 0),
        ("normal", None, False, 0),
        ("normal", None, False, 0),
        ("bottleneck", "+3.1s Bottleneck!", False, 1),
        ("bottleneck", "+3.1s Bottleneck!", True, 1),
    ]


def test_number_texts(spark):
    df = spark.createDataFrame([(12.504,), (-3.2,)], "v double")
    got = df.select(S.fixed_text(F.col("v"), 2), S.fixed_text(F.col("v"), 0, sign=True)).collect()
    assert [tuple(r) for r in got] == [("12.50", "+13"), ("-3.20", "-3")]


def test_stop_causes(spark):
    df = rows(spark, [(0, 0.0, 1.0, 0.0, 1.0, None), (1, 1.0, None, 1.0, 1.0, None)])
    got = df.select(S.line_state(), S.stop_causes()).collect()
    assert [tuple(r) for r in got] == [
        ("STOPPED", f"{K.CAUSE_ESTOP}, {K.CAUSE_DOOR2}"),
        ("RUNNING", ""),
    ]


def test_defect_lookup_and_confidence(spark):
    df = spark.createDataFrame([(0,), (3,), (9,)], f"{K.LABEL} int")
    got = {r[K.LABEL]: r.severity for r in status.defect_lookup(df).collect()}
    assert got == {0: "green", 3: "red", 9: None}
    sums = status.label_confidence(df).groupBy(K.LABEL).agg(F.sum("probability").alias("s"))
    assert all(r.s == pytest.approx(1.0) for r in sums.collect())


def test_rule_boundaries(spark):
    metrics = spark.createDataFrame(
        [("availability", "line", 0.9), ("quality", "line", 0.97), ("vfd_health", "VFD1", 49.9)],
        "metric string, subject string, value double",
    )
    assert sorted(r.metric for r in status.rule_alerts(metrics).collect()) == [
        "quality",
        "vfd_health",
    ]


def test_scenarios(spark):
    df = spark.createDataFrame([(70.0, 71.0, 0)], f"{K.temperature(1)} double, {K.temperature(2)} double, {K.LABEL} int")
    got = {r.scenario: tuple(r)[:3] for r in status.scenario_overlay(df).select(K.temperature(1), K.temperature(2), K.LABEL, "scenario").collect()}
    assert len(got) == 5
    assert got["Thermal Deviation (VFD 1)"] == (89.2, 78.5, 0)
    assert got["Mechanical Gripper Overload (Robot R03)"] == (70.0, 71.0, 3)
    assert got["Baseline Operations (Normal)"] == (70.0, 71.0, 0)


def test_forecast(spark):
    df = spark.createDataFrame(
        [(1, 0, 0, 12.0), (1, 1, 5, 20.0), (2, 0, 0, 30.0), (2, 1, 5, 15.5)],
        f"line_id int, event_id int, t_us bigint, {K.TRANSIT} double",
    )
    got = forecast.transit_forecast(df).orderBy("line_id", "step").collect()
    assert [r.forecast_s for r in got[:2]] == pytest.approx([19.9, 19.8])
    assert {r.forecast_s for r in got[15:]} == {12.5} and len(got) == 30
    noisy = forecast.transit_forecast(df, noise_seed=1).collect()
    assert len({r.forecast_s for r in noisy}) == 30


def test_split_is_exact_and_report_matches_ml(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    df = spark.range(3_000).select(
        F.col("id").alias("event_id"),
        F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") % 5).cast("int").alias(K.LABEL),
    )
    split = evaluate.stratified_split(df)
    shares = split.groupBy(K.LABEL).agg(
        F.count("*").alias("n"), F.sum(F.col("is_test").cast("int")).alias("t")
    )
    for r in shares.collect():
        assert r.t == round(0.2 * r.n)
    assert split.count() == 3_000
    # Test rows come from the whole range, not from one end of it.
    ids = [r.event_id for r in split.where("is_test").collect()]
    assert min(ids) < 100 and max(ids) > 2_900
    late = evaluate.time_split(df, "event_id")
    assert late.where("is_test").agg(F.min("event_id")).first()[0] >= 2_390

    scored = df.select(
        F.col(K.LABEL).cast("double").alias("label"),
        (F.col("event_id") % 4).cast("double").alias("prediction"),
    )
    report = {r.class_name: r for r in evaluate.classification_report(scored, "label", "prediction").collect()}
    for metric, name, field in (
        ("accuracy", "accuracy", "f1"),
        ("weightedPrecision", "weighted avg", "precision"),
        ("weightedRecall", "weighted avg", "recall"),
        ("f1", "weighted avg", "f1"),
    ):
        evaluator = MulticlassClassificationEvaluator(metricName=metric)
        assert report[name][field] == pytest.approx(evaluator.evaluate(scored))


def test_time_split_is_exact(spark):
    # Times far apart, so that the cut lies in a piece with nearly all rows.
    times = [k * k for k in range(20_001)] + [10**15, None]
    df = spark.createDataFrame([(t,) for t in times], "t_us long").repartition(5)
    got = {r.t_us: r.is_test for r in evaluate.time_split(df).collect()}
    known = sorted(t for t in times if t is not None)
    late = set(known[len(known) - round(0.2 * len(known)) :])
    assert got == {t: t in late for t in times}
    ties = spark.createDataFrame([(t,) for t in [1, 2, 2, 2, 3]], "t_us long")
    assert sorted(r.t_us for r in evaluate.time_split(ties, test_share=0.4).where("is_test").collect()) == [3]
    assert evaluate.time_split(ties, test_share=1.0).where("is_test").count() == 5
    assert evaluate.time_split(df.limit(0)).count() == 0


def test_any_number_of_classes(spark):
    df = spark.range(3000).select(
        F.col("id").alias("event_id"), (F.col("id") % 1500).cast("int").alias(K.LABEL)
    )
    rows = evaluate.stratified_split(df, test_share=0.5).collect()
    assert len(rows) == 3000 and sum(r.is_test for r in rows) == 1500
