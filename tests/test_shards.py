"""Sharded operators equal one window per line, whatever the shape of the data."""

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Window, functions as F

from millrace import constants as K
from millrace.operators import kpi, ordered as O
from millrace.operators import shards
from millrace.operators.shards import SHARD, Series, shard

STATUS = st.sampled_from([0.0, 1.0, None])
ROW = st.tuples(
    st.sampled_from([1, 1, 1, 2, 3]),  # one line has most of the rows
    # Half of the rows share one instant, the rest are spread or in a burst.
    st.one_of(st.just(500), st.integers(0, 2_000), st.integers(490, 510)),
    STATUS,
    STATUS,
    st.one_of(st.none(), st.integers(0, 50)),
)


def frame(spark, rows):
    data = [
        (line, i, t, a, b, None if x is None else float(x))
        for i, (line, t, a, b, x) in enumerate(rows)
    ]
    return spark.createDataFrame(
        data,
        f"line_id int, event_id int, t_us bigint, {K.STOPPER1} double, {K.STOPPER3} double, x double",
    )


def table(df, *columns):
    rows = df.select("line_id", "event_id", *columns).collect()
    return {
        (r[0], r[1]): tuple(round(v, 6) if isinstance(v, float) else v for v in r[2:])
        for r in rows
    }


@settings(
    max_examples=4,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)
@given(rows=st.lists(ROW, min_size=20, max_size=60), size=st.sampled_from([1, 3, 10]))
def test_sharded_equals_whole_line(spark, rows, size):
    df = frame(spark, rows)
    whole, cut = shard(df), shard(df, rows_per_shard=size)
    assert whole.single and not cut.single

    def everything(sharded):
        s = O.forward_fill(sharded, "x", "filled")
        s = O.add_index(s)
        s = O.add_transit(s, keep_events=True)
        s = O.add_dt(s, first=0.1, zero_as=None)
        s = O.add_running(s, {"total": F.col("dt")})
        s = O.add_rolling_mean(s, 7, {"x": "mean"})
        s = O.add_rolling_mean(s, 23, {"x": "long"})
        s = O.add_rolling_deviation(s, 4, {"x": "std"})
        return table(
            s.df, "filled", "idx", O.RELEASE, O.RECEIPT, K.TRANSIT, "dt", "total", "mean", "long", "std"
        )

    assert everything(cut) == everything(whole)


def test_long_mean_equals_plain_frame(spark):
    rows = [(1 + i % 2, i // 3, 1.0, 0.0, None if i % 7 == 0 else i * i) for i in range(160)]
    df = frame(spark, rows)
    w = Window.partitionBy("line_id").orderBy("t_us", "event_id")
    for size in (None, 9):
        for n in (9, 10, 11, 20, 60, 61):
            got = O.add_rolling_mean(shard(df, rows_per_shard=size), n, {"x": "m"}).df
            want = df.withColumn("m", F.avg("x").over(w.rowsBetween(1 - n, 0)))
            assert table(got, "m") == table(want, "m")


def test_shards_are_even_and_ordered(spark):
    """A line with most rows, half of them at one instant, still gets cut."""
    rows = spark.range(20_000).select(
        F.when(F.col("id") % 10 < 8, 1).otherwise(F.col("id") % 7).cast("int").alias("line_id"),
        F.col("id").alias("event_id"),
        F.when(F.col("id") % 2 == 0, 5_000_000).otherwise(F.col("id") * 977).alias("t_us"),
    )
    cut = shard(rows, rows_per_shard=500)
    sizes = cut.df.groupBy("line_id", SHARD).count()
    assert sizes.agg(F.max("count")).first()[0] <= 1_500
    w = Window.partitionBy("line_id").orderBy("t_us", "event_id")
    falls = cut.df.withColumn("_before", F.lag(SHARD).over(w)).where(
        F.col("_before") > F.col(SHARD)
    )
    assert falls.count() == 0
    assert cut.df.count() == 20_000


def test_stored_shards_are_kept(spark):
    df = frame(spark, [(1, t, 1.0, 0.0, t) for t in range(10)])
    stored = df.withColumn(SHARD, (F.col("t_us") / 4).cast("long"))
    assert not shard(stored).single
    assert shard(df.withColumn(SHARD, F.lit(3).cast("long"))).single
    got = O.add_rolling_mean(shard(stored), 4, {"x": "m"}).df
    want = O.add_rolling_mean(shard(df), 4, {"x": "m"}).df
    assert table(got, "m") == table(want, "m")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_single_partition_and_one_wide_exchange(spark, sf_dir):
    from catalog.telemetry import tel

    df = tel(spark, sf_dir)
    for size in (None, 100):
        sharded = shard(df, rows_per_shard=size)
        for result in (
            O.add_features(O.rebuild_hidden(sharded)).df,
            kpi.line_kpis(sharded).select("line_id", "oee"),
            kpi.running_oee(sharded),
        ):
            assert "SinglePartition" not in plan_of(result)
    whole = O.add_features(O.rebuild_hidden(shard(df))).df
    assert plan_of(whole).count("Exchange hashpartitioning") == 1
    assert plan_of(whole).count("Sort [") == 1


def test_only_needed_columns_are_read(spark, sf_dir):
    from catalog.telemetry import tel

    plan = plan_of(kpi.line_kpis(shard(tel(spark, sf_dir))).select("line_id", "availability"))
    assert "props" not in plan and "value" not in plan.split("ReadSchema")[1]


def test_text_ties_and_two_ties_at_a_hot_instant(spark):
    rows = [(0, 5 if k % 4 else k, k % 7, f"t{k:05d}") for k in range(4000)]
    df = spark.createDataFrame(rows, "line_id long, t_us long, a long, b string")
    for ties in (("b",), ("a", "b")):
        cut = shard(df, Series(ties=ties), rows_per_shard=200).df
        order = ["t_us", *ties]
        got = [r.shard for r in cut.orderBy(*order).collect()]
        assert got == sorted(got) and len(set(got)) > 10


def test_sharded_chain_reads_its_source_once(spark, sf_dir):
    # Carried values are stored tables; they do not run the chain below them again.
    from catalog.telemetry import tel

    cut = shard(tel(spark, sf_dir), rows_per_shard=100)
    assert not cut.single
    chains = {
        "transit": O.rebuild_hidden(cut).df,
        "index": O.add_index(O.rebuild_hidden(cut)).df,
        "running": kpi.running_oee(cut),
    }
    for name, df in chains.items():
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan parquet") <= 2, name
        assert plan.count("Exchange hashpartitioning") <= (4 if name == "running" else 1), name


def test_shards_of_wide_rows_hold_fewer_rows(spark, monkeypatch):
    """A task sorts whole shards: their bytes count, not their rows alone."""
    monkeypatch.setattr(shards, "ROWS_PER_SHARD", 4_000)
    monkeypatch.setattr(shards, "SHARD_BYTES", 100_000)
    keys = spark.range(4_000).selectExpr("id % 2 AS line_id", "id AS event_id", "id * 7 AS t_us")
    assert shard(keys).single
    wide = keys.selectExpr("*", *[f"event_id * 1D AS x{k}" for k in range(97)])
    cut = shard(wide)
    most = cut.df.groupBy("line_id", SHARD).count().agg(F.max("count")).first()[0]
    assert not cut.single and most * 800 <= 2 * 100_000
    assert cut.df.count() == 4_000
    whole = O.add_running(shard(keys), {"total": F.col("t_us")})
    assert table(O.add_running(cut, {"total": F.col("t_us")}).df, "total") == table(whole.df, "total")
