"""KPIs and histories from the index against the same over the whole prefix."""

import pytest
from pyspark.sql import functions as F

from catalog.queries import rebuilt
from millrace import constants as K
from millrace.operators import kpi, ordered as O
from millrace.operators.shards import SHARD, Series, shard
from millrace.plans import asof
from millrace.sources import layers

NAMES = ["line_id", "cycles", "defect_cycles", "elapsed_s", "downtime_s", "oee", "saved_kwh", "draw_kw", "avg_transit_s"]


@pytest.fixture(scope="module")
def layer(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("asof"))
    rows = rebuilt(spark, "/root/testdata/sf0.001").df.drop(SHARD)
    # Spread over days, and shards of about 30 rows.
    rows = rows.withColumn("t_us", F.col("t_us") * 60)
    rows = shard(rows, rows_per_shard=30).df.withColumn(layers.DAY, F.to_date(F.timestamp_micros("t_us")))
    layers.write_layer(rows, f"{path}/gold", ("line_id", SHARD, "t_us"), arrange=False)
    gold = layers.read_layer(spark, f"{path}/gold")
    asof.build(gold, f"{path}/index")
    return gold, f"{path}/index"


def moments(gold):
    low, high = gold.agg(F.min("t_us"), F.max("t_us")).first()
    one = gold.where("line_id = 3").orderBy("t_us").limit(40).collect()[-1].t_us
    return [low - 1, low, one, (low + high) // 2, high - 1, high, high + 10**9]


def test_every_moment_equals_the_prefix(layer):
    gold, index = layer
    for at in moments(gold):
        early = O.up_to_time(gold, at).drop(SHARD, layers.DAY)
        want = {r.line_id: r for r in kpi.line_kpis(shard(early)).select(NAMES).collect()}
        got = {r.line_id: r for r in asof.line_kpis(gold, index, at).select(NAMES).collect()}
        assert set(got) == set(want)
        for line, row in want.items():
            whole, indexed = ([-1 if v is None else v for v in r] for r in (row, got[line]))
            assert indexed == pytest.approx(whole, rel=1e-9, abs=1e-9)


def test_trailing_equals_the_history(layer):
    gold, index = layer
    for at in moments(gold)[1:]:
        early = O.up_to_time(gold, at).drop(SHARD, layers.DAY)
        names = ["line_id", "event_id", "idx", "rel_index"]
        want = O.trailing_history(shard(early), 70).select(names)
        assert sorted(asof.trailing(gold, index, 70, at).select(names).collect()) == sorted(want.collect())


def test_one_shard_of_each_line_is_read(layer):
    gold, index = layer
    low, high = gold.agg(F.min("t_us"), F.max("t_us")).first()
    at = low + (high - low) * 9 // 10
    rows = asof.open_rows(gold, index, at)
    assert rows.groupBy("line_id").agg(F.count_distinct(SHARD).alias("n")).where("n > 1").count() == 0
    files = lambda df: df.select("_metadata.file_path").distinct().count()
    read = gold.where(F.col("t_us") <= at)
    assert 0 < rows.count() < read.count() / 2
    plan = asof.line_kpis(gold, index, at)
    plan.collect()
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in text and f"LessThanOrEqual(t_us,{at})" in text
    opened = read.where(F.col(SHARD).isin([r[0] for r in rows.select(SHARD).distinct().collect()]))
    assert files(opened) <= files(read)


def test_no_label_no_energy_and_no_rows(spark, layer, tmp_path):
    gold, _ = layer
    bare = gold.drop(K.temperature(2), K.TRANSIT).withColumn("t_us", F.when(F.col("event_id") % 10 != 0, F.col("t_us")))
    bare.write.parquet(str(tmp_path / "bare"))
    bare = spark.read.parquet(str(tmp_path / "bare"))
    asof.build(bare, str(tmp_path / "i"))
    at = moments(gold)[3]
    want = {r.line_id: r.oee for r in kpi.line_kpis(shard(O.up_to_time(bare, at).drop(SHARD))).collect()}
    got = {r.line_id: r.oee for r in asof.line_kpis(bare, str(tmp_path / "i"), at).collect()}
    assert got == pytest.approx(want)
    empty = gold.limit(0)
    asof.build(empty, str(tmp_path / "e"))
    assert asof.line_kpis(empty, str(tmp_path / "e"), at).count() == 0
    with pytest.raises(ValueError):
        asof.build(gold.drop(SHARD), str(tmp_path / "x"), Series())
