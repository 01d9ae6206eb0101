"""Carried state: equal to whole lines, and two reads of the source."""

import random

import pytest
from pyspark.sql import functions as F

from millrace import constants as K
from millrace.operators import chain, kpi, ordered as O
from millrace.operators.shards import shard

SCHEMA = (
    f"line_id long, event_id long, t_us long, {K.STOPPER1} double, {K.STOPPER3} double, {K.ESTOP} double, "
    f"{K.DOOR1} double, {K.DOOR2} double, {K.CYCLE_COUNT} double, {K.DESCRIPTION} string"
)


def rows(seed, n=600):
    """Two lines with bursts, equal times, unknown statuses and rare events."""
    r = random.Random(seed)
    out, t = [], 0
    status = lambda p: r.choices([None, 0.0, 1.0], [0.1, p, 0.9 - p])[0]
    for k in range(n):
        t += r.choice([0, 0, 1, 500_000, 3_000_000])
        text = r.choice(["Good", "NoNose", None])
        p = r.choice([0.02, 0.45, 0.88])
        out.append((k % 7 == 0, k, t, status(p), status(p), status(0.1), status(0.05), status(0.1), float(k // 40), text))
    return [(int(a), *rest) for a, *rest in out]


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("size", [3, 40])
def test_sharded_equals_whole(spark, seed, size):
    df = spark.createDataFrame(rows(seed, 200 if size == 3 else 600), SCHEMA)
    whole, cut = shard(df), shard(df, rows_per_shard=size)
    assert whole.single and not cut.single
    key = lambda r: (r.line_id, r.t_us, r.event_id)
    for whole_seconds in (False, True):
        names = ["line_id", "t_us", "event_id", O.RELEASE, O.RECEIPT, "last_release_us", "transit_time_seconds", K.TRANSIT]
        want, got = (
            sorted(O.add_transit(s, whole_seconds=whole_seconds, keep_events=True).df.select(names).collect(), key=key)
            for s in (whole, cut)
        )
        assert got == want
    want, got = (sorted(kpi.running_oee(s).collect(), key=key) for s in (whole, cut))
    for a, b in zip(want, got):
        assert list(b) == pytest.approx(list(a), abs=1e-9)
    assert len(want) == len(got) > 0
    weights = {"up": F.col(K.STOPPER1), "all": F.lit(1.0)}
    want, got = (
        sorted(chain.add_running_time(s, weights).df.select("line_id", "t_us", "event_id", "dt", "up", "all").collect(), key=key)
        for s in (whole, cut)
    )
    for a, b in zip(want, got):
        assert list(b) == pytest.approx(list(a), abs=1e-9)


@pytest.mark.parametrize("work", ["transit", "running"])
def test_the_source_is_read_twice(spark, work):
    """Once for the state of all shards, once for the rows; cuts are placed before."""
    data = spark.createDataFrame(rows(5), SCHEMA)
    cut = shard(data, rows_per_shard=40)
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    counted = cut.with_df(cut.df.mapInPandas(seen, cut.df.schema))
    if work == "transit":
        result = O.add_transit(counted).df.select("line_id", K.TRANSIT)
    else:
        result = kpi.running_oee(counted)
    assert read.value == 600
    result.collect()
    assert read.value == 1200
