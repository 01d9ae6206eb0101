"""Rules of the ordered operators on hand-made rows."""

import pytest

from millrace import constants as K
from millrace.operators import ordered as O
from millrace.operators.shards import Series, shard

S = 1_000_000


def edges(spark, rows):
    schema = (
        f"line_id int, event_id int, t_us bigint, {K.STOPPER1} double, {K.STOPPER3} double"
    )
    return spark.createDataFrame([(1, i, *r) for i, r in enumerate(rows)], schema)


def values(df, *columns):
    return [tuple(r) for r in df.orderBy("line_id", "t_us", "event_id").select(*columns).collect()]


# Shard sizes: one shard, two rows per shard, one row per shard.
SIZES = pytest.mark.parametrize("size", [None, 2, 1])


@SIZES
def test_transit_rules(spark, size):
    rows = [
        (0 * S, None, None),  # first row, nothing known
        (1 * S, 1.0, 0.0),
        (2 * S, 1.0, 1.0),  # receipt before any release: no measurement
        (3 * S, 0.0, 0.0),  # release
        (5 * S, 0.0, 1.0),  # receipt: 2 s
        (6 * S, 1.0, 0.0),
        (9 * S, 1.0, 1.0),  # second receipt after the same release: 6 s
        (10 * S, 1.0, 0.0),
        (12 * S + 500_000, 0.0, 1.0),  # both on one row: 0 s
        (13 * S, None, None),
    ]
    timed = O.add_transit(shard(edges(spark, rows), rows_per_shard=size), keep_events=True)
    got = values(timed.df, O.RELEASE, O.RECEIPT, "transit_time_seconds", K.TRANSIT)
    assert got == [
        (False, False, None, 12.5),
        (False, False, None, 12.5),
        (False, True, None, 12.5),
        (True, False, None, 12.5),
        (False, True, 2.0, 2.0),
        (False, False, None, 2.0),
        (False, True, 6.0, 6.0),
        (False, False, None, 6.0),
        (True, True, 0.0, 0.0),
        (False, False, None, 0.0),
    ]


@SIZES
def test_null_status_is_no_edge(spark, size):
    rows = [(0, 1.0, 0.0), (S, None, None), (2 * S, 0.0, 1.0)]
    got = O.add_edges(shard(edges(spark, rows), rows_per_shard=size)).df
    assert values(got, O.RELEASE, O.RECEIPT) == [(False, False)] * 3


def test_whole_seconds(spark):
    rows = [
        (0, 1.0, 0.0),
        (1_900_000, 0.0, 0.0),
        (3_100_000, 0.0, 1.0),
    ]
    part = O.add_transit(shard(edges(spark, rows))).df
    whole = O.add_transit(shard(edges(spark, rows)), whole_seconds=True).df
    assert values(part, K.TRANSIT)[-1] == (1.2,)
    assert values(whole, K.TRANSIT)[-1] == (2.0,)


@SIZES
def test_gap_rules(spark, size):
    rows = [(t, 0.0, 0.0) for t in (0, 0, 250_000, S, 3 * S)]
    sharded = shard(edges(spark, rows), rows_per_shard=size)
    both = O.add_dt(O.add_dt(sharded), first=0.1, zero_as=None, name="kpi").df
    assert values(both, "dt", "kpi") == [
        (1.0, 0.1),
        (1.0, 0.0),
        (0.25, 0.25),
        (0.75, 0.75),
        (2.0, 2.0),
    ]


@SIZES
def test_motion(spark, size):
    times = [0, S, 3 * S, 3 * S, 4 * S, 6 * S]
    angles = [10.0, 12.0, 18.0, 20.0, None, 26.0]
    df = spark.createDataFrame(
        [(1, i, t, a) for i, (t, a) in enumerate(zip(times, angles))],
        f"line_id int, event_id int, t_us bigint, {K.angle('R01', 'B')} double",
    )
    moved = O.add_motion(shard(df, rows_per_shard=size), ["R01"], ["B"]).df
    got = values(moved, K.velocity("R01", "B"), K.acceleration("R01", "B"))
    assert got == [
        (0.0, 0.0),
        (2.0, 0.0),  # acceleration needs a velocity before
        (3.0, 0.5),
        (2.0, -1.0),  # equal times count as one second
        (0.0, 0.0),  # missing angle
        (0.0, 0.0),
    ]


@SIZES
@pytest.mark.parametrize("extra", [False, True])
def test_rolling_frames(spark, size, extra):
    loads = [1.0, 2.0, None, 4.0, 5.0]
    df = spark.createDataFrame(
        [(1, i, i * S, v) for i, v in enumerate(loads)],
        "line_id int, event_id int, t_us bigint, x double",
    )
    sharded = shard(df, rows_per_shard=size)
    mean = O.add_rolling_mean(sharded, 2, {"x": "m"}, include_extra=extra)
    both = O.add_rolling_deviation(mean, 2, {"x": "s"}, include_extra=extra).df
    got = values(both, "m", "s")
    root2 = 0.5**0.5
    if extra:
        expected = [(1.0, 0.0), (1.5, root2), (1.5, root2), (3.0, 2**0.5), (4.5, root2)]
    else:
        expected = [(1.0, 0.0), (1.5, root2), (2.0, 0.0), (4.0, 0.0), (4.5, root2)]
    for g, e in zip(got, expected):
        assert g == pytest.approx(e)


@SIZES
def test_index_and_history(spark, size):
    df = spark.createDataFrame(
        [(line, i, i * S, float(i)) for line in (1, 2) for i in range(4 + line)],
        "line_id int, event_id int, t_us bigint, x double",
    )
    sharded = shard(df, rows_per_shard=size)
    assert values(O.add_index(sharded).df, "idx") == [(i,) for i in (*range(5), *range(6))]
    last = O.trailing_history(sharded, 3)
    assert values(last, "line_id", "rel_index", "x") == [
        (1, 0, 2.0), (1, 1, 3.0), (1, 2, 4.0), (2, 0, 3.0), (2, 1, 4.0), (2, 2, 5.0),
    ]
    early = O.trailing_history(sharded, 3, index=1, from_zero=False)
    assert values(early, "rel_index", "x") == [(-1, 0.0), (0, 1.0)] * 2
    # Line 1 has no row at position 5.
    assert values(O.trailing_history(sharded, 2, index=5), "line_id") == [(2,), (2,)]


def test_series_without_tie(spark):
    rows = [(i * S, 1.0 - i % 2, float(i % 2)) for i in range(6)]
    sharded = shard(edges(spark, rows).drop("event_id"), Series(ties=()), rows_per_shard=2)
    got = O.add_transit(sharded).df.orderBy("t_us").select(K.TRANSIT).collect()
    assert [r[0] for r in got] == [12.5, 0.0, 0.0, 0.0, 0.0, 0.0]
