"""Hot instants in the join of the sources."""

import pytest
from pyspark.sql import functions as F

from millrace.operators import unify


def sources(spark):
    """a: 600 of 1,000 rows at one instant; b: 30 there; c: 2 there and nulls elsewhere."""
    base = spark.range(1000)
    a = base.selectExpr("id % 2 AS line_id", "CASE WHEN id % 5 < 3 AND id % 2 = 0 THEN 7 ELSE id END AS t_us", "id AS a")
    b = base.selectExpr("id % 2 AS line_id", "CASE WHEN id % 2 = 0 AND id < 60 THEN 7 ELSE id END AS t_us", "id AS b")
    c = base.selectExpr("id % 2 AS line_id", "CASE WHEN id IN (2, 4) THEN 7 WHEN id % 9 = 0 THEN NULL ELSE id END AS t_us", "id AS c")
    return [a, b, c]


def test_same_rows_spread_over_tasks(spark):
    plain = unify.unify(sources(spark))
    spread = unify.unify(sources(spark), hot_rows=20)
    assert spread.columns == plain.columns
    assert sorted(spread.collect()) == sorted(plain.collect())
    assert plain.where("t_us = 7 AND line_id = 0").count() == 300 * 30 * 2
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        parts = lambda df: df.where("t_us = 7 AND line_id = 0").select(F.spark_partition_id()).distinct().count()
        assert parts(unify.unify(sources(spark))) == 1
        assert parts(unify.unify(sources(spark), hot_rows=20)) == 8
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_pieces_follow_the_rows(spark, monkeypatch):
    rows = unify.hot_instants(sources(spark), unify.KEYS, 20).collect()
    assert [(r.line_id, r.t_us, r._pieces) for r in rows] == [(0, 7, [15, 2, 1])]
    monkeypatch.setattr(unify, "MOST_CELLS", 6)
    (few,) = unify.hot_instants(sources(spark), unify.KEYS, 20).collect()
    assert few._pieces[0] * few._pieces[1] * few._pieces[2] <= 6
    assert unify.hot_instants(sources(spark), unify.KEYS, 1000) is None


def test_sampled_keys_find_it_too(spark):
    big = spark.range(60_000).selectExpr("0 AS line_id", "CASE WHEN id % 2 = 0 THEN 5 ELSE id END AS t_us", "id AS a")
    one = spark.range(60_000).selectExpr("0 AS line_id", "id AS t_us", "id AS b")
    (row,) = unify.hot_instants([big, one], unify.KEYS, 3000).collect()
    assert row.t_us == 5 and 5 <= row._pieces[0] <= 16 and row._pieces[1] == 1


def test_clash_is_refused(spark):
    a = sources(spark)[0]
    with pytest.raises(ValueError):
        unify.unify([a, a], hot_rows=20)
