"""Refreshing by parts is safe when a run ends midway; its SQL is in ``test_oracle``."""

import pytest
from pyspark.sql import functions as F

from catalog import queries as Q
from millrace import constants as K
from millrace.operators.shards import Series
from millrace.plans import daily


def source(spark, low, high):
    """All columns of the seven sources in one, which is a join of one."""
    df = Q.tel(spark, "/root/testdata/sf0.001").where(F.col("event_id").between(low, high))
    names = [c for n in K.SOURCES for c in K.SOURCE_COLUMNS[n]]
    return [df.select("line_id", "event_id", F.col("event_id").alias("t_us"), *names)]


def test_a_run_that_ends_midway(spark, tmp_path, monkeypatch):
    made = daily.PartedLayers(spark, str(tmp_path), Series("line_id", "t_us", ("event_id",)))
    assert made.parts() == []
    made.refresh("2024-01-01", source(spark, 0, 199))
    old = sorted(map(str, made.read(daily.GOLD).collect()))

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(made, "publish", lost)
        with pytest.raises(RuntimeError):
            made.refresh("2024-01-02", source(spark, 200, 399))
    assert made.parts() == ["2024-01-01"] and sorted(map(str, made.read(daily.GOLD).collect())) == old
    for _ in range(2):  # once more makes the last part anew
        made.refresh("2024-01-02", source(spark, 200, 399))
        assert made.read(daily.GOLD).count() == 400
    assert made.read(daily.GOLD, "2024-01-02").agg(F.min("event_id")).first()[0] == 200
    with pytest.raises(ValueError, match="older"):
        made.refresh("2024-01-01", source(spark, 0, 199))
    with pytest.raises(ValueError, match="not later"):
        made.refresh("2024-01-03", source(spark, 390, 450))
    assert made.parts() == ["2024-01-01", "2024-01-02"]
