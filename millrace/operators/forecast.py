"""Outlook of the transit time."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace import constants as K
from millrace.operators.shards import SERIES, Series


def transit_forecast(
    df: DataFrame,
    series: Series = SERIES,
    steps: int = K.FORECAST_STEPS,
    noise_seed: int | None = None,
) -> DataFrame:
    """Next ``steps`` values per line, from the line's last transit time.

    A bottleneck is expected to ease by a fixed amount per step; otherwise the
    normal value is expected. With ``noise_seed``, normal noise (0.2 s in a
    bottleneck, 0.5 s else) is added.
    """
    last = df.groupBy(series.line).agg(
        F.max_by(K.TRANSIT, F.struct(*series.order)).alias("last_transit_s")
    )
    ahead = last.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(steps))))
    slow = F.col("last_transit_s") > K.BOTTLENECK_S
    value = F.when(
        slow, F.col("last_transit_s") - K.FORECAST_DECAY_S * F.col("step")
    ).otherwise(K.DEFAULT_TRANSIT_S)
    if noise_seed is not None:
        value = value + F.randn(noise_seed) * F.when(slow, 0.2).otherwise(0.5)
    return ahead.withColumn("forecast_s", value)
