"""Health scores and the status texts shown for one row."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from millrace import constants as K
from millrace.functions.columns import downtime, is_zero


def _penalty(value: Column, limit: float, span: float) -> Column:
    """How far a value is above its limit, in points; missing values cost 0."""
    return F.greatest(F.lit(0.0), (value - limit) / span)


def robot_health(robot: str) -> Column:
    """0-100; the worse of load and vibration counts."""
    load = K.load(robot)
    worst = F.greatest(
        _penalty(F.col(load), K.LOAD_LIMIT_N, K.LOAD_SPAN),
        _penalty(F.col(f"{load}_Std10"), K.VIBRATION_LIMIT_N, K.VIBRATION_SPAN),
    )
    return F.greatest(F.lit(0.0), 100.0 - worst)


def drive_health(drive: int) -> Column:
    """0-100; a missing temperature scores 100."""
    over = F.greatest(
        F.lit(0.0), (F.col(K.temperature(drive)) - K.TEMP_LIMIT_C) * K.TEMP_SLOPE
    )
    return F.greatest(F.lit(0.0), 100.0 - over)


def health_band(health: Column) -> Column:
    return (
        F.when(health > K.GOOD_HEALTH, "good")
        .when(health > K.WARN_HEALTH, "warn")
        .otherwise("bad")
    )


def stopper_text(column: str) -> Column:
    return F.when(F.col(column) == 1.0, "Holding").otherwise("Release")


def line_state() -> Column:
    return F.when(downtime(), "STOPPED").otherwise("RUNNING")


def stop_causes() -> Column:
    """Active causes, comma separated; empty when the line runs."""
    return F.concat_ws(
        ", ",
        F.when(is_zero(K.ESTOP), K.CAUSE_ESTOP),
        F.when(is_zero(K.DOOR1), K.CAUSE_DOOR1),
        F.when(is_zero(K.DOOR2), K.CAUSE_DOOR2),
    )


def transit_verdict(column: str = K.TRANSIT) -> Column:
    return F.when(F.col(column) > K.BOTTLENECK_S, "bottleneck").otherwise("normal")


def transit_trend(column: str = K.TRANSIT) -> Column:
    """Delta text next to the transit time; NULL between the two limits."""
    return F.when(F.col(column) < K.TRANSIT_FAST_S, "-0.2s").when(
        F.col(column) > K.TRANSIT_SLOW_S, "+3.1s Bottleneck!"
    )


def jammed(column: str = K.TRANSIT) -> Column:
    return F.coalesce(F.col(column) > K.JAM_S, F.lit(False))


def fixed_text(value: Column, places: int, sign: bool = False) -> Column:
    """Number as shown on a card, such as ``12.50`` or ``+3``."""
    return F.format_string(f"%{'+' if sign else ''}.{places}f", value)
