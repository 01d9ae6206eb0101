"""Small null-safe column helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace import constants as K


# A full date, T or a blank, a full time, perhaps fractions and a zone.
WHOLE_TIME = (
    r"^\s*[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?"
    r"\s*(Z|UTC|[+-][0-9]{2}(:?[0-9]{2})?)?\s*$"
)


def with_exprs(df: DataFrame, exprs: dict[str, str]) -> DataFrame:
    """Add or replace columns given as SQL text, in one projection.

    For steps that make dozens of alike columns: text reaches the JVM in one
    call, ``Column`` objects need several calls each.
    """
    kept = [f"`{c}`" for c in df.columns if c not in exprs]
    return df.selectExpr(*kept, *[f"{e} AS `{n}`" for n, e in exprs.items()])


def number(column: str) -> str:
    """SQL: text or number to double; unreadable values and NaN become NULL."""
    return f"nanvl(try_cast(`{column}` AS DOUBLE), CAST(NULL AS DOUBLE))"


def coerce_numeric(df: DataFrame, keep: tuple[str, ...] = K.TEXT_COLUMNS) -> DataFrame:
    """Turn every column outside ``keep`` into a double, in one projection."""
    return df.selectExpr(
        *[f"`{c}`" if c in keep else f"{number(c)} AS `{c}`" for c in df.columns]
    )


def clip(value: Column, low: float, high: float) -> Column:
    """Limit to [low, high]; NULL stays NULL (greatest/least would skip it)."""
    return F.when(
        value.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), value))
    )


def unit_interval(value: Column) -> Column:
    return clip(value, 0.0, 1.0)


def is_zero(column: str) -> Column:
    """True where the signal is 0; a missing signal counts as not 0."""
    return F.coalesce(F.col(column) == 0.0, F.lit(False))


def parse_time(text: Column) -> Column:
    """Instant from ISO text with or without milliseconds.

    The text must hold a whole date and time; a cast alone would also read a bare
    year, or a bare time as of today. One cast reads every accepted form, also
    microseconds or a blank instead of T, and honours the zone letter, so the result
    does not follow the session zone. Other text gives NULL. Trying explicit patterns
    one after another costs an exception per miss.
    """
    return F.when(text.rlike(WHOLE_TIME), text.try_cast("timestamp"))


def downtime() -> Column:
    """Line is down: emergency stop pressed or a safety door open."""
    return is_zero(K.ESTOP) | is_zero(K.DOOR1) | is_zero(K.DOOR2)


def defect_label(text: str = K.DESCRIPTION) -> Column:
    """Class number of a description; anything but the three texts is 0."""
    label = F.lit(0)
    for number_, name in K.DEFECT_TEXTS.items():
        label = F.when(F.col(text) == name, number_).otherwise(label)
    return label.cast("int")


def bottleneck(column: str = K.TRANSIT, limit: float = K.BOTTLENECK_S) -> Column:
    return F.when(F.col(column) > limit, 1).otherwise(0)


def interpolated_drive2() -> Column:
    """Hidden drive temperature as the mean of its two neighbours."""
    return (F.col(K.temperature(1)) + F.col(K.temperature(3))) / 2.0
