"""Drive power from temperature."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, functions as F

from millrace import constants as K
from millrace.functions.columns import clip


def clipped_temperature(drive: int) -> Column:
    return clip(F.col(K.temperature(drive)), K.CLIP_LOW_C, K.CLIP_HIGH_C)


def drive_power(drive: int) -> Column:
    """kW of one drive: a base load plus a share per degree above the knee."""
    temp = clipped_temperature(drive)
    above = F.when(temp.isNotNull(), F.greatest(F.lit(0.0), temp - K.DRIVE_KNEE_C))
    return K.DRIVE_BASE_KW + above * K.DRIVE_KW_PER_C


def power_draw() -> Column:
    """kW of all drives; NULL if one temperature is missing."""
    return reduce(add, [drive_power(d) for d in K.DRIVES])


def power_saving() -> Column:
    return K.LEGACY_KW - power_draw()
