"""Vector columns as whole numbers: which rows take part, and arrays of them in tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F


def whole_numbers(vectors: DataFrame, vector: str, step: int, shift: int, largest: int) -> DataFrame:
    """``vectors`` with a column ``x`` of ``floor(step * component) + shift``.

    Rows go whose vector is null, empty or holds a null, non-finite or larger component
    (``abs(x - shift) >= largest``), and rows whose vector has another length than most
    have (of equally frequent lengths the longest counts).
    """
    bad = f"exists(`{vector}`, c -> c is null or isnan(c) or abs({step}D * c) >= {largest}D)"
    usable = vectors.where(F.coalesce(F.expr(f"size(`{vector}`) > 0 and not {bad}"), F.lit(False)))
    out = usable.withColumn("x", F.expr(f"transform(`{vector}`, c -> cast(floor({step}D * c) as bigint) + {shift}L)"))
    length = out.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    return out.where(F.size("x") == (length["size"] if length else 0))


def matrix(lists: pa.Array, kind: type = np.int64) -> np.ndarray:
    """A list column of equally long rows as a two-dimensional array."""
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return np.asarray(flat, dtype=kind).reshape(len(lists), -1)
