"""Whitening of vectors with the eigenvectors of their covariance.

Every task turns its part of the fit list into a spectrum by centred rank-one updates
(``spectrum``); spectra are combined, again by successive rank-one updates, in groups of
``FAN`` until one is left. Its vectors are then the basis of a Rayleigh-Ritz step over
all rows of the fit list, centred by their exact mean, so that the result doesn't carry
the updates' rounding. Only tables of the vectors' size squared reach the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from millrace.llm.numbers import matrix, whole_numbers
from millrace.llm.spectrum import Spectrum
from millrace.llm.tables import stored

#: x = floor(STEP * component) + SHIFT; components from LARGEST / STEP on don't take part.
STEP, SHIFT, LARGEST = 64, 1_000_000, 1 << 52
#: Rows of the fit list for each task, rows condensed before they become updates, and
#: spectra that one task combines.
TASK_ROWS, BATCH, FAN = 20_000, 1024, 16

_PART = "part long, rows long, sums array<decimal(38,0)>, mean array<double>, eigenvalues array<double>, basis array<double>"
_SQUARE = "part long, square array<double>"


@dataclass
class Whitener:
    """What ``fit`` found. ``vectors`` has the components as columns."""

    rows: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float


def _folded(parts: DataFrame, schema: str, merge: Callable[[pa.Table], pa.Table]) -> list:
    """The rows of ``parts`` merged in groups of ``FAN``, level by level, into one row."""
    parts = stored(parts)
    most = parts.agg(F.max("part")).first()[0]
    while most:
        parts = parts.withColumn("part", F.floor(F.col("part") / FAN)).groupBy("part").applyInArrow(lambda t: merge(t), schema)
        most //= FAN
    return parts.collect()


def _centred(x: np.ndarray, rows: int, sums: list[int]) -> np.ndarray:
    """``x - sums / rows``, subtracted in whole numbers and then rounded once."""
    return _deviations(x, rows, sums).astype(np.float64) / rows


def _deviations(x: np.ndarray, rows: int, sums: list[int]) -> np.ndarray:
    """``rows * x - sums``, exact; as Python's numbers if 64 bits don't hold it."""
    near = [s // rows for s in sums]
    rest = [s - rows * c for s, c in zip(sums, near)]
    away = x - np.array(near, dtype=np.int64)
    if rows * (int(np.abs(away).max(initial=0)) + 1) < 1 << 62:
        return rows * away - np.array(rest, dtype=np.int64)
    return rows * away.astype(object) - np.array(rest, dtype=object)


def _spectra(batch_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, sums, waiting = None, None, []

        def take(whole: bool) -> None:
            nonlocal waiting
            rows = np.concatenate(waiting)
            stop = len(rows) if whole else len(rows) // batch_rows * batch_rows
            for at in range(0, stop, batch_rows):
                found.add(rows[at : min(stop, at + batch_rows)])
            waiting = [rows[stop:]]

        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                x = matrix(batch.column("x").slice(at, 512))
                if found is None:
                    found, sums = Spectrum.empty(x.shape[1]), [0] * x.shape[1]
                sums = [s + int(t) for s, t in zip(sums, x.sum(axis=0))]
                waiting.append((x - SHIFT).astype(np.float64))
                if sum(map(len, waiting)) >= batch_rows:
                    take(False)
        if found is not None:
            take(True)
            yield from _part(TaskContext.get().partitionId(), sums, found).to_batches()

    return run


def _part(part: int, sums: list[int], found: Spectrum) -> pa.Table:
    return pa.table(
        {
            "part": pa.array([part], pa.int64()),
            "rows": pa.array([found.rows], pa.int64()),
            "sums": pa.array([sums], pa.list_(pa.decimal128(38, 0))),
            "mean": pa.array([found.mean.tolist()]),
            "eigenvalues": pa.array([found.values.tolist()]),
            "basis": pa.array([found.vectors.ravel().tolist()]),
        }
    )


def _combined(table: pa.Table) -> pa.Table:
    rows = sorted(table.to_pylist(), key=lambda r: r["part"])
    found, sums = None, None
    for r in rows:
        values = np.array(r["eigenvalues"])
        other = Spectrum(r["rows"], np.array(r["mean"]), values, np.array(r["basis"]).reshape(len(values), -1))
        if found is None:
            found, sums = other, [int(s) for s in r["sums"]]
        else:
            found.merge(other)
            sums = [s + int(t) for s, t in zip(sums, r["sums"])]
    return _part(rows[0]["part"], sums, found)


def _added(table: pa.Table) -> pa.Table:
    squares = matrix(table.column("square").combine_chunks(), np.float64)
    return pa.table({"part": table.column("part").slice(0, 1), "square": pa.array([squares.sum(axis=0).tolist()])})


def _covariance(fit_list: DataFrame, rows: int, sums: list[int], basis: np.ndarray) -> np.ndarray:
    """Covariance of the centred fit list's coordinates along the columns of ``basis``."""
    shared = fit_list.sparkSession.sparkContext.broadcast(basis)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                along = _centred(matrix(batch.column("x").slice(at, 4096)), rows, sums) @ shared.value
                total = along.T @ along + (0 if total is None else total)
        if total is not None:
            part = pa.array([TaskContext.get().partitionId()], pa.int64())
            yield pa.RecordBatch.from_arrays([part, pa.array([total.ravel().tolist()])], ["part", "square"])

    found = _folded(fit_list.mapInArrow(run, _SQUARE), _SQUARE, _added)
    return np.array(found[0]["square"]).reshape(basis.shape[1], -1) / rows


def fit(x: DataFrame, most: int = 16, batch_rows: int = BATCH) -> Whitener | None:
    """The first ``most`` components of the distinct vectors in column ``x``.

    ``batch_rows`` rows at a time are condensed by a triangular factor to as many rows as
    the vector has entries, which have the same centred scatter and become the rank-one
    updates; with 1 each row is an update of its own. Components without variance, up to
    rounding, are left out. None if there are no rows.
    """
    fit_list = stored(x.select("x").distinct())
    rows = fit_list.count()
    if not rows:
        return None
    dealt = fit_list.repartition(-(-rows // TASK_ROWS), F.xxhash64("x"))
    found = _folded(dealt.mapInArrow(_spectra(batch_rows), _PART), _PART, _combined)[0]
    sums = [int(s) for s in found["sums"]]
    basis = np.linalg.qr(np.array(found["basis"]).reshape(len(sums), -1)[:, ::-1])[0]
    projected = _covariance(fit_list, rows, sums, basis)
    values, turn = np.linalg.eigh(projected)
    values, vectors = values[::-1], basis @ turn[:, ::-1]
    trace = float(np.trace(projected))
    keep = min(most, int((values > trace * len(values) * np.finfo(np.float64).eps).sum()))
    values, vectors = values[:keep], vectors[:, :keep]
    largest = np.abs(vectors).argmax(axis=0)
    vectors = vectors * np.where(vectors[largest, np.arange(keep)] < 0, -1.0, 1.0)
    white = _covariance(fit_list, rows, sums, vectors / np.sqrt(values)) if keep else np.zeros((0, 0))
    return Whitener(rows, sums, values, vectors, trace, float(np.abs(white - np.eye(keep)).max(initial=0.0)))


def whiten(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", most: int = 16, batch_rows: int = BATCH) -> DataFrame:
    """``key, component, n, deviation, whitened, explained, identity_error``.

    One row for each row that takes part and component, numbered from 1 by falling
    variance; ``deviation`` (decimal) is the exact sum over entries of
    ``(n * x - sums)^2``, null beyond 38 digits. Rows whose vector is null, empty, holds
    null or non-finite entries or entries of 2^46 and more, or has another length than
    most, are dropped. The fit list holds each distinct vector once, so one that a third
    of the rows share weighs no more than another. Rows with a null key stay, repeated rows stay each.
    Components without variance are left out; a table with one distinct vector, or none,
    gives no rows. Other columns are ignored, whatever their names.
    """
    base = vectors.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("v"))
    base = whole_numbers(base, "v", STEP, SHIFT, LARGEST).select("key", "x")
    kind = dict(base.dtypes)["key"]
    schema = f"key {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    model = fit(base, most, batch_rows)
    if model is None or not len(model.values):
        return vectors.sparkSession.createDataFrame([], schema).withColumnRenamed("key", key)
    shared = vectors.sparkSession.sparkContext.broadcast(astuple(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Whitener(*shared.value)
        turn, share, k = m.vectors / np.sqrt(m.values), m.values / m.trace, len(m.values)
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                piece = batch.slice(at, 2048)
                away = _deviations(matrix(piece.column("x")), m.rows, m.sums)
                white = (away.astype(np.float64) / m.rows) @ turn
                n = len(away)
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("key").take(pa.array(np.repeat(np.arange(n), k))),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)),
                        pa.array(np.full(n * k, m.rows, np.int64)),
                        _squares(away).take(pa.array(np.repeat(np.arange(n), k))),
                        pa.array(white.ravel()),
                        pa.array(np.tile(share, n)),
                        pa.array(np.full(n * k, m.identity_error)),
                    ],
                    ["key", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return base.mapInArrow(run, schema).withColumnRenamed("key", key)


def _squares(away: np.ndarray) -> pa.Array:
    """Exact sums of squares of the rows, null beyond 38 digits."""
    if away.dtype != object and (int(np.abs(away).max(initial=0)) ** 2) * away.shape[1] < 1 << 62:
        return pa.array((away * away).sum(axis=1)).cast(pa.decimal128(19, 0)).cast(pa.decimal128(38, 0))
    sums = [sum(int(v) ** 2 for v in row) for row in away]
    return pa.array([s if s < 10**38 else None for s in sums], pa.decimal128(38, 0))
