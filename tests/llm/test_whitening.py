"""Whitening against a plain eigendecomposition in whole numbers and doubles."""

import collections

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import queries, spectrum, whitening


def scatter(rows):
    centred = rows - rows.mean(axis=0)
    return centred.T @ centred


@pytest.mark.parametrize("size", [1, 2, 5, 24])
@pytest.mark.parametrize("batch", [1, 7, 512])
def test_updates_are_the_scatter(size, batch):
    rows = np.floor(np.random.default_rng(size).standard_normal((400, size)) * 8)
    found = spectrum.Spectrum.empty(size)
    for at in range(0, len(rows), batch):
        found.add(rows[at : at + batch])
    want = scatter(rows)
    assert found.rows == 400 and np.allclose(found.mean, rows.mean(axis=0), atol=1e-12)
    assert np.allclose(found.vectors.T @ found.vectors, np.eye(size), atol=1e-12)
    assert np.allclose(found.vectors * found.values @ found.vectors.T, want, atol=1e-10 * np.trace(want))
    assert (np.diff(found.values) >= 0).all()


@pytest.mark.parametrize(
    "rows",
    [
        np.ones((30, 4)),
        np.repeat(np.random.default_rng(1).standard_normal((3, 6)), 40, axis=0),
        np.eye(8)[np.random.default_rng(2).integers(0, 8, 300)] * 1e6,
        np.random.default_rng(3).standard_normal((500, 6)) * np.logspace(-6, 6, 6),
        np.zeros((1, 3)),
    ],
    ids=["equal", "few", "axes", "scales", "one"],
)
def test_deflation(rows):
    found = spectrum.Spectrum.empty(rows.shape[1])
    for at in range(0, len(rows), 3):
        found.add(rows[at : at + 3])
    want = scatter(rows)
    assert np.allclose(found.vectors * found.values @ found.vectors.T, want, atol=1e-12 * max(np.trace(want), 1e-300))
    assert np.allclose(found.vectors.T @ found.vectors, np.eye(rows.shape[1]), atol=1e-11)


def test_merging_in_any_order():
    r = np.random.default_rng(4)
    parts = [r.standard_normal((n, 9)) * r.uniform(1, 5, 9) + 100 for n in (1, 3, 50, 400)]
    total = spectrum.Spectrum.empty(9)
    for p in parts:
        one = spectrum.Spectrum.empty(9)
        one.add(p)
        total.merge(one)
    want = scatter(np.concatenate(parts))
    assert total.rows == 454 and np.allclose(total.vectors * total.values @ total.vectors.T, want, atol=1e-9)


def check(rows, got, most=16):
    """rows: (id, vector) that take part; got: the query's rows."""
    x = {k: [int(np.floor(64 * float(c))) + 1_000_000 for c in v] for k, v in rows}
    fit = np.array(sorted({tuple(v) for v in x.values()}), dtype=np.int64)
    n, sums = len(fit), [int(s) for s in fit.sum(axis=0)]
    near = np.round(np.array(sums) / n).astype(np.int64)
    centred = (n * (fit - near) - (np.array(sums) - n * near)) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    assert collections.Counter(r.vec_id for r in got) == collections.Counter({k: min(most, len(values)) for k in x})
    by = {(r.vec_id, r.component): r for r in got}
    signs = {}
    for k, v in x.items():
        away = np.array([n * a - s for a, s in zip(v, sums)], dtype=object)
        for c in range(min(most, len(values))):
            row = by[k, c + 1]
            want = float((away / n).astype(float) @ vectors[:, c] / np.sqrt(values[c]))
            assert row.n == n and row.deviation == int((away * away).sum())
            if abs(want) > 1e-6:
                sign = signs.setdefault(c, np.sign(want * row.whitened))
                assert row.whitened == pytest.approx(sign * want, abs=1e-8)
            assert row.explained == pytest.approx(values[c] / values.sum(), rel=1e-9)
            assert row.identity_error < 1e-9


def test_query_is_brute_force(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    df = queries.op11_whitening(spark, sf_dir)
    assert dict(df.dtypes) == dict(
        vec_id="bigint", component="int", n="bigint", deviation="bigint", whitened="double", explained="double", identity_error="double"
    )
    check(rows, df.collect())


def test_several_tasks_and_levels(spark, monkeypatch):
    monkeypatch.setattr(whitening, "TASK_ROWS", 40)
    monkeypatch.setattr(whitening, "FAN", 3)
    r = np.random.default_rng(6)
    rows = [(k, (r.standard_normal(5) * [1, 2, 3, 4, 5]).tolist()) for k in range(600)]
    rows += [(600 + k, rows[0][1]) for k in range(300)]  # one vector of a third of the rows
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for batch in (1, 64):
        check(rows, whitening.whiten(df, most=3, batch_rows=batch).collect(), 3)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [1.0, 0.5]), (2, [2.0, 0.0]), (2, [2.0, 0.0]), (None, [0.25, -3.0]), (10, [-1.0, 4.0])]
    bad = [(3, None), (4, []), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]), (9, [1.0, 0.0, 0.0]), (11, [1e30, 0.0])]
    df = spark.createDataFrame([(*row, "x", 1, 2) for row in good + bad], "vec_id long, embedding array<double>, x string, n int, component int")
    got = whitening.whiten(df).collect()
    assert collections.Counter(r.vec_id for r in got) == {1: 2, 2: 4, None: 2, 10: 2}
    assert {r.n for r in got} == {4} and len({(r.component, r.whitened) for r in got if r.vec_id == 2}) == 2
    assert max(abs(r.identity_error) for r in got) < 1e-12
    same = df.where("vec_id = 2")
    assert whitening.whiten(same).count() == 0
    assert whitening.whiten(df.limit(0)).count() == 0
    assert whitening.whiten(df.limit(0)).columns == whitening.whiten(df).columns


def test_exact_beyond_64_bits():
    x = np.array([[2**51, -(2**51)], [1, 2]], dtype=np.int64)
    rows, sums = 3_000_000, [7 * 10**20, -5]
    away = whitening._deviations(x, rows, sums)
    assert away.tolist() == [[rows * int(a) - s for a, s in zip(row, sums)] for row in x]
    assert [int(v.as_py()) if v.as_py() is not None else None for v in whitening._squares(away)] == [
        s if (s := sum(int(v) ** 2 for v in row)) < 10**38 else None for row in away
    ]
