"""Hard negatives against a plain search over all rows; its SQL is in ``test_operators``."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import negatives


def plain(rows, every=100, best=5):
    """rows: (id, label, x) as whole numbers."""
    x = np.array([r[2] for r in rows], dtype=np.int64)
    out = []
    for k, (key, label, own) in enumerate(rows):
        if key % every:
            continue
        score = (x @ np.array(own, dtype=np.int64)).tolist()
        order = sorted((j for j in range(len(rows)) if j != k), key=lambda j: (-score[j], rows[j][0]))
        for p in [j for j in order if rows[j][1] == label][:best]:
            fits = [j for j in order if rows[j][1] != label and 80 * score[p] <= 100 * score[j] <= 100 * score[p]]
            out += [(key, rows[p][0], n + 1, rows[j][0], score[p], score[j]) for n, j in enumerate(fits[:best])]
    return sorted(out)


def got(df):
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in df.collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_clusters_copies_and_small_tiles(spark, monkeypatch, seed):
    for name, value in dict(PROBE=60, TILE_ROWS=64, BLOCK_REQUESTS=8, CELL_ROWS=8).items():
        monkeypatch.setattr(negatives, name, value)
    r = np.random.default_rng(seed)
    centres = r.standard_normal((12, 7))
    data = []
    for k in range(900):
        v = centres[r.integers(12)] + 0.3 * r.standard_normal(7)
        data.append((k, int(r.integers(4)), v.tolist()))
    for k in range(900, 1300):  # a third of the rows are one vector
        data.append((k, int(r.integers(4)), data[0][2]))
    data.append((1300, 77, data[5][2]))  # the only row of its label
    data.append((1301, 78, data[6][2]))
    df = spark.createDataFrame(data, "vec_id long, label int, embedding array<double>").repartition(3)
    want = plain([(k, lab, [int(np.floor(256 * c)) for c in v]) for k, lab, v in data], 50)
    assert got(negatives.mine(df, F.col("vec_id") % 50 == 0)) == want and len(want) > 200


def test_cells_fall_and_rounds_share_them(monkeypatch):
    r = np.random.default_rng(3)
    a, b = r.standard_normal(5), r.standard_normal(4)
    cells = list(negatives.falling_cells(a, b))
    assert len({c[1:] for c in cells}) == 20
    assert [c[0] for c in cells] == sorted((x + y for x in a for y in b), reverse=True)
    monkeypatch.setattr(negatives, "PROBE", 10)
    centres = (r.standard_normal((3, 2)), r.standard_normal((3, 2)))
    index = negatives.Index(centres, np.full((3, 3), 4), (np.full((3, 3), 0.1), np.full((3, 3), 0.2)))
    x = r.standard_normal(4)
    first, rest = index.visits(x, None, True), index.visits(x, None, False)
    assert len(first) == 3 and len(rest) == 6 and not set(first) & set(rest)
    assert len(index.visits(x, 0.0, False)) < 6 and index.visits(x, 1e9, False) == []


def test_bounds_hold_for_every_row(spark):
    r = np.random.default_rng(4)
    x = [r.integers(-50, 50, 6).tolist() for _ in range(700)]
    shelved, index = negatives.build(spark.createDataFrame([(k, v) for k, v in enumerate(x)], "r long, x array<int>"))
    for row in shelved.limit(200).collect():
        for a in np.array(x[:20], dtype=float):
            score = float(a @ np.array(row.x))
            assert (row.i, row.j) in set(index.visits(a, score, True)) | set(index.visits(a, score, False))


def test_exact_scores_of_large_numbers():
    a = np.full((1, 40), (1 << 24) - 1, dtype=np.int64)
    assert negatives.scores(a, a)[0, 0] == 40 * ((1 << 24) - 1) ** 2


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    data = [(0, 1, [1.0, 0.0]), (100, 1, [1.0, 0.0]), (100, 2, [0.9, 0.1]), (1, 1, [0.8, 0.0]), (2, 2, [0.8, 0.0]), (3, 2, [0.8, 0.0])]
    bad = [(4, None, [1.0, 0.0]), (5, 1, None), (None, 1, [1.0, 0.0]), (6, 2, [nan, 0.0]), (7, 2, [inf, 0.0]), (8, 2, [None, 0.0]), (9, 2, []), (200, 1, [1.0]), (11, 2, [1e9, 0.0])]
    df = spark.createDataFrame([(*row, "x", 1, True) for row in data + bad], "vec_id long, label int, embedding array<double>, x string, rank int, is_anchor boolean")
    want = plain([(k, lab, [int(np.floor(256 * c)) for c in v]) for k, lab, v in data])
    found = negatives.mine(df, F.col("vec_id") % 100 == 0)
    assert got(found) == want and {w[0] for w in want} == {0, 100}
    for less in (df.limit(0), df.where("vec_id = 1"), df.where("label = 1")):
        assert negatives.mine(less, F.col("vec_id") % 100 == 0).collect() == []
    assert negatives.mine(df.limit(0), F.col("vec_id") % 100 == 0).columns == found.columns
