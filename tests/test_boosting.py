"""The softmax ensemble against a plain one that looks at every cut of every feature."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace import constants as K
from millrace.plans import boosting, training
from millrace.plans.boosting import Settings


def plain(x, y, classes, s):
    """Scores of the training rows after all rounds, by recursion over single rows."""
    scores = [[0.0] * classes for _ in x]

    def grow(rows, g, h, depth, out):
        total_g, total_h = sum(g[r] for r in rows), sum(h[r] for r in rows)
        best = None
        if depth < s.depth:
            for f in range(len(x[0])):
                for cut in sorted({x[r][f] for r in rows})[:-1]:
                    left = [r for r in rows if x[r][f] <= cut]
                    lg, lh = sum(g[r] for r in left), sum(h[r] for r in left)
                    rg, rh = total_g - lg, total_h - lh
                    if min(lh, rh) < s.least_hessian:
                        continue
                    gain = lg**2 / (lh + s.penalty) + rg**2 / (rh + s.penalty) - total_g**2 / (total_h + s.penalty)
                    if gain > 1e-6 and (best is None or gain > best[0] + 1e-9):
                        best = (gain, f, cut)
        if best is None:
            for r in rows:
                out[r] = -s.rate * total_g / (total_h + s.penalty)
            return
        _, f, cut = best
        grow([r for r in rows if x[r][f] <= cut], g, h, depth + 1, out)
        grow([r for r in rows if x[r][f] > cut], g, h, depth + 1, out)

    for _ in range(s.rounds):
        shares = []
        for row in scores:
            e = [math.exp(v - max(row)) for v in row]
            shares.append([v / sum(e) for v in e])
        added = []
        for c in range(classes):
            g = [p[c] - (y[r] == c) for r, p in enumerate(shares)]
            h = [2 * p[c] * (1 - p[c]) for p in shares]
            out = [0.0] * len(x)
            grow(list(range(len(x))), g, h, 0, out)
            added.append(out)
        scores = [[v + added[c][r] for c, v in enumerate(row)] for r, row in enumerate(scores)]
    return scores


@pytest.fixture(scope="module")
def data():
    r = np.random.default_rng(1)
    x = np.stack([r.integers(0, 9, 240), r.integers(0, 7, 240), r.integers(0, 3, 240)], axis=1).astype(float)
    y = ((x[:, 0] > 4).astype(int) + (x[:, 1] > 3) * (x[:, 2] > 0)).astype(int)
    y[::17] = 3
    return x, y


def frame(spark, data):
    x, y = data
    rows = [(k, int(c), *map(float, v)) for k, (c, v) in enumerate(zip(y, x))]
    return spark.createDataFrame(rows, f"event_id long, {K.LABEL} int, a double, b double, c double").repartition(5)


def test_equals_a_plain_ensemble(spark, data):
    s = Settings(rounds=7, depth=3, rate=0.3, bins=32)
    df = frame(spark, data)
    model = boosting.fit(df, K.LABEL, ["a", "b", "c"], s)
    want = {k: boosting.softmax(np.array([v]))[0] for k, v in enumerate(plain(data[0].tolist(), data[1].tolist(), 4, s))}
    got = training.score(model, df).collect()
    assert len(got) == 240 and len(model.rounds) == 7
    for r in got:
        assert r.probabilities == pytest.approx(want[r.event_id], abs=1e-9)
        assert r.prediction == int(np.argmax(r.probabilities))


def test_stored_and_read_again(spark, data, tmp_path):
    df = frame(spark, data)
    model = training.train(df, "softmax", ["a", "b", "c"], Settings(rounds=3, depth=2))
    training.save(model, str(tmp_path / "m"))
    again = boosting.Booster.load(spark, str(tmp_path / "m"))
    key = lambda r: r.event_id
    assert sorted(training.score(again, df).collect(), key=key) == sorted(training.score(model, df).collect(), key=key)
    gains = model.importance(spark).collect()
    assert {g.feature for g in gains} <= {"a", "b", "c"} and [g.gain for g in gains] == sorted((g.gain for g in gains), reverse=True)
    report = {r.class_name: r.f1 for r in training.report(model, df).collect()}
    assert report["accuracy"] > 0.7


def test_odd_tables(spark, data):
    df = frame(spark, data)
    one = boosting.fit(df.where(f"{K.LABEL} = 1"), K.LABEL, ["a"])
    assert one.rounds == [] and {tuple(r.probabilities) for r in one.score(df).collect()} == {(1.0,)}
    gaps = df.withColumn("a", F.when(F.col("event_id") % 3 == 0, None).otherwise(F.col("a"))).withColumn("prediction", F.lit("mine"))
    gaps = gaps.withColumn(K.LABEL, F.when(F.col("event_id") % 50 != 0, F.col(K.LABEL)))
    model = boosting.fit(gaps, K.LABEL, ["a", "c"], Settings(rounds=1, depth=2))
    scored = model.score(gaps)
    assert scored.count() == 240 and dict(scored.dtypes)["prediction"] == "int"
    assert boosting.fit(df.limit(0), K.LABEL, ["a"]).rounds == []


def test_defaults():
    assert (Settings().rounds, Settings().depth, Settings().rate) == (K.TREES, K.TREE_DEPTH, K.LEARNING_RATE)


def test_adds_up_one_child_of_two(spark, data, monkeypatch):
    """The other child is what that leaves of the parent, to the last digit, and the
    trees don't depend on how the rows are dealt."""
    s, asked, reduced = Settings(rounds=2, depth=4), [], boosting._reduced

    def spied(blocks, since, trees, opened, *rest):
        asked.append(list(opened))
        return reduced(blocks, since, trees, opened, *rest)

    monkeypatch.setattr(boosting, "_reduced", spied)
    df = frame(spark, data)
    model = boosting.fit(df, K.LABEL, ["a", "b", "c"], s)
    for nodes in asked:
        parents = [(c, (at - 1) // 2) for c, at in nodes]
        assert len(parents) == len(set(parents)) or all(at == 0 for _, at in nodes)
    assert len(max(asked, key=len)) > 4
    again = boosting.fit(df.repartition(2), K.LABEL, ["a", "b", "c"], s)
    assert model.edges == again.edges
    for mine, other in zip(sum(model.rounds, []), sum(again.rounds, [])):
        assert mine.value.tolist() == other.value.tolist() and mine.cut.tolist() == other.cut.tolist()


def test_sums_of_groups_of_features():
    """Features numbered together give the sums of each feature alone, with many rows (by
    the group's numbers) and few (by the features' bins)."""
    r = np.random.default_rng(3)
    sizes = [64, 2, 40, 64, 2, 5000, 1, 10]
    layout = boosting.Layout(sizes)
    assert sorted(sum(layout.groups, [])) == list(range(8)) and len(layout.groups) == 3
    tree = boosting.Tree.bare(2)
    tree.feature[:2], tree.cut[:2] = (0, 2), (9, 30)
    for rows in (200, 20_000):
        bins = [r.integers(0, n, rows) for n in sizes]
        block = boosting.Block(layout, layout.numbers(bins, rows), r.integers(0, 2, rows), r.normal(size=(2, rows)))
        at = np.where(bins[0] > 9, 2, np.where(bins[2] > 30, 4, 3))
        opened, steps = [(0, 0), (1, 3), (1, 2)], boosting.grid(rows)
        got = boosting.sums_by_bin(block, [boosting.Tree.bare(2), tree], opened, 5000, steps)
        share = boosting.softmax(block.scores.T)
        for k, (c, node) in enumerate(opened):
            own = np.ones(rows, bool) if node == 0 else at == node
            p = share[own, c]
            for v, value in enumerate((p - (block.classes[own] == c), 2 * p * (1 - p))):
                for f in range(8):
                    want = np.bincount(bins[f][own], np.rint(value * steps), minlength=5000)
                    assert got[k, f, :, v].tolist() == want.tolist()
        scores = boosting._scores(block, [[tree, boosting.Tree.bare(2)]])
        assert scores.tolist() == (block.scores + np.stack([tree.value[at], np.zeros(rows)])).tolist()


def test_ends_of_bins_are_near_their_ranks(spark, monkeypatch):
    """Over many chunks as well; NaN doesn't count, and few values are cut exactly."""
    monkeypatch.setattr(boosting, "CHUNK_ROWS", 3_000)
    df = spark.range(40_000, numPartitions=3).selectExpr(
        "CAST(id * 7919 % 40000 AS double) AS a", "CAST(id % 3 AS double) AS b",
        "CASE WHEN id % 4 = 0 THEN CAST('NaN' AS double) ELSE 1D END AS c", "CAST('NaN' AS double) AS d",
    )
    a, b, c, d = boosting.bin_edges(df, ["a", "b", "c", "d"], 8)
    assert (b, c, d) == ([0.0, 1.0, 2.0], [1.0], [])
    for k, end in enumerate(a, 1):
        assert abs(end + 1 - 40_000 * k / 8) <= 40_000 / 8 * boosting.QUANTILE_ERROR
    assert boosting.bin_edges(spark.range(16).selectExpr("CAST(id * 7919 % 40000 AS double) AS a"), ["a"], 4) == [sorted(float(k * 7919 % 40000) for k in range(16))[3:15:4]]


def test_blocks_are_dealt_evenly(spark):
    """However the rows lie in the stored files, every task has about as many."""
    sizes = [900, 10, 10, 10, 500, 400, 10, 450, 460]
    named = [(f"b{k}", (np.full((2, n), n, np.uint16), np.full(n, k, np.uint16), np.zeros((3, n)))) for k, n in enumerate(sizes)]
    rdd = boosting._dealt(spark.sparkContext.parallelize(named, 2), {name: len(b[1]) for name, b in named}, 30)
    cores = spark.sparkContext.defaultParallelism
    tasks = rdd.glom().map(lambda part: [(n.shape, sorted(set(c.tolist())), s.shape) for n, c, s in part]).collect()
    assert len(tasks) == cores and all(len(t) <= 1 for t in tasks)  # small blocks are put together
    assert sorted(k for t in tasks for _, own, _ in t for k in own) == list(range(9))
    most = max(shape[1] for t in tasks for shape, *_ in t)
    assert most <= max(900, sum(sizes) / cores + 500)
