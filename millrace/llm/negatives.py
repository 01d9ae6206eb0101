"""Hard negatives by an inverted multi-index with certified windows.

The vectors' two halves each get a codebook, fitted on a bounded sample; a row's two
codes are its cell. For an anchor the sum of two half-score bounds, each the score of the
code plus the anchor's length times the radius of the code, is a bound for every row of
a cell. A heap visits cells by falling bounds. A first round scores the rows of the first
cells; the least score of interest that it finds certifies where the second round may
stop: no cell beyond can hold a row that matters. So results are exact, whatever the
codebooks are worth. The rounds run once for positives, once for the windows below them.

Rows of a code are shelved in tiles of bounded size, requests in blocks of bounded size;
a task scores a tile against a block, and keeps the best few of each.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.llm.numbers import matrix, whole_numbers
from millrace.llm.tables import stored

#: x = floor(STEP * component); components of LARGEST / STEP and more don't take part.
STEP, LARGEST = 256, 1 << 24
#: Rows that the codebooks are fitted on, rows of an average cell, codes of a half at most.
SAMPLE, CELL_ROWS, CODES = 20_000, 256, 256
#: Rows that the first round of an anchor scores at least.
PROBE = 2048
#: Rows of a tile and requests of a block.
TILE_ROWS, BLOCK_REQUESTS = 2048, 2048


def codebook(sample: np.ndarray, codes: int) -> np.ndarray:
    """Centres of the sample's rows by some rounds of Lloyd's method."""
    centres = sample[np.linspace(0, len(sample) - 1, codes).astype(np.int64)].copy()
    for _ in range(8):
        nearest = assigned(sample, centres)
        for k in range(codes):
            own = sample[nearest == k]
            if len(own):
                centres[k] = own.mean(axis=0)
    return centres


def assigned(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The nearest centre of each row."""
    return ((centres * centres).sum(axis=1) - 2 * (rows @ centres.T)).argmin(axis=1)


def falling_cells(first: np.ndarray, second: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """(first[i] + second[j], i, j) for all pairs by falling sums, from a heap."""
    one, two = np.argsort(-first, kind="stable").tolist(), np.argsort(-second, kind="stable").tolist()
    f, s = first[one].tolist(), second[two].tolist()
    heap = [(-(f[0] + s[0]), 0, 0)]
    while heap:
        bound, i, j = heapq.heappop(heap)
        yield -bound, one[i], two[j]
        if j + 1 < len(s):
            heapq.heappush(heap, (-(f[i] + s[j + 1]), i, j + 1))
        if j == 0 and i + 1 < len(f):
            heapq.heappush(heap, (-(f[i + 1] + s[0]), i + 1, 0))


def scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers below ``LARGEST``."""
    most = int(np.abs(anchors).max(initial=0)) * int(np.abs(rows).max(initial=0)) * anchors.shape[1]
    if most < 1 << 53:
        return (anchors.astype(np.float64) @ rows.astype(np.float64).T).astype(np.int64)
    return anchors.astype(np.int64) @ rows.astype(np.int64).T


@dataclass
class Index:
    """Codebooks, and for each cell (code of either half) its rows and two radii."""

    centres: tuple[np.ndarray, np.ndarray]
    rows: np.ndarray
    radii: tuple[np.ndarray, np.ndarray]

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = self.centres[0].shape[1]
        return x[..., :cut], x[..., cut:]

    def tiles(self, code: int) -> int:
        return max(1, math.ceil(int(self.rows[code].sum()) / TILE_ROWS))

    def visits(self, x: np.ndarray, certain: float | None, first: bool) -> list[tuple[int, int]]:
        """Cells of an anchor's round: the first ones with ``PROBE`` rows, or all later
        ones that may hold a score of ``certain`` (None: any score)."""
        sums, reach = [], []
        for half, centres, radii in zip(self.halves(x), self.centres, self.radii):
            length = math.sqrt(float(half @ half))
            near = centres @ half
            # Rounding of the bound must not hide a row.
            near = near + 1e-9 * (np.abs(near) + length * (np.abs(centres).max(initial=0) + radii.max(initial=0))) + 1e-6
            sums.append(near)
            reach.append(length)
        widest = [self.radii[0].max(axis=1), self.radii[1].max(axis=0)]
        out, seen = [], 0
        for bound, i, j in falling_cells(sums[0] + reach[0] * widest[0], sums[1] + reach[1] * widest[1]):
            rows = int(self.rows[i, j])
            if seen < PROBE:
                seen += rows
                if first and rows:
                    out.append((i, j))
                continue
            if first or certain is not None and bound < certain:
                break
            own = sums[0][i] + reach[0] * self.radii[0][i, j] + sums[1][j] + reach[1] * self.radii[1][i, j]
            if rows and (certain is None or own >= certain):
                out.append((i, j))
        return out


def build(rows: DataFrame) -> tuple[DataFrame, Index] | None:
    """``rows`` (with ``x``, an array of int) shelved by code, and the index."""
    sample = rows.select("x").orderBy(F.xxhash64("x", "r")).limit(SAMPLE).toArrow().column("x").combine_chunks()
    if not len(sample):
        return None
    sample = matrix(sample).astype(np.float64)
    codes = min(CODES, len(sample), max(1, round(math.sqrt(rows.count() / CELL_ROWS))))
    cut = sample.shape[1] // 2
    centres = (codebook(sample[:, :cut], codes), codebook(sample[:, cut:], codes))
    shared = rows.sparkSession.sparkContext.broadcast(centres)
    kinds = dict(rows.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                piece = batch.slice(at, 4096)
                x = matrix(piece.column("x")).astype(np.float64)
                more = []
                for half, c in zip((x[:, :cut], x[:, cut:]), shared.value):
                    code = assigned(half, c)
                    away = half - c[code]
                    more += [pa.array(code.astype(np.int32)), pa.array(np.sqrt((away * away).sum(axis=1)))]
                yield pa.RecordBatch.from_arrays([*piece.columns, *more], [*piece.schema.names, "i", "radius_i", "j", "radius_j"])

    schema = ", ".join(f"{n} {k}" for n, k in kinds.items()) + ", i int, radius_i double, j int, radius_j double"
    shelved = stored(rows.mapInArrow(run, schema))
    cells = shelved.groupBy("i", "j").agg(F.count("*").alias("n"), F.max("radius_i").alias("a"), F.max("radius_j").alias("b"))
    n, a, b = (np.zeros((codes, codes)) for _ in range(3))
    for c in cells.collect():  # at most CODES squared
        n[c.i, c.j], a[c.i, c.j], b[c.i, c.j] = c.n, c.a * (1 + 1e-9), c.b * (1 + 1e-9)
    return shelved.drop("radius_i", "radius_j"), Index(centres, n.astype(np.int64), (a, b))


def _requests(anchors: DataFrame, index: Index, first: bool, blocks: int) -> DataFrame:
    """For each anchor and tile of a code with cells to visit: those cells."""
    shared = anchors.sparkSession.sparkContext.broadcast((index.centres, index.rows, index.radii))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Index(*shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                piece = batch.slice(at, 64)
                x, certain = matrix(piece.column("x")).astype(np.float64), piece.column("certain").to_pylist()
                which, code, tile, cells = [], [], [], []
                for k in range(len(x)):
                    by: dict[int, list[int]] = {}
                    for i, j in own.visits(x[k], certain[k], first):
                        by.setdefault(i, []).append(j)
                    for i, js in by.items():
                        for t in range(own.tiles(i)):
                            which.append(k)
                            code.append(i)
                            tile.append(t)
                            cells.append(js)
                taken = piece.take(pa.array(which, pa.int64())).drop_columns(["certain"])
                yield pa.RecordBatch.from_arrays(
                    [*taken.columns, pa.array(code, pa.int32()), pa.array(tile, pa.int32()), pa.array(cells, pa.list_(pa.int32()))],
                    [*taken.schema.names, "i", "tile", "cells"],
                )

    kinds = {n: k for n, k in anchors.dtypes if n != "certain"}
    schema = ", ".join(f"{n} {k}" for n, k in kinds.items()) + ", i int, tile int, cells array<int>"
    return anchors.mapInArrow(run, schema).withColumn("block", F.expr(f"cast(pmod(xxhash64(r), {blocks}) as int)"))


def _score(best: int):
    """Scores a tile's rows for a block's requests; see ``_round``."""

    def run(rows: pa.Table, requests: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, ...]] = []
        if rows.num_rows and requests.num_rows:
            rows = rows.combine_chunks().sort_by([("key", "ascending"), ("r", "ascending")])
            x, key, label = matrix(rows.column("x").combine_chunks()), rows.column("key").to_numpy(), rows.column("label").to_numpy()
            r, cell = rows.column("r").to_numpy(), rows.column("j").to_numpy()
            codes = int(cell.max()) + 1
            for at in range(0, requests.num_rows, 128):
                part = requests.slice(at, 128)
                wanted = np.zeros((part.num_rows, codes), bool)
                for k, js in enumerate(part.column("cells").to_pylist()):
                    wanted[k, [j for j in js if j < codes]] = True
                use = np.flatnonzero(wanted.any(axis=0)[cell])
                if not len(use):
                    continue
                found = scores(matrix(part.column("x").combine_chunks()), x[use])
                seen = wanted[:, cell[use]]
                own, labels = part.column("r").to_numpy(), part.column("label").to_numpy()
                same = labels[:, None] == label[use][None, :]
                tops = part.column("tops").to_pylist()
                slots = max(len(t) for t in tops) if tops[0] is not None else 0
                if not slots:
                    fits = seen & same & (own[:, None] != r[use][None, :])
                    out += _best(found, fits, best, own, 0, key[use], r[use])
                for slot in range(slots):
                    top = np.array([t[slot] if slot < len(t) else np.iinfo(np.int64).min for t in tops], dtype=np.int64)
                    low = np.array([t[slot] if slot < len(t) else 0 for t in part.column("lows").to_pylist()], dtype=np.int64)
                    fits = seen & ~same & (found <= top[:, None]) & (found >= low[:, None])
                    out += _best(found, fits, best, own, slot + 1, key[use], r[use])
        names = ["anchor", "slot", "r", "key", "score"]
        if not out:
            return pa.table({n: pa.array([], pa.int64()) for n in names})
        return pa.table({n: pa.array(np.concatenate(c)) for n, c in zip(names, zip(*out))})

    return run


def _best(found: np.ndarray, fits: np.ndarray, best: int, own: np.ndarray, slot: int, key: np.ndarray, r: np.ndarray):
    """The ``best`` fitting columns of each row, ties by place (keys ascend)."""
    if not fits.any():
        return []
    value = np.where(fits, found, np.iinfo(np.int64).min)
    if value.shape[1] > best:
        least = np.partition(value, value.shape[1] - best, axis=1)[:, value.shape[1] - best]
        fits = fits & (value >= least[:, None])
    a, c = np.nonzero(fits)
    order = np.lexsort((c, -found[a, c], a))
    a, c = a[order], c[order]
    place = np.arange(len(a)) - np.searchsorted(a, a)
    a, c = a[place < best], c[place < best]
    return [(own[a], np.full(len(a), slot, np.int64), r[c], key[c], found[a, c])]


def _top(found: DataFrame, best: int) -> DataFrame:
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), F.asc("key"), F.asc("r"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)


def _round(shelved: DataFrame, anchors: DataFrame, index: Index, first: bool, best: int, blocks: int) -> DataFrame:
    """``anchor, slot, r, key, score, rank``: the best rows of the cells visited.

    Without ``tops`` the slot is 0 and rows of the anchor's label count; else the slots
    are the windows (``lows``, ``tops``), counted from 1, and rows of other labels count.
    """
    asked = _requests(anchors, index, first, blocks)
    tiles = F.create_map(*(F.lit(v) for i in range(len(index.rows)) for v in (i, index.tiles(i))))
    rows = shelved.withColumn("tile", F.expr("xxhash64(r, 11)")).withColumn("tile", F.pmod("tile", tiles[F.col("i")]).cast("int"))
    rows = rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    keys = ["i", "tile", "block"]
    found = rows.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(_score(best), "anchor long, slot long, r long, key long, score long")
    return stored(_top(found, best))


def _windows(anchors: DataFrame, shelved: DataFrame, index: Index, best: int, blocks: int) -> DataFrame:
    """The best rows of every slot, exact: a first round, then all cells that may matter."""
    first = _round(shelved, anchors.withColumn("certain", F.lit(None).cast("double")), index, True, best, blocks)
    full = first.where(F.col("rank") == best).select(F.col("anchor").alias("r"), "slot", "score")
    if "lows" in anchors.columns:
        slots = anchors.select("r", F.posexplode("lows").alias("at", "low")).withColumn("slot", (F.col("at") + 1).cast("long"))
        least = slots.join(full, ["r", "slot"], "left").groupBy("r").agg(F.min(F.coalesce("score", "low")).cast("double").alias("certain"))
    else:
        least = full.select("r", F.col("score").cast("double").alias("certain"))
    later = _round(shelved, anchors.join(least, "r", "left"), index, False, best, blocks)
    return _top(first.drop("rank").unionByName(later.drop("rank")), best)


def mine(
    vectors: DataFrame,
    anchor: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str | Column = "label",
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Scores are inner products of ``floor(256 * component)``, higher ones first, ties by
    smaller key. A row for which ``anchor`` holds has as positives its best rows of the
    same label, itself excluded; for each of them the best rows of another label with
    ``low * positive_score <= 100 * negative_score <= 100 * positive_score`` follow.
    Rows with a null key or label, a vector that is null, empty, holds null or non-finite
    components or some of 65,536 and more, or that has another length than most, take no
    part. A row that repeats a key is a row of its own, as candidate and as anchor.
    Anchors without positives, and positives without such negatives, give no rows. Other
    columns are ignored, whatever their names; ``anchor`` and ``label`` may use any.
    """
    base = vectors.select(
        F.col(key).cast("long").alias("key"),
        F.col(vector).cast("array<double>").alias("v"),
        (F.col(label) if isinstance(label, str) else label).cast("long").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("is_anchor"),
    ).where("key is not null and label is not null")
    base = whole_numbers(base, "v", STEP, 0, LARGEST)
    rows = stored(
        base.select(F.monotonically_increasing_id().alias("r"), "key", "label", "is_anchor", F.col("x").cast("array<int>").alias("x"))
    )
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    built = build(rows)
    if built is None:
        return vectors.sparkSession.createDataFrame([], schema)
    shelved, index = built
    anchors = stored(rows.where("is_anchor").select("r", "key", "label", "x"))
    blocks = max(1, math.ceil(anchors.count() / BLOCK_REQUESTS))
    candidates = shelved.select("r", "key", "label", "x", "i", "j")
    asking = anchors.withColumn("tops", F.lit(None).cast("array<long>"))
    good = stored(_windows(asking, candidates, index, positives, blocks))
    own = good.groupBy(F.col("anchor").alias("r")).agg(F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("p"))
    tops = F.transform("p", lambda p: p["score"])
    lows = F.expr(f"transform(tops, s -> if(s > 0, s * {low} + 99, s * {low}) div 100)")  # rounded up
    asking = anchors.join(own, "r").withColumn("tops", tops).withColumn("lows", lows).drop("p")
    hard = _windows(stored(asking), candidates, index, negatives, blocks)
    good = good.select("anchor", F.col("rank").cast("long").alias("slot"), F.col("key").alias("positive_id"), F.col("score").alias("positive_score"))
    hard = hard.select("anchor", "slot", "rank", F.col("key").alias("negative_id"), F.col("score").alias("negative_score"))
    found = hard.join(good, ["anchor", "slot"]).join(anchors.select(F.col("r").alias("anchor"), F.col("key").alias("anchor_id")), "anchor")
    return found.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
