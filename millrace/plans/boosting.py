"""Boosted trees for more than two classes: one softmax ensemble, grown over histograms.

Spark ML boosts two classes only. Here every round grows a tree for each class, all of
them level by level at once: each task adds up, for its rows, the gradients and hessians
of the softmax loss by (class, node, feature, bin), the sums are reduced over the tasks,
and the best split of every node follows from them. What reaches the driver is such a
table of sums, whose size depends on classes, depth, features and bins, not on the rows.
Of two children only the lighter one is added up; the other is the rest of its parent.
For that to be exact the gradients and hessians are rounded to a grid so fine that all
rows' sums of them are whole numbers a double holds; so the trees do not depend on how
the rows are dealt to tasks either.

Rows are kept as blocks of small bin numbers, written to the shared folder and cached.
This is the one place of the library that works on blocks imperatively, a task at a time,
and therefore on an RDD. Features are numbered together in groups, mostly in twos: one
number stands for the bins of all of a group, so one pass adds up the group, and the sums
of its features follow from the group's. The scores of the rows so far are carried in the
blocks, brought up to date and cached in every round and checkpointed every ``COMMIT``
rounds. A lost executor's blocks are read, and their latest scores worked out, again.
"""

from __future__ import annotations

import heapq
import math
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from millrace import constants as K
from millrace.session import scratch, shared_dir

# Functions that run in tasks go there by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rows are stored in blocks of the first size at most and worked on in the second.
BLOCK_ROWS, WORK_ROWS = 32_768, 262_144
COMMIT = 10
TASK_BYTES = 128 << 20
# Features are numbered together while their bins combine to so many numbers at most.
JOINT = 4_096
# Sums of so few tasks are added up by the driver.
FEW_PARTS = 16
# Relative error of the quantiles that place the bins, as a share of a bin.
QUANTILE_ERROR = 0.1
# Rows that a task sorts at once for the quantiles.
CHUNK_ROWS = 65_536


@dataclass(frozen=True)
class Settings:
    """Rounds, depth and rate as the defect classifier uses them; the rest regularises.

    A node is split if the gain is positive and both sides have a hessian of
    ``least_hessian`` at least; ``penalty`` is added to the hessian of every leaf.
    """

    rounds: int = K.TREES
    depth: int = K.TREE_DEPTH
    rate: float = K.LEARNING_RATE
    bins: int = 64
    penalty: float = 1.0
    least_hessian: float = 1.0


class Layout:
    """Which features are numbered together. The number of a row in a group is the sum of
    the bins of the group's features, each times the feature's step."""

    def __init__(self, sizes: list[int]):
        self.sizes, self.groups, self.totals = sizes, [], []
        self.group_of, self.step_of = [0] * len(sizes), [1] * len(sizes)
        self._bins: dict[int, np.ndarray] = {}
        for f in sorted(range(len(sizes)), key=lambda f: -sizes[f]):
            g = next((g for g, n in enumerate(self.totals) if n * sizes[f] <= JOINT), len(self.totals))
            if g == len(self.totals):
                self.groups.append([])
                self.totals.append(1)
            self.group_of[f], self.step_of[f] = g, self.totals[g]
            self.groups[g].append(f)
            self.totals[g] *= sizes[f]
        self.kind = np.min_scalar_type(max(self.totals, default=1) - 1)
        self.kind = max(self.kind, np.dtype(np.uint16), key=lambda k: k.itemsize)

    def numbers(self, bins: list[np.ndarray], rows: int) -> np.ndarray:
        """A line for each group, of a number for each row."""
        out = np.zeros((len(self.groups), rows), self.kind)
        for f, own in enumerate(bins):
            out[self.group_of[f]] += (own * self.step_of[f]).astype(self.kind)
        return out

    def bins_of(self, feature: int) -> np.ndarray:
        """The feature's bin by its group's number."""
        if feature not in self._bins:
            size, step = self.sizes[feature], self.step_of[feature]
            once = np.repeat(np.arange(size), step)
            self._bins[feature] = np.tile(once, self.totals[self.group_of[feature]] // len(once))
        return self._bins[feature]


@dataclass
class Block:
    """Some rows: number in each group of the layout, class, and score of each class so
    far; numbers and scores have a line for each group or class."""

    layout: Layout
    numbers: np.ndarray
    classes: np.ndarray
    scores: np.ndarray

    def right(self, feature: int, cut: int, rows: np.ndarray | None) -> np.ndarray:
        """Which of the rows, or of all, have a bin above the cut."""
        own = self.numbers[self.layout.group_of[feature]]
        return (self.layout.bins_of(feature) > cut)[own if rows is None else own[rows]]


@dataclass
class Tree:
    """A complete binary tree in arrays; the children of node k are 2k + 1 and 2k + 2.

    ``feature`` is -1 where a node is not split; a row goes left if its bin is at most
    ``cut``. Every node has a ``value``, so a row may stop anywhere.
    """

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    @classmethod
    def bare(cls, depth: int) -> Tree:
        size = 2 ** (depth + 1) - 1
        return cls(np.full(size, -1, np.int32), np.zeros(size, np.int32), np.zeros(size), np.zeros(size))

    def parts(self, block: Block, wanted: list[int] | None = None) -> Iterator[tuple[int, np.ndarray | None]]:
        """The rows that end in each node or, of the ``wanted`` nodes, come to each; None
        stands for all rows. Nodes without rows are left out."""
        followed = None
        if wanted is not None:
            followed = {(n + 1 >> k) - 1 for n in wanted for k in range((n + 1).bit_length())}
        todo: list[tuple[int, np.ndarray | None]] = [(0, None)]
        while todo:
            node, rows = todo.pop()
            if self.feature[node] < 0 if wanted is None else node in wanted:
                yield node, rows
                continue
            right = block.right(int(self.feature[node]), int(self.cut[node]), rows)
            for child, side in ((2 * node + 1, ~right), (2 * node + 2, right)):
                if followed is None or child in followed:
                    some = np.flatnonzero(side) if rows is None else rows[side]
                    if len(some):
                        todo.append((child, some))


def softmax(scores: np.ndarray, axis: int = 1) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=axis, keepdims=True))
    return e / e.sum(axis=axis, keepdims=True)


def grid(rows: int) -> float:
    """Steps of the grid within 1: sums over so many rows stay below 2**53."""
    return 2.0 ** (52 - int(rows).bit_length())


def sums_by_bin(block: Block, trees: list[Tree], opened: list[tuple[int, int]], bins: int, steps: float) -> np.ndarray:
    """Gradients and hessians by (open node, feature, bin), in steps of the grid; a node
    is (class, number)."""
    layout, whole = block.layout, None
    # A complex number has a gradient and a hessian, so that both are added in one go.
    out = np.zeros((len(opened), len(layout.sizes), bins), complex)
    asked = []
    for c in sorted({c for c, _ in opened}):
        slots = [k for k, (own, _) in enumerate(opened) if own == c]
        place = {opened[k][1]: n for n, k in enumerate(slots)}
        parts = list(trees[c].parts(block, [*place]))
        if not parts:
            continue
        if parts[0][1] is None:
            whole = softmax(block.scores, 0) if whole is None else whole
            rows, slot, p, own = None, None, whole[c], block.classes
        else:
            rows = np.concatenate([some for _, some in parts])
            slot = np.repeat([place[node] for node, _ in parts], [len(some) for _, some in parts])
            p, own = softmax(block.scores[:, rows], 0)[c], block.classes[rows]
        value = np.empty(len(p), complex)
        value.real = np.rint((p - (own == c)) * steps)
        value.imag = np.rint(2 * p * (1 - p) * steps)
        asked.append((rows, slot, value, out[slots[0] : slots[-1] + 1]))
    for g in range(len(layout.groups)):
        every = None
        for rows, slot, value, into in asked:
            if rows is not None:
                number = block.numbers[g][rows].astype(np.intp)
            elif every is None:
                number = every = block.numbers[g].astype(np.intp)
            else:
                number = every
            _add_group(layout, g, number, slot, value, into)
    return out.view(float).reshape(*out.shape, 2)


def _add_group(layout: Layout, group: int, number: np.ndarray, slot: np.ndarray | None, value: np.ndarray, into: np.ndarray) -> None:
    """Adds the values by (slot, feature, bin) for the group's features: by the group's
    numbers first where the rows are many, else by the bins of each feature."""

    def summed(size: int, at: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(into) * size, complex)
        np.add.at(sums, at if slot is None else slot * size + at, value)
        return sums

    total, features = layout.totals[group], layout.groups[group]
    if 2 * len(value) >= len(into) * total or len(features) == 1:
        sums = summed(total, number)
        for f in features:
            step, size = layout.step_of[f], layout.sizes[f]
            into[:, f, :size] += sums.reshape(len(into), -1, size, step).sum(axis=(1, 3))
    else:
        for f in features:
            size = layout.sizes[f]
            into[:, f, :size] += summed(size, layout.bins_of(f)[number]).reshape(len(into), size)


def _scores(block: Block, rounds: list[list[Tree]]) -> np.ndarray:
    scores = block.scores.copy()
    for trees in rounds:
        for c, tree in enumerate(trees):
            for node, rows in tree.parts(block):
                scores[c, slice(None) if rows is None else rows] += tree.value[node]
    return scores


def split(trees: list[Tree], opened: list[tuple[int, int]], sums: np.ndarray, s: Settings) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Cuts the open nodes where that gains most; their children that may be cut in turn,
    and the children to add up for these, both ordered by class."""
    total = sums[:, 0].sum(axis=1)  # every feature sees all rows of a node
    left = sums.cumsum(axis=2)
    right = total[:, None, None] - left
    quality = lambda x: x[..., 0] ** 2 / np.maximum(x[..., 1] + s.penalty, 1e-16)
    gain = quality(left) + quality(right) - quality(total)[:, None, None]
    gain[(left[..., 1] < s.least_hessian) | (right[..., 1] < s.least_hessian)] = -np.inf
    flat = gain.reshape(len(gain), -1)
    best = flat.argmax(axis=1)
    further, lighter = [], []
    for k, (c, at) in enumerate(opened):
        tree = trees[c]
        if at == 0:
            tree.value[0] = -s.rate * total[k, 0] / max(total[k, 1] + s.penalty, 1e-16)
        if not flat[k, best[k]] > 1e-6:
            continue
        feature, cut = divmod(int(best[k]), gain.shape[2])
        tree.feature[at], tree.cut[at], tree.gain[at] = feature, cut, flat[k, best[k]]
        for child, side in ((2 * at + 1, left), (2 * at + 2, right)):
            g, h = side[k, feature, cut]
            tree.value[child] = -s.rate * g / max(h + s.penalty, 1e-16)
            if h >= 2 * s.least_hessian and 2 * child + 2 < len(tree.feature):
                further.append((c, child))
        if further and further[-1][0] == c and (further[-1][1] - 1) // 2 == at:
            lighter.append((c, 2 * at + 1 + int(right[k, feature, cut, 1] < left[k, feature, cut, 1])))
    return further, lighter


def completed(opened: list[tuple[int, int]], found: dict[tuple[int, int], np.ndarray], parents: dict[tuple[int, int], np.ndarray]) -> np.ndarray:
    """Sums of the open nodes: those found, or what they leave of the parent's."""
    other = lambda at: at + 1 if at % 2 else at - 1
    return np.stack([found[c, at] if (c, at) in found else parents[c, (at - 1) // 2] - found[c, other(at)] for c, at in opened])


@dataclass
class Booster:
    """A fitted ensemble: features with the upper ends of their bins, classes, trees."""

    features: list[str]
    edges: list[list[float]]
    classes: list[int]
    rounds: list[list[Tree]] = field(default_factory=list)

    def layout(self) -> Layout:
        return Layout([len(e) + 1 for e in self.edges])

    def numbers(self, rows: pa.RecordBatch, layout: Layout) -> np.ndarray:
        """The rows' numbers in the layout's groups."""
        values = [rows.column(f).to_numpy(zero_copy_only=False) for f in self.features]
        bins = [np.searchsorted(e, v, side="left") for e, v in zip(self.edges, values)]
        return layout.numbers(bins, rows.num_rows)

    def score(self, df: DataFrame) -> DataFrame:
        """``df`` with ``prediction`` and ``probabilities``, one for each class in order.

        Features are cleaned as for training; rows are scored in Arrow batches. The
        columns of ``df`` stay, the two new ones replace others of their names.
        """
        from millrace.plans.training import feature_matrix

        df = df.drop("prediction", "probabilities")
        clean = feature_matrix(df, self.features)
        added = [StructField("prediction", IntegerType()), StructField("probabilities", ArrayType(DoubleType()))]
        shared = df.sparkSession.sparkContext.broadcast((self.features, self.edges, self.classes, self.rounds))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model = Booster(*shared.value)
            layout = model.layout()
            for batch in batches:
                none = np.zeros((len(model.classes), batch.num_rows))
                share = softmax(_scores(Block(layout, model.numbers(batch, layout), none, none), model.rounds).T)
                best = np.array(model.classes, dtype=np.int32)[share.argmax(axis=1)]
                cuts = pa.array(np.arange(len(share) + 1, dtype=np.int32) * share.shape[1])
                lists = pa.ListArray.from_arrays(cuts, pa.array(share.ravel()))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(best), lists], [*batch.schema.names, "prediction", "probabilities"])

        return clean.mapInArrow(run, StructType([*clean.schema.fields, *added]))

    def nodes(self, spark: SparkSession) -> DataFrame:
        """A row for each node in use: what it is cut by, its gain and its value."""
        found = []
        for r, trees in enumerate(self.rounds):
            for c, t in zip(self.classes, trees):
                below = np.flatnonzero(t.feature >= 0)
                for n in sorted({0, *(2 * below + 1).tolist(), *(2 * below + 2).tolist()}):
                    f = int(t.feature[n])
                    cut = (self.features[f], self.edges[f][t.cut[n]]) if f >= 0 else (None, None)
                    found.append((r, c, n, *cut, float(t.gain[n]), float(t.value[n])))
        return spark.createDataFrame(found, "round int, class int, node int, feature string, at_most double, gain double, value double")

    def save(self, spark: SparkSession, path: str) -> None:
        """Two Parquet tables below ``path``: the features with their bins, and the nodes."""
        depth = len(self.rounds[0][0].feature) if self.rounds else 1
        bins = [(k, f, e, self.classes, depth) for k, (f, e) in enumerate(zip(self.features, self.edges))]
        schema = "number int, feature string, edges array<double>, classes array<int>, tree_size int"
        spark.createDataFrame(bins, schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/features")
        self.nodes(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Booster:
        bins = spark.read.parquet(f"{path}/features").orderBy("number").collect()
        model = cls([b.feature for b in bins], [list(b.edges) for b in bins], list(bins[0].classes))
        place = {f: k for k, f in enumerate(model.features)}
        for n in spark.read.parquet(f"{path}/nodes").orderBy("round", "class", "node").collect():
            while len(model.rounds) <= n.round:
                size = bins[0].tree_size
                model.rounds.append([Tree(np.full(size, -1, np.int32), np.zeros(size, np.int32), np.zeros(size), np.zeros(size)) for _ in model.classes])
            tree = model.rounds[n.round][model.classes.index(n["class"])]
            tree.value[n.node], tree.gain[n.node] = n.value, n.gain
            if n.feature is not None:
                tree.feature[n.node] = place[n.feature]
                tree.cut[n.node] = model.edges[place[n.feature]].index(n.at_most)
        return model

    def importance(self, spark: SparkSession) -> DataFrame:
        """Gain of each feature over all trees, the largest first."""
        gains = self.nodes(spark).where("feature is not null").groupBy("feature")
        return gains.agg(F.sum("gain").alias("gain"), F.count("*").alias("splits")).orderBy(F.desc("gain"), "feature")


def bin_edges(df: DataFrame, features: list[str], bins: int) -> list[list[float]]:
    """Upper ends of the bins of each feature but the last, at equal shares of the rows.

    Of each chunk of sorted values every so manieth is kept, with the number of values it
    stands for, so the rank of an end is off by ``QUANTILE_ERROR`` of a bin at most; where
    chunks are short, all values are kept and ends are exact. NaN and nulls don't count.
    """
    points = math.ceil(2 * bins / QUANTILE_ERROR)

    def thinned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def rows() -> Iterator[pa.RecordBatch]:
            for f, name in enumerate(features):
                values = np.concatenate([b.column(name).to_numpy(zero_copy_only=False) for b in held])
                values = np.sort(values[~np.isnan(values)])
                if len(values):
                    step = max(1, len(values) // points)
                    last = np.append(np.arange(step - 1, len(values) - 1, step), len(values) - 1)
                    kept = [values[last], np.diff(last, prepend=-1)]
                    yield pa.RecordBatch.from_arrays([pa.array([f], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in kept)], ["feature", "points", "counts"])

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= CHUNK_ROWS:
                yield from rows()
                held = []
        if held:
            yield from rows()

    def ends(chunks: pa.Table) -> pa.Table:
        points = np.concatenate([np.frombuffer(x, np.float64) for x in chunks.column("points").to_pylist()])
        counts = np.concatenate([np.frombuffer(x, np.int64) for x in chunks.column("counts").to_pylist()])
        order = np.argsort(points, kind="stable")
        upto = np.cumsum(counts[order])
        ranks = [math.ceil(k * int(upto[-1]) / bins) for k in range(1, bins)]
        found = points[order][np.searchsorted(upto, ranks)]
        return pa.table({"feature": chunks.column("feature")[:1], "ends": pa.array([found.tolist()], pa.list_(pa.float64()))})

    chunks = df.select(*features).mapInArrow(thinned, "feature int, points binary, counts binary")
    found = chunks.groupBy("feature").applyInArrow(ends, "feature int, ends array<double>").collect()
    edges = {r.feature: sorted(set(r.ends)) for r in found}
    return [edges.get(f, []) for f in range(len(features))]


def _blocks(df: DataFrame, model: Booster, label: str) -> RDD:
    """The rows as blocks of (numbers, classes, scores), written once and read from the
    shared folder."""
    features, edges, classes = model.features, model.edges, model.classes

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Booster(features, edges, classes)
        layout, held = own.layout(), []

        def block() -> pa.RecordBatch:
            parts = (np.concatenate(x, axis=-1) for x in zip(*held))
            columns = [pa.array([x.tobytes()], pa.binary()) for x in parts]
            rows = pa.array([sum(len(w) for _, w in held)], pa.int32())
            return pa.RecordBatch.from_arrays([pa.array([uuid.uuid4().hex]), rows, *columns], ["name", "rows", "numbers", "classes"])

        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                piece = batch.slice(at, BLOCK_ROWS)
                which = np.searchsorted(classes, piece.column("_class").to_numpy()).astype(np.uint16)
                if held and sum(len(w) for _, w in held) + len(which) > BLOCK_ROWS:
                    yield block()
                    held = []
                held.append((own.numbers(piece, layout), which))
        if held:
            yield block()

    rows = df.select(F.col(label).cast("int").alias("_class"), *features)
    path = scratch(df.sparkSession, "blocks")
    rows.mapInArrow(pack, "name string, rows int, numbers binary, classes binary").write.parquet(path)
    kind, many = model.layout().kind, len(classes)

    def unpack(row) -> tuple[str, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        which = np.frombuffer(row.classes, np.uint16)
        return row.name, (np.frombuffer(row.numbers, kind).reshape(-1, len(which)), which, np.zeros((many, len(which))))

    stored = df.sparkSession.read.parquet(path)
    row_bytes = len(model.layout().groups) * kind.itemsize + 8 * many + 2
    return _dealt(stored.rdd.map(unpack), dict(map(tuple, stored.select("name", "rows").collect())), row_bytes)


def _dealt(named: RDD, rows_of: dict[str, int], row_bytes: int) -> RDD:
    """The named blocks in tasks of about as many rows each, a multiple of the cores."""
    cores = named.context.defaultParallelism
    tasks = cores * max(1, math.ceil(sum(rows_of.values()) * row_bytes / (TASK_BYTES * cores)))
    load, task_of = [(0, t) for t in range(tasks)], {}
    for name in sorted(rows_of, key=lambda n: (-rows_of[n], n)):
        rows, task = heapq.heappop(load)
        task_of[name] = task
        heapq.heappush(load, (rows + rows_of[name], task))

    def merged(part: Iterator[tuple]) -> Iterator[tuple]:
        some, rows = [], 0
        for block in part:
            if some and rows + len(block[1]) > WORK_ROWS:
                yield tuple(np.concatenate(x, axis=-1) for x in zip(*some))
                some, rows = [], 0
            some.append(block)
            rows += len(block[1])
        if some:
            yield tuple(np.concatenate(x, axis=-1) for x in zip(*some))

    return named.partitionBy(tasks, lambda name: task_of[name]).values().mapPartitions(merged)


def _later(blocks: RDD, model: Booster, trees: list[Tree]) -> RDD:
    """The blocks with the trees' values added to their scores, cached."""
    sizes = model.layout().sizes

    def added(part: Iterator[tuple]) -> Iterator[tuple]:
        layout = Layout(sizes)
        for numbers, classes, scores in part:
            yield numbers, classes, _scores(Block(layout, numbers, classes, scores), [trees])

    return blocks.mapPartitions(added).persist(StorageLevel.MEMORY_AND_DISK)


def fit(df: DataFrame, label: str = K.LABEL, features: list[str] | None = None, settings: Settings = Settings()) -> Booster:
    """Boosts trees on the rows of ``df`` that have a label.

    Classes are the distinct labels, ascending; scores start equal. With one class, or no
    rows, no trees are grown.
    """
    from millrace.plans.training import feature_matrix, feature_names

    features = features or feature_names(df)
    rows = feature_matrix(df, features).where(F.col(label).isNotNull())
    spark, s = df.sparkSession, settings
    classes = sorted(r[0] for r in rows.select(F.col(label).cast("int")).distinct().collect())
    model = Booster(list(features), bin_edges(rows, features, s.bins), classes)
    if len(classes) < 2:
        return model
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    sizes = model.layout().sizes
    base, before = _blocks(rows, model, label).persist(StorageLevel.MEMORY_AND_DISK), None
    steps = grid(base.map(lambda b: len(b[1])).sum())
    for number in range(s.rounds):
        trees = [Tree.bare(s.depth) for _ in classes]
        opened = asked = [(c, 0) for c in range(len(classes))]
        parents: dict[tuple[int, int], np.ndarray] = {}
        while opened:
            found = dict(zip(asked, _reduced(base, sizes, trees, asked, steps)))
            if before is not None:  # the blocks of this round are stored now
                before.unpersist()
                before = None
            sums = completed(opened, found, parents)
            parents = dict(zip(opened, sums))
            opened, asked = split(trees, opened, sums / steps, s)
        model.rounds.append(trees)
        if number + 1 < s.rounds:
            before, base = base, _later(base, model, trees)
            if (number + 1) % COMMIT == 0:
                base.checkpoint()
    base.unpersist()
    return model


def _reduced(blocks: RDD, sizes: list[int], trees: list[Tree], opened: list[tuple[int, int]], steps: float) -> np.ndarray:
    """The sums of all blocks. Many tasks' sums are added up on the executors first."""

    def own(part: Iterator[tuple]) -> Iterator[np.ndarray]:
        layout, total = Layout(sizes), None
        for numbers, classes, scores in part:
            sums = sums_by_bin(Block(layout, numbers, classes, scores), trees, opened, max(sizes), steps)
            total = sums if total is None else total + sums
        if total is not None:
            yield total

    found = blocks.mapPartitions(own)
    if blocks.getNumPartitions() <= FEW_PARTS:
        return found.reduce(lambda a, b: a + b)
    return found.treeReduce(lambda a, b: a + b, depth=2)
