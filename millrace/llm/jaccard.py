"""Groups of documents whose word shingles overlap, found without comparing all pairs.

Two sets of similarity ``t`` and more differ in few shingles, a bounded share of the
smaller set. The universe of shingles is dealt by hash into more segments than that, a
number fixed for each band of sizes; so some segment must hold the same shingles in
both. A set is indexed by the content of its segments. How many segments a band gets,
and whether each also needs the contents with one shingle left out, is decided by what
it costs over all sets of the band. Pairs that meet in a segment are checked exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from millrace.llm import words
from millrace.llm.graph import components
from millrace.llm.tables import arrow_rows, stored

#: Least hash values kept for each set, and the probability at most with which a pair
#: just at the threshold shares too few of them for its sets to be indexed; see ``suspects``.
MINIMA, MISS = 32, 1e-11
#: Stands for a set of which no segment is passed over.
EVERY = -(1 << 40)
#: Shingles of the sets that one task checks against those of another such block.
BLOCK_BYTES = 4 << 20
#: Texts or sets that a task hands to Python at a time, and bytes of text hashed at once.
BATCH_ROWS, PIECE_BYTES = 1_000, 500_000
#: Segments of a band, as multiples of the fewest that can do.
FACTORS = (1.0, 1.15, 1.3, 1.6, 2.2, 4.0, 16.0)


def group(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = 75, miss: float = MISS) -> DataFrame:
    """``key, n_shingles, component_id`` for every row.

    A set holds a text's distinct shingles of ``width`` words, A-Z as a-z; a shorter
    text's whole sequence is its one shingle; a null text or one without words has an
    empty set and is linked with nothing. Sets link if at least ``percent`` of their
    union is shared. The component is the smallest key that links reach. A row with a
    null key is linked with nothing and its component is null. Rows that repeat a key
    are one document with several texts, whose links are joined. Other columns are
    ignored, whatever their names. ``percent`` is a whole number from 51 to 100: at less
    a pair may differ in as many shingles as the smaller set has, and need not agree in
    any segment. ``miss`` is the probability with which a pair just at the threshold may
    be passed over before the index is made (see ``suspects``); at 0 every set is
    indexed and the result is exact whatever the hashes of the least values are.

    Tables of keys are stored before they are joined. Spark then knows their bytes and
    broadcasts only those below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    # All that runs in Python is stored here; the result reads these tables.
    with arrow_rows(docs.sparkSession, BATCH_ROWS):
        return _grouped(docs, key, text, width, percent, miss)


def _grouped(docs: DataFrame, key: str, text: str, width: int, percent: int, miss: float) -> DataFrame:
    if percent != int(percent) or not 50 < percent <= 100:
        raise ValueError(f"percent must be a whole number from 51 to 100, not {percent}")
    base = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    read = stored(base.mapInArrow(_profile(width), "id long, n long, f1 long, f2 long, minima array<long>"))
    keyed = read.where("id is not null and n > 0")
    # Equal sets are one: all but the smallest key hang on it and go no further.
    first = keyed.groupBy("n", "f1", "f2").agg(F.min("id").alias("first"))
    tied = keyed.join(first, ["n", "f1", "f2"])
    same = tied.where("id > first").select(F.col("id").alias("a"), F.col("first").alias("b"))
    own = tied.where("id = first").select("id", "minima")
    some = stored(suspects(own, percent, miss))
    sets = stored(base.join(some, "id").mapInArrow(_sets(width), "id long, n long, shingles binary"))
    links = similar(shared_enough(sets, percent), percent)
    found = components(same.unionByName(links)).withColumnRenamed("node", "id")
    return read.join(found, "id", "left").select(
        F.col("id").alias(key),
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "id").alias("component_id"),
    )


def least_shared(percent: int, miss: float = MISS) -> int:
    """How many of its least values a set with a partner has in common with others.

    The most that a pair of similarity ``percent`` falls short of with a probability of
    ``miss`` at most: 6 at 75 percent (3e-12), 0 below 55 or if nothing may be missed,
    where nothing is left out.
    """
    p = percent / 100
    below, k = 0.0, 0
    while k < MINIMA:
        below += comb(MINIMA, k) * p**k * (1 - p) ** (MINIMA - k)
        if below > miss:
            break
        k += 1
    return k


def suspects(sets: DataFrame, percent: int, miss: float = MISS) -> DataFrame:
    """Keys of sets that can have a partner, from ``id, minima``.

    The least values of two sets under one random order agree with a probability equal
    to their similarity, and each agreement is a value that two sets have. So a set of
    which fewer than ``least_shared`` values occur elsewhere has no partner.
    """
    least = least_shared(percent, miss)
    if not least:
        return sets.select("id").distinct()
    each = sets.select("id", F.explode("minima").alias("v"))
    shared = each.groupBy("v").agg(F.count("*").alias("many")).where("many > 1").select("v")
    return each.join(shared, "v").groupBy("id").count().where(F.col("count") >= least).select("id")


def shared_enough(sets: DataFrame, percent: int) -> DataFrame:
    """``sets`` with ``u``, the shingles that no other of them has, without those for
    which they are too many for any partner: these are outside every intersection."""
    each = sets.mapInArrow(_each, "h long, id long")
    alone = each.groupBy("h").agg(F.count("*").alias("many"), F.min("id").alias("id")).where("many = 1")
    # A key with several texts has several sets, which the count doesn't tell apart.
    several = sets.groupBy("id").agg(F.count("*").alias("rows")).where("rows > 1").select("id")
    alone = stored(alone.groupBy("id").agg(F.count("*").alias("u")).join(several, "id", "left_anti"))
    counted = sets.join(alone, "id", "left").withColumn("u", F.coalesce("u", F.lit(0)))
    return stored(counted.where(f"(n - u) * 100 >= n * {int(percent)}"))


def similar(sets: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` of ``sets`` (``id, n, u, shingles``) that suffice to connect all
    sets which links connect.

    In two turns each set is checked against one likely partner: of the sets that stand
    for its segments the one it meets most. This joins large groups without looking at
    all their pairs. Then all pairs are checked which meet in a segment and are still
    not connected. A set must be met in a fixed number of segments, so the ones that
    most other sets share are passed over.
    """
    plan, lacking = allocation(sets, percent)
    blocks = _blocks(sets)
    least = f"n * {100 - int(percent)} div {int(percent)} + 1"
    index = sets.mapInArrow(_signatures(plan, percent), "sig long, id long, n long, own boolean, spare long")
    often = index.groupBy("sig").agg(F.count("*").alias("many"), F.min("id").alias("c"), F.min_by("n", "id").alias("cn"))
    index = stored(index.join(often.where("many > 1"), "sig"))
    # First turn: the smallest key stands for a segment.
    links = stored(verified(_likely(index.where("id != c"), percent), sets, percent, blocks))
    if lacking:
        links = stored(links.unionByName(overlapping(sets.mapInArrow(_lacking(plan, percent), "id long, n long, shingles binary"), sets, percent)))
    parts = components(links)
    placed = _placed(_placed(index, parts, "id", "component"), parts, "c", "other")
    mixed = stored(placed.where("component != other").select("sig").distinct())
    placed = stored(placed.join(mixed, "sig").drop("c", "cn", "other"))
    # Second turn: of the sets in a segment the one with the fewest segments of its own.
    single = index.where("own").groupBy("id").agg((F.max(F.expr(f"spare + {least}")) - F.count("*")).alias("alone"))
    placed_by = placed.join(stored(single), "id", "left")
    order = F.coalesce("alone", F.col("n"))
    centre = placed_by.groupBy("sig").agg(*[F.min_by(c, order).alias(t) for c, t in (("id", "c"), ("n", "cn"), ("component", "other"))])
    again = placed.join(centre, "sig").where("component != other")
    links = links.unionByName(stored(verified(_likely(again, percent), sets, percent, blocks)))
    parts = components(links)
    placed = _placed(placed.drop("component"), parts, "id", "component")
    mixed = placed.groupBy("sig").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo != hi")
    placed = placed.join(mixed.select("sig"), "sig")
    placed = placed.join(stored(sets.select("id", "u")), "id")
    by_set = Window.partitionBy("id", "own")
    placed = stored(
        placed.withColumn("rank", F.row_number().over(by_set.orderBy("many", "sig")))
        .withColumn("meets", F.count("*").over(by_set) - F.col("spare"))
        .select("sig", "id", "n", "u", "own", "component", "rank", "meets")
    )
    # The smaller of a pair shares at least this part of itself.
    asks = f"own and rank <= meets and (n - u) * {100 + int(percent)} >= n * {2 * int(percent)}"
    small = placed.where(asks).select("sig", "rank", *[F.col(c).alias(f"a_{c}") for c in ("id", "n", "u", "component", "meets")])
    # What is asked is a component, however many of its sets lie in the segment. The
    # most and the least of its sets' numbers say if one of them can be similar.
    large = placed.groupBy("sig", F.col("component").alias("b")).agg(
        F.min("n").alias("b_least"), F.max("n").alias("b_most"), F.max(F.expr("n - u")).alias("b_shared"), F.max("meets").alias("b_meets"), F.max("id").alias("b_id")
    )
    # The sizes of a pair say in how many segments it can differ; it must be met in one
    # of the others. Of two sets of a size the one that must be met in fewer asks.
    differ = f"(a_n + b_most) * {100 - int(percent)} div {100 + int(percent)}"
    asked = (
        small.join(large, "sig")
        .where("a_component != b and (a_n < b_most or (a_n = b_most and (a_meets < b_meets or (a_meets = b_meets and a_id < b_id))))")
        .where(f"a_n * 100 >= b_least * {int(percent)}")
        .where(f"least(a_n - a_u, b_shared) * {100 + int(percent)} >= (a_n + greatest(a_n, b_least)) * {int(percent)}")
        .where(f"rank <= a_meets - a_n * {100 - int(percent)} div {int(percent)} + {differ}")
        .select(F.col("a_id").alias("a"), F.col("b").alias("part"))
        .distinct()
    )
    members = _placed(sets.select("id"), parts, "id", "part")
    return links.unionByName(reached(stored(asked), members, sets, percent, blocks))


def reached(asked: DataFrame, members: DataFrame, sets: DataFrame, percent: int, blocks: int) -> DataFrame:
    """A pair ``a, b`` for every set ``a`` and component ``part`` of ``asked`` that a
    link connects; ``members`` says which sets (``id``) a component has.

    Sets are dealt into blocks of bounded size. A tile holds the sets of one block that
    ask and those of another that are asked; each is sent there once.
    """
    block = lambda c: F.pmod(F.xxhash64(F.lit(41), c), F.lit(blocks))
    asked = asked.withColumn("x", block("a"))
    members = members.join(asked.select("part").distinct(), "part").withColumn("y", block("id"))
    pairs = asked.join(members.select("part", "y").distinct(), "part")
    there = members.join(asked.select("part", "x").distinct(), "part").select("x", "y", "id", "part")
    here = pairs.select("x", "y", F.col("a").alias("id"), F.lit(None).cast("long").alias("part")).distinct()
    held = there.unionByName(here).withColumnsRenamed({"x": "hx", "y": "hy"}).join(sets.select("id", "shingles"), "id")
    return pairs.groupBy("x", "y").cogroup(held.groupBy("hx", "hy")).applyInArrow(_reach(percent), "a long, b long")


def _blocks(sets: DataFrame) -> int:
    return 1 + (sets.agg(F.sum("n")).first()[0] or 0) * 8 // BLOCK_BYTES


def _likely(rows: DataFrame, percent: int) -> DataFrame:
    """For each set the standing set ``c`` that it meets most, as a pair ``a, b``."""
    near = rows.where(f"least(n, cn) * 100 >= greatest(n, cn) * {int(percent)}")
    met = near.groupBy("id", "c").agg(F.count("*").alias("meet"))
    return met.groupBy("id").agg(F.max_by("c", "meet").alias("b")).withColumnRenamed("id", "a")


def _placed(rows: DataFrame, parts: DataFrame, key: str, name: str) -> DataFrame:
    """``rows`` with the component of the set in ``key``, itself if it is alone."""
    known = parts.select(F.col("node").alias(key), F.col("component").alias(name))
    return rows.join(known, key, "left").withColumn(name, F.coalesce(name, key))


def verified(pairs: DataFrame, sets: DataFrame, percent: int, blocks: int) -> DataFrame:
    """Of the pairs ``a, b`` with at least ``percent`` of their union shared, enough to
    connect all that they connect.

    Sets are dealt into blocks of bounded size, pairs into tiles of two blocks. A set is
    sent once to each tile in which it has a pair, not once for each pair.
    """
    block = lambda c: F.pmod(F.xxhash64(F.lit(41), c), F.lit(blocks))
    pairs = pairs.select("a", "b", block("a").alias("x"), block("b").alias("y"))
    end = lambda c: pairs.select(F.col("x").alias("hx"), F.col("y").alias("hy"), F.col(c).alias("id")).distinct()
    ends = end("a").unionByName(end("b")).distinct()
    held = ends.join(sets.select("id", "shingles"), "id")
    return pairs.groupBy("x", "y").cogroup(held.groupBy("hx", "hy")).applyInArrow(_check(percent), "a long, b long")


def overlapping(few: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """All pairs ``a, b`` of a set of ``few`` and a similar one of ``sets``, by counting
    shared shingles: the exact way for the sets that have too few segments in use.

    Of ``sets`` only the shingles go on that some set of ``few`` has.
    """
    few = stored(few.withColumn("row", F.monotonically_increasing_id()))
    each = few.select("shingles", F.col("row").alias("id")).mapInArrow(_each, "h long, id long").withColumnRenamed("id", "row")
    # Rows, not keys: those that repeat a key are sets of their own.
    numbered = stored(sets.select("id", "n", "shingles").withColumn("other", F.monotonically_increasing_id()))
    rest = numbered.select("shingles", F.col("other").alias("id")).mapInArrow(_each, "h long, id long").withColumnRenamed("id", "other")
    both = rest.join(stored(each), "h").groupBy("row", "other").agg(F.count("*").alias("both"))
    found = both.join(few.select("row", F.col("id").alias("a"), F.col("n").alias("an")), "row")
    found = found.join(numbered.select("other", F.col("id").alias("b"), F.col("n").alias("bn")), "other")
    return found.where(f"a != b and both * 100 >= (an + bn - both) * {int(percent)}").select("a", "b")


def allocation(sets: DataFrame, percent: int) -> tuple[dict[int, tuple[int, bool]], bool]:
    """For each band of sizes the number of segments, and whether contents with one
    shingle left out are indexed too; and whether sets lack segments by that.

    Measured over all sets: a set lacks segments if too few of them are not empty for
    one to agree with every partner. Of the choices by which the fewest sets do, nearly
    always none, the cheapest is taken; those sets go another way (``overlapping``). The
    driver gets a few numbers for each band, of which there are at most 64.
    """
    measured = sets.select("shingles").mapInArrow(
        _measure(percent), "band int, choice int, short long, short_deleted long, plain long, deleted long"
    )
    sums = [F.sum(c).alias(c) for c in ("short", "short_deleted", "plain", "deleted")]
    best: dict[int, tuple[int, int, int, bool]] = {}
    for row in measured.groupBy("band", "choice").agg(*sums).collect():
        m = segments(row["band"], FACTORS[row["choice"]], percent)
        plain = (row["short"], row["plain"], m, False)
        deleted = (row["short_deleted"], row["plain"] + row["deleted"], m, True)
        best[row["band"]] = min(best.get(row["band"], plain), plain, deleted)
    # A band without sets of its own can still be visited by larger ones; nothing is there to meet.
    plan = {band: (m, deletions) for band, (_, _, m, deletions) in best.items()}
    return plan, any(short for short, *_ in best.values())


def segments(band: int, factor: float, percent: int) -> int:
    """Segments for sizes from 2^band to below 2^(band+1)."""
    most = (1 << (band + 1)) - 1
    return int((most * (100 - percent) // percent + 1) * factor)


def _profile(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in words.pieces(batch, "text", PIECE_BYTES):
                flat, offsets = words.shingle_sets(piece.column("text"), width)
                sizes = np.diff(offsets)
                prints = []
                for seed in (11, 12):
                    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words.mix(flat, seed), dtype=np.uint64)])
                    prints.append(words.mix(sums[offsets[1:]] - sums[offsets[:-1]]).view(np.int64))
                full = np.flatnonzero(sizes)
                minima = np.zeros((MINIMA, len(full)), np.uint64)
                for k in range(MINIMA if len(full) else 0):
                    minima[k] = words.mix(np.minimum.reduceat(words.mix(flat, 100 + k), offsets[:-1][full]), 200 + k)
                ends = np.cumsum(np.where(sizes > 0, MINIMA, 0))
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(minima.T.reshape(-1).view(np.int64))
                )
                yield pa.RecordBatch.from_arrays(
                    [piece.column("id"), pa.array(sizes), *map(pa.array, prints), lists], ["id", "n", "f1", "f2", "minima"]
                )

    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in words.pieces(batch, "text", PIECE_BYTES):
                flat, offsets = words.shingle_sets(piece.column("text"), width)
                blobs = [flat[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:])]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("id"), pa.array(np.diff(offsets)), pa.array(blobs, pa.binary())], ["id", "n", "shingles"]
                )

    return run


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct shingles of each set, one row each, some sets at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            piece = batch.slice(at, 64)
            arrays = [_array(b) for b in piece.column("shingles")]
            ids = np.repeat(piece.column("id").to_numpy(), [len(x) for x in arrays])
            flat = np.concatenate(arrays).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(flat), pa.array(ids)], ["h", "id"])


def _array(blob: pa.Scalar) -> np.ndarray:
    return np.frombuffer(blob.as_buffer(), dtype=np.uint64)


def _deal(shingles: np.ndarray, m: int):
    """Shingles ordered by segment: their values, the segments in use, where each begins."""
    place = words.mix(shingles, 21) % np.uint64(m)
    order = np.argsort(place, kind="stable")
    place = place[order]
    begins = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    return words.mix(shingles, 22)[order], place[begins], begins


def _needed(n: int, percent: int) -> int:
    """One more than the most shingles in which a set and a larger similar one differ."""
    return n * (100 - percent) // percent + 1


def _in_use(shingles: np.ndarray, m: int) -> tuple[int, int, int]:
    """Of ``m`` segments those in use, those with several shingles, and these shingles."""
    sizes = np.bincount((words.mix(shingles, 21) % np.uint64(m)).astype(np.int64))
    return int((sizes > 0).sum()), int((sizes > 1).sum()), int(sizes[sizes > 1].sum())


def _measure(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], list[int]] = {}
        for batch in batches:
            for blob in batch.column("shingles"):
                shingles = _array(blob)
                n = len(shingles)
                if not n:
                    continue
                band, need = n.bit_length() - 1, _needed(n, percent)
                for choice, factor in enumerate(FACTORS):
                    full, several, deleted = _in_use(shingles, segments(band, factor, percent))
                    row = total.setdefault((band, choice), [0, 0, 0, 0])
                    row[0] += need > full
                    row[1] += need > full + several
                    row[2] += full
                    row[3] += deleted
        if total:
            columns = [list(k) + v for k, v in total.items()]
            names = ["band", "choice", "short", "short_deleted", "plain", "deleted"]
            kinds = [pa.int32(), pa.int32(), *[pa.int64()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array([c[k] for c in columns], t) for k, t in enumerate(kinds)], names)

    return run


def _lacking(plan: dict[int, tuple[int, bool]], percent: int):
    """The sets of which too few segments are in use by ``plan``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lacks = []
            for blob in batch.column("shingles"):
                shingles = _array(blob)
                n = len(shingles)
                m, deletions = plan[n.bit_length() - 1] if n else (1, False)
                full, several, _ = _in_use(shingles, m)
                lacks.append(n > 0 and _needed(n, percent) > full + several * deletions)
            yield batch.select(["id", "n", "shingles"]).filter(pa.array(lacks, pa.bool_()))

    return run


def _signatures(plan: dict[int, tuple[int, bool]], percent: int):
    def one(shingles: np.ndarray, band: int) -> tuple[np.ndarray, int]:
        m, deletions = plan[band]
        values, used, begins = _deal(shingles, m)
        sums = np.add.reduceat(values, begins)
        tag = words.mix(used + np.uint64(band << 48), 23)
        out = [words.mix(sums ^ tag, 24)]
        if deletions:
            sizes = np.diff(np.append(begins, len(values)))
            several = np.repeat(sizes > 1, sizes)
            out.append(words.mix((np.repeat(sums, sizes) - values)[several] ^ np.repeat(tag, sizes)[several], 24))
        return np.concatenate(out), len(used)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sigs, ids, sizes, owns, spares = [], [], [], [], []
            count = 0
            for key, blob in zip(batch.column("id").to_pylist(), batch.column("shingles")):
                shingles = _array(blob)
                n = len(shingles)
                if not n:
                    continue
                band = n.bit_length() - 1
                # A larger set also goes to the band of the smallest sets it can be similar to.
                lowest = (-(-n * percent // 100)).bit_length() - 1
                for b in {band, lowest}:
                    if b not in plan:
                        continue
                    found, units = one(shingles, b)
                    # With shingles left out a segment has several contents, and none is passed over.
                    spare = EVERY if plan[b][1] else units - _needed(n, percent)
                    for out, value in ((ids, key), (sizes, n), (owns, b == band), (spares, spare)):
                        out.append(np.full(len(found), value))
                    sigs.append(found)
                    count += len(found)
                if count > 200_000:
                    yield _index(sigs, ids, sizes, owns, spares)
                    sigs, ids, sizes, owns, spares = [], [], [], [], []
                    count = 0
            if sigs:
                yield _index(sigs, ids, sizes, owns, spares)

    return run


def _index(sigs, ids, sizes, owns, spares) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate(sigs).view(np.int64)),
            pa.array(np.concatenate(ids).astype(np.int64)),
            pa.array(np.concatenate(sizes).astype(np.int64)),
            pa.array(np.concatenate(owns).astype(bool)),
            pa.array(np.concatenate(spares).astype(np.int64)),
        ],
        ["sig", "id", "n", "own", "spare"],
    )


def _check(percent: int):
    def run(pairs: pa.Table, held: pa.Table) -> pa.Table:
        sets: dict[int, list[np.ndarray]] = {}
        for key, blobs in zip(held.column("id").to_pylist(), held.column("shingles")):
            sets.setdefault(key, []).append(_array(blobs))
        root = {key: key for key in sets}

        def top(key: int) -> int:
            while root[key] != key:
                root[key] = root[root[key]]
                key = root[key]
            return key

        links = []
        for a, b in zip(pairs.column("a").to_pylist(), pairs.column("b").to_pylist()):
            if a not in root or b not in root or top(a) == top(b):
                continue
            if any(_similar(x, y, percent) for x in sets[a] for y in sets[b]):
                root[top(a)] = top(b)
                links.append((a, b))
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})

    return run


def _reach(percent: int):
    def run(pairs: pa.Table, held: pa.Table) -> pa.Table:
        own: dict[int, list[np.ndarray]] = {}
        parts: dict[int, list[tuple[int, np.ndarray]]] = {}
        for key, part, blob in zip(held.column("id").to_pylist(), held.column("part").to_pylist(), held.column("shingles")):
            if part is None:
                own.setdefault(key, []).append(_array(blob))
            else:
                parts.setdefault(part, []).append((key, _array(blob)))
        links = []
        for a, part in zip(pairs.column("a").to_pylist(), pairs.column("part").to_pylist()):
            # One link connects the set with the whole component.
            for b, y in parts.get(part, ()):
                if any(_similar(x, y, percent) for x in own.get(a, ())):
                    links.append((a, b))
                    break
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})

    return run


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    if len(x) > len(y):
        x, y = y, x
    if not len(x):
        return False
    if 100 * len(x) < percent * len(y):
        return False
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    both = int((y[at] == x).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)
