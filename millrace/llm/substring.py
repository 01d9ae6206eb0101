"""Removal of word passages that an earlier document already has."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from millrace.llm import words
from millrace.llm.tables import bounded, stored

#: Copies of other documents that may be broadcast; more are joined by shuffle.
BROADCAST_ROWS = 1_000_000


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = 50) -> DataFrame:
    """Drop each word covered by a window of ``window`` words that also starts in a
    document with a smaller key.

    Returns ``key, n_words, n_removed, kept`` (kept words joined by one space), one row
    per input row. Windows are judged on the input. A null text has no words. A row
    with a null key neither removes nor loses anything. Rows that repeat a key count
    as one document. Other columns are ignored, whatever their names.

    Every window's Rabin-Karp hash is taken in the tasks. So that not all of them need
    a shuffle, two exact steps go first: documents with the same word sequence are
    stood for by the one with the smallest key, and a window is only counted if the
    least hash of its inner runs (``_inner`` words each) occurs again somewhere. Equal
    windows have equal least inner runs, so this loses nothing.
    """
    base = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    read = stored(base.mapInArrow(_scan(window), "id long, n long, f1 long, f2 long, halves array<long>"))
    keyed = read.where("id is not null and n >= %d" % window)
    first = keyed.groupBy("f1", "f2").agg(F.min("id").alias("first"))
    copies = stored(keyed.select("id", "f1", "f2").join(first, ["f1", "f2"]).where("id > first").select("id", "f1"))
    # A copy's runs need no counting: the first document has them.
    others = keyed.select("id", "f1", "halves").join(bounded(copies, BROADCAST_ROWS), ["id", "f1"], "left_anti")
    halves = others.select("id", F.explode("halves").alias("h"))
    shared = halves.groupBy("h").agg(F.count("*").alias("many")).where("many > 1").select("h")
    wanted = halves.join(shared, "h").groupBy("id").agg(F.collect_set("h").alias("halves"))
    # The same left join twice: Spark shuffles the texts once and reads them again. (A
    # condition on the joined side would make one of them an inner join with a shuffle
    # of its own.) The other side is small for each key and hashed, so nothing is sorted.
    seen = base.join(wanted.hint("shuffle_hash"), "id", "left").select("id", "text", "halves")
    found = seen.mapInArrow(_windows(window), "id long, w1 long, w2 long")
    earliest = found.groupBy("w1", "w2").agg(F.min("id").alias("lo"))
    late = (
        found.join(earliest, ["w1", "w2"])
        .where("id > lo")
        .groupBy("id")
        .agg(F.collect_list("w1").alias("late"))
    )
    whole = copies.groupBy("id").agg(F.lit(True).alias("copy"))
    twice = keyed.groupBy("id").agg(F.count_distinct("f1", "f2").alias("texts"))
    # A key with several texts can be a copy in one row only; such rows are told apart by their hash.
    odd = copies.join(twice.where("texts > 1"), "id")
    odd = odd.groupBy("id").agg(F.collect_set("f1").alias("odd"))
    fate = (
        late.join(whole, "id", "full")
        .join(odd, "id", "left")
        .select("id", "late", "copy", "odd")
    )
    return (
        base.join(fate.hint("shuffle_hash"), "id", "left")
        .mapInArrow(_cut(window), "id long, n_words long, n_removed long, kept binary")
        .select(F.col("id").alias(key), "n_words", "n_removed", F.col("kept").cast("string").alias("kept"))
    )


def _inner(window: int) -> int:
    """Words of a window's inner runs: long ones are rarely equal by chance, short ones
    leave fewer least runs to count."""
    return max(1, window * 3 // 5)


def _scan(window: int):
    half = _inner(window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in words.pieces(batch, "text"):
                hashes, offsets = words.word_hashes(piece.column("text"))
                counts = np.diff(offsets)
                position = np.arange(len(hashes), dtype=np.uint64) - np.repeat(offsets[:-1], counts).astype(np.uint64)
                prints = [_sums(words.mix(hashes + words.mix(position, 9), s), offsets) for s in (3, 4)]
                least, owner = _least_halves(hashes, offsets, window, half)
                new = owner >= 0
                new[1:] &= (least[1:] != least[:-1]) | (owner[1:] != owner[:-1])
                chosen = least[new].view(np.int64)
                ends = np.searchsorted(owner[new], np.arange(len(counts) + 1))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(chosen))
                yield pa.RecordBatch.from_arrays(
                    [piece.column("id"), pa.array(counts), *(pa.array(p.view(np.int64)) for p in prints), lists],
                    ["id", "n", "f1", "f2", "halves"],
                )

    return run


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    return words.mix(sums[offsets[1:]] - sums[offsets[:-1]])


def _least_halves(hashes, offsets, window, half):
    """For each window the least hash of its runs of ``half`` words, and its text or -1."""
    if len(hashes) < window:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    least = words.sliding_min(words.rolling(hashes, half, seed=1), window - half + 1)
    return least, words.inside(len(least), offsets, window)


def _windows(window: int):
    half = _inner(window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pc.is_valid(batch.column("halves")))
            for piece in words.pieces(batch, "text"):
                hashes, offsets = words.word_hashes(piece.column("text"))
                least, owner = _least_halves(hashes, offsets, window, half)
                ids, lists = piece.column("id").to_numpy(zero_copy_only=False), piece.column("halves")
                keep = np.zeros(len(least), bool)
                for k in range(len(ids)):
                    a, b = offsets[k], max(offsets[k], offsets[k + 1] - window + 1)
                    wanted = lists[k].values.to_numpy(zero_copy_only=False).view(np.uint64)
                    keep[a:b] = np.isin(least[a:b], wanted)
                at = np.flatnonzero(keep)
                if not len(at):
                    continue
                w1, w2 = words.rolling(hashes, window, seed=2)[at], words.rolling(hashes, window, seed=5)[at]
                rows = np.unique(np.stack([owner[at].astype(np.uint64), w1, w2], axis=1), axis=0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[rows[:, 0].astype(np.int64)]), pa.array(rows[:, 1].view(np.int64).copy()), pa.array(rows[:, 2].view(np.int64).copy())],
                    ["id", "w1", "w2"],
                )

    return run


def _cut(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in words.pieces(batch, "text"):
                n = piece.num_rows
                late, copy, odd = (piece.column(c) for c in ("late", "copy", "odd"))
                marked = [late[k].is_valid or copy[k].is_valid for k in range(n)]
                if any(marked):
                    hashes, offsets = words.word_hashes(piece.column("text"))
                    rolled = words.rolling(hashes, window, seed=2)
                    counts = np.diff(offsets)
                    position = np.arange(len(hashes), dtype=np.uint64) - np.repeat(offsets[:-1], counts).astype(np.uint64)
                    prints = _sums(words.mix(hashes + words.mix(position, 9), 3), offsets)
                kept, total, removed = [], [], []
                for k, text in enumerate(piece.column("text")):
                    own = (text.as_py() or "").encode().split()
                    total.append(len(own))
                    out = np.zeros(len(own), bool)
                    if marked[k] and len(own) >= window:
                        a, b = offsets[k], offsets[k + 1] - window + 1
                        mine = odd[k].is_valid
                        if copy[k].is_valid and (not mine or int(prints[k].view(np.int64)) in odd[k].as_py()):
                            out[:] = True
                        elif late[k].is_valid:
                            bad = np.isin(rolled[a:b], late[k].values.to_numpy(zero_copy_only=False).view(np.uint64))
                            steps = np.zeros(len(own) + 1, np.int64)
                            steps[:-window] += bad
                            steps[window:] -= bad
                            out = np.cumsum(steps[:-1]) > 0
                    removed.append(int(out.sum()))
                    kept.append(b" ".join(w for w, o in zip(own, out) if not o) if removed[-1] else b" ".join(own))
                yield pa.RecordBatch.from_arrays(
                    [piece.column("id"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary())],
                    ["id", "n_words", "n_removed", "kept"],
                )

    return run


def digests(result: DataFrame, key: str = "doc_id") -> DataFrame:
    """The kept texts as hashes."""
    return result.select(key, "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
