"""The language of texts, also where one text mixes several.

Words are runs of letters. Each word's script leaves the languages that use it, each of
them scores the word by its character 4-grams, and a Viterbi pass with a penalty for
switching labels spans of words. A text's language is the one with the most letters.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from millrace.llm import words

#: Hash slots for character n-grams; with the number of languages it bounds the model.
SLOTS = 1 << 16
#: Cost of changing the language between two words, in nats.
SWITCH = 12.0
UNKNOWN = "und"

# First and last code point of the letters of each script.
SCRIPTS = {
    "latin": [(0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFB00, 0xFB06), (0xFF21, 0xFF5A)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "armenian": [(0x531, 0x58F)],
    "hebrew": [(0x591, 0x5F4)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "indic": [(0x900, 0xDFF)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)],
}


@dataclass
class Model:
    """``languages`` in order; log odds of every n-gram slot for each; scripts they use."""

    languages: list[str]
    weights: np.ndarray
    scripts: np.ndarray
    tables: tuple | None = None

    def __getstate__(self):
        return {"languages": self.languages, "weights": self.weights, "scripts": self.scripts, "tables": None}

    def letter_tables(self) -> tuple[np.ndarray, np.ndarray]:
        if self.tables is None:
            self.tables = letter_tables()
        return self.tables


def letter_tables() -> tuple[np.ndarray, np.ndarray]:
    """For each code point the script of a letter (0: no letter), and its lower case."""
    script = np.zeros(0x110000, np.uint8)
    for c in range(0x110000):
        if unicodedata.category(chr(c))[0] == "L":
            script[c] = len(SCRIPTS) + 1
    for k, ranges in enumerate(SCRIPTS.values(), 1):
        for a, b in ranges:
            part = script[a : b + 1]
            part[part > 0] = k
    lower = np.arange(0x110000, dtype=np.uint32)
    for c in np.flatnonzero(script).tolist():
        low = chr(c).lower()
        if len(low) == 1:
            lower[c] = ord(low)
    return script, lower


def _spans(texts: list[str], script: np.ndarray, lower: np.ndarray):
    """Letters of all texts as lower-case code points between blanks, with word bounds."""
    points = np.frombuffer((" " + " ".join(texts) + " ").encode("utf-32-le", "replace"), dtype=np.uint32)
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    offsets = 1 + np.concatenate([[0], np.cumsum(sizes + 1)])
    kind = script[points]
    letter = kind > 0
    edge = np.flatnonzero(letter[1:] != letter[:-1]) + 1
    starts, ends = edge[0::2], edge[1::2]
    return np.where(letter, lower[points], 32).astype(np.uint32), kind, starts, ends, np.searchsorted(starts, offsets)


def _slots(points: np.ndarray) -> np.ndarray:
    """The slot of the 4-gram that begins one place before each letter."""
    x = points.astype(np.uint64)
    x = np.concatenate([np.full(1, 32, np.uint64), x, np.full(2, 32, np.uint64)])
    # What lies beyond a blank is another word and doesn't count.
    a, b, c, d = x[:-3], x[1:-2], x[2:-1], x[3:]
    d = np.where(c == 32, np.uint64(32), d)
    return (words.mix(((a * np.uint64(0x110000) + b) * np.uint64(0x110000) + c) * np.uint64(0x9E3779B1) + d) >> np.uint64(48)).astype(np.int64)


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """Learn from the text and language of all rows given; null labels are left out.

    Counts of n-grams by language are made and added up by Spark; the driver gets at
    most ``SLOTS`` numbers for each language. Without labelled letters the model has no
    languages and calls every text unknown.
    """
    base = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    base = base.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
    counted = base.mapInArrow(_count, "lang string, slot int, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n"))
    table = counted.toArrow()
    names = sorted(set(table.column("lang").to_pylist()))
    place = {name: k for k, name in enumerate(names)}
    row = np.array([place[x] for x in table.column("lang").to_pylist()], dtype=np.int64)
    slot, n = table.column("slot").to_numpy(), table.column("n").to_numpy()
    counts = np.zeros((len(names), SLOTS))
    grams = slot >= 0
    counts[row[grams], slot[grams]] = n[grams]
    scripts = np.zeros((len(names), len(SCRIPTS) + 2))
    scripts[row[~grams], -1 - slot[~grams]] = n[~grams]
    if not len(names):
        return Model([], np.zeros((0, SLOTS), np.float32), scripts > 0)
    smooth = np.log((counts + 0.5) / (counts.sum(axis=1, keepdims=True) + 0.5 * SLOTS))
    share = scripts / np.maximum(scripts.sum(axis=1, keepdims=True), 1)
    # A script counts for a language if more than stray letters are written in it.
    return Model(names, np.ascontiguousarray(smooth.T.astype(np.float32)), share >= 0.01)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    script, lower = letter_tables()
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        for piece in words.pieces(batch, "text"):
            langs = piece.column("lang").to_pylist()
            by: dict[str, list[str]] = {}
            for name, text in zip(langs, piece.column("text").to_pylist()):
                by.setdefault(name, []).append(text)
            for name, texts in by.items():
                points, kind, *_ = _spans(texts, script, lower)
                own = sums.setdefault(name, np.zeros(SLOTS + len(SCRIPTS) + 2, np.int64))
                own[:SLOTS] += np.bincount(_slots(points)[kind > 0], minlength=SLOTS)
                own[SLOTS:] += np.bincount(kind[kind > 0], minlength=len(SCRIPTS) + 2)
            if len(sums) > 64:
                yield from _flush(sums)
                sums = {}
    yield from _flush(sums)


def _flush(sums: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for name, own in sums.items():
        at = np.flatnonzero(own)
        slot = np.where(at < SLOTS, at, SLOTS - 1 - at).astype(np.int32)  # scripts below zero
        yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(slot), pa.array(own[at])], ["lang", "slot", "n"])


def viterbi(scores: np.ndarray, offsets: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best language of each word, texts side by side.

    Texts are cut into stretches of 64 words. A first pass finds for each stretch what
    any language at its begin leads to at its end, a second one goes over the stretches
    of each text, and a third one labels all stretches at once. The result is that of
    one pass over each text.
    """
    n, k = scores.shape
    lengths = np.diff(offsets)
    step = 64
    chunks = -(-lengths // step)
    first = np.cumsum(chunks) - chunks
    total = int(chunks.sum())
    if not total:
        return np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(lengths)), chunks)
    begin = offsets[:-1][owner] + (np.arange(total) - first[owner]) * step
    size = np.minimum(step, offsets[1:][owner] - begin)
    # lead[c, i, j]: best score at the end in j if the word before was in i.
    lead = np.full((total, k, k), -np.inf)
    lead[:, np.arange(k), np.arange(k)] = 0.0
    order = np.argsort(-size, kind="stable")
    alive = np.searchsorted(-size[order], -np.arange(step), side="left")
    for t in range(step):
        rows = order[: alive[t]]
        if not len(rows):
            break
        now = lead[rows]
        lead[rows] = np.maximum(now, now.max(axis=2, keepdims=True) - switch) + scores[begin[rows] + t][:, None, :]
    enter = np.zeros((total, k))
    depth = np.arange(total) - first[owner]
    by_depth = np.argsort(depth, kind="stable")
    cuts = np.searchsorted(depth[by_depth], np.arange(1, int(depth.max()) + 1))
    level = np.split(by_depth, cuts)
    for rows in level[1:]:
        enter[rows] = (enter[rows - 1][:, :, None] + lead[rows - 1]).max(axis=1)
    back = np.zeros((n, k), np.int8 if k < 128 else np.int32)
    now = enter.copy()
    for t in range(step):
        rows = order[: alive[t]]
        if not len(rows):
            break
        here = now[rows]
        best = here.argmax(axis=1)
        jump = here.max(axis=1) - switch
        back[begin[rows] + t] = np.where(here >= jump[:, None], np.arange(k)[None, :], best[:, None])
        now[rows] = np.maximum(here, jump[:, None]) + scores[begin[rows] + t]
    # Each stretch can end in any language; what it began from then follows.
    state = np.tile(np.arange(k), (total, 1))
    for t in range(step - 1, -1, -1):
        rows = order[: alive[t]]
        if len(rows):
            state[rows] = np.take_along_axis(back[begin[rows] + t].astype(np.int64), state[rows], axis=1)
    last = np.zeros(total, np.int64)
    ends = first + chunks - 1
    has = chunks > 0
    last[ends[has]] = now[ends[has]].argmax(axis=1)
    for rows in level[:0:-1]:
        last[rows - 1] = state[rows, last[rows]]
    out = np.zeros(n, np.int64)
    current = last.copy()
    for t in range(step - 1, -1, -1):
        rows = order[: alive[t]]
        if len(rows):
            out[begin[rows] + t] = current[rows]
            current[rows] = back[begin[rows] + t][np.arange(len(rows)), current[rows]]
    return out


def word_scores(model: Model, texts: list[str]):
    """Scores of each word for each language, its letters, and where each text's words begin."""
    script, lower = model.letter_tables()
    points, kind, starts, ends, offsets = _spans(texts, script, lower)
    at = np.flatnonzero(kind)
    grams = model.weights[_slots(points)[at]]
    size = ends - starts
    begins = np.cumsum(size) - size
    if not len(starts):
        return np.zeros((0, len(model.languages))), size, offsets
    scores = np.add.reduceat(grams.astype(np.float64), begins, axis=0)
    used = model.scripts[:, kind[starts]].T
    scores[~used & used.any(axis=1, keepdims=True)] -= 1e4
    # The script is in no language that was learned: such a word tells nothing.
    scores[~used.any(axis=1)] = 0.0
    return scores, size, offsets


def _label(model: Model, texts: list[str]) -> tuple[list[str], np.ndarray]:
    if not model.languages:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    scores, size, offsets = word_scores(model, texts)
    state = viterbi(scores, offsets)
    owner = np.repeat(np.arange(len(texts)), np.diff(offsets))
    mass = np.zeros((len(texts), len(model.languages)))
    np.add.at(mass, (owner, state), size.astype(np.float64))
    total = mass.sum(axis=1)
    best = mass.argmax(axis=1)
    share = np.where(total > 0, mass.max(axis=1) / np.maximum(total, 1), 0.0)
    return [model.languages[b] if t > 0 else UNKNOWN for b, t in zip(best, total)], share


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, replacing columns of these names.

    The score is the share of the text's letters in spans of that language. A text
    that is null or has no letter gets ``und`` and 0. Whole texts are read, however
    long; equal texts get equal results. Rows come back one for one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    carry = [c for c in docs.columns if c not in ("lang_pred", "score")]
    names = [f"c{k}" for k in range(len(carry))]
    base = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(carry, names)], F.col(text).cast("string").alias("__text"))
    schema = base.drop("__text").schema.add("lang_pred", "string").add("score", "double")
    read = "__text"
    if carry.count(text) == 1 and docs.schema[text].dataType == StringType():
        # Whole texts are wide, so Python gets them once.
        read = names[carry.index(text)]
        base = base.drop("__text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in words.pieces(batch, read, words.PIECE_BYTES // 2):
                found, share = _label(shared.value, [t or "" for t in piece.column(read).to_pylist()])
                columns = [piece.column(c) for c in names]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.string()), pa.array(share)], [*names, "lang_pred", "score"])

    return base.mapInArrow(run, schema).toDF(*carry, "lang_pred", "score")


def spans(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, start, end, lang``: stretches of words of one language, in code points.

    A text without letters has no span.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    base = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = dict(base.dtypes)["key"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in words.pieces(batch, "text", words.PIECE_BYTES // 2):
                texts = [t or "" for t in piece.column("text").to_pylist()]
                own = shared.value
                if not own.languages:
                    continue
                scores, _, offsets = word_scores(own, texts)
                state = viterbi(scores, offsets)
                _, _, starts, ends, _ = _spans(texts, *own.letter_tables())
                owner = np.repeat(np.arange(len(texts)), np.diff(offsets))
                if not len(state):
                    continue
                base_at = 1 + np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])[owner]
                new = np.ones(len(state), bool)
                new[1:] = (state[1:] != state[:-1]) | (owner[1:] != owner[:-1])
                head = np.flatnonzero(new)
                tail = np.append(head[1:], len(state)) - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("key").take(pa.array(owner[head])),
                        pa.array((starts - base_at)[head]),
                        pa.array((ends - base_at)[tail]),
                        pa.array([own.languages[s] for s in state[head]], pa.string()),
                    ],
                    ["key", "start", "end", "lang"],
                )

    return base.mapInArrow(run, f"key {kind}, start long, end long, lang string").withColumnRenamed("key", key)


def held_out(key: Column | str) -> Column:
    """Rows that are never learned from: crc32 of the key as text leaves 2 by 4."""
    column = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 4 == 2, F.lit(False))
