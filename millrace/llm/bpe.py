"""Byte-pair encoding and decoding of texts with a given vocabulary.

Speculate and verify: a word's tokens are first proposed by greedy longest match. A
proposal is the merge result exactly if every two adjacent tokens would also be
tokenised as themselves when they stand alone, which arrays test for all pairs of all
new words at once. Only words with a failing pair are merged step by step.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from millrace.llm import words

#: Words whose tokens a task remembers; the memory is emptied when it is full.
REMEMBERED = 250_000
#: Words whose ids and text a task remembers as strings, in two halves.
REMEMBERED_STRINGS = 600_000
#: Longer words are encoded each time instead of being remembered.
LONGEST_REMEMBERED = 64

# Fixed values of the vocabulary's text rules.
_SPACE = r"\t\n\v\f\r \u0085   -     　"
_PIECE = r"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{spaces}{letters}{numbers}]+"
_END = "</w>"
# Texts of lower code points are split by ``re``, which is faster but has to be told the classes.
_LOW = 0x530


def _low(kind: str) -> str:
    """The code points below ``_LOW`` of a Unicode class, as ``re`` wants them."""
    wanted = regex.compile(kind)
    return "".join(rf"\u{c:04x}" for c in range(_LOW) if wanted.match(chr(c)))


def byte_letters() -> dict[int, str]:
    """The printable letter by which byte-level vocabularies write each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(other)}


class Encoder:
    """Encodes and decodes with a byte-level vocabulary that marks word ends.

    ``spec`` is the vocabulary file's JSON text. Raises if the file has another kind of
    normaliser, splitter or model than the ones this class follows.
    """

    def __init__(self, spec: str):
        spec = json.loads(spec)
        model, steps = spec["model"], [s["type"] for s in (spec.get("normalizer") or {}).get("normalizers", [])]
        if (
            model["type"] != "BPE"
            or model.get("end_of_word_suffix") != _END
            or model.get("continuing_subword_prefix")
            or steps != ["NFC", "Replace", "Lowercase"]
            or spec.get("decoder") is not None
            or spec.get("post_processor") is not None
        ):
            raise ValueError("not a lower-casing byte-level vocabulary with word ends")
        self.vocabulary: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max(max(self.vocabulary.values()), *self.special.values()) + 1
        self.tokens = [""] * size
        for token, number in (self.vocabulary | self.special).items():
            self.tokens[number] = token
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([self.vocabulary[a] for a, _ in merges], dtype=np.int64)
        right = np.array([self.vocabulary[b] for _, b in merges], dtype=np.int64)
        made = np.array([self.vocabulary[a + b] for a, b in merges], dtype=np.int64)
        # Rank of the merge of two tokens, times ``size``, plus the token it makes.
        self.ranks = {(a, b): k * size + c for k, (a, b, c) in enumerate(zip(left.tolist(), right.tolist(), made.tolist()))}
        # The order in which tokens come about: single bytes first, then by merge.
        self.order = np.full(size, -1, np.int64)
        self.order[made[::-1]] = np.arange(len(made))[::-1]
        self.first, self.second = np.full(size, -1, np.int64), np.full(size, -1, np.int64)
        self.first[made[::-1]], self.second[made[::-1]] = left[::-1], right[::-1]
        self.pairs = left * size + right
        sort = np.argsort(self.pairs)
        self.pairs, self.pair_order = self.pairs[sort], sort.astype(np.int64)
        self.size = size
        self.digits = [str(t) for t in range(size)]
        self.longest = max(len(t.removesuffix(_END)) for t in self.vocabulary)
        # By first three letters, the length of the longest entry that doesn't end a word.
        self.reach: dict[str, int] = {}
        for token in self.vocabulary:
            if not token.endswith(_END):
                self.reach[token[:3]] = max(len(token), self.reach.get(token[:3], 2))
        self.spread = {b: c for b, c in byte_letters().items()}
        self.splitter = regex.compile(_PIECE.format(letters=r"\p{L}", numbers=r"\p{N}", spaces=_SPACE))
        self.low_splitter = re.compile(_PIECE.format(letters=_low(r"\p{L}"), numbers=_low(r"\p{N}"), spaces=_SPACE))
        self.high = re.compile(f"[^\0-{chr(_LOW - 1)}]")
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.known: dict[str, tuple[int, ...]] = {}
        self.known_ids: dict[str, str] = {}
        self.known_text: dict[str, str] = {}
        self.older_ids: dict[str, str] = {}
        self.older_text: dict[str, str] = {}
        self.long: list[str] = []

    def split(self, text: str) -> list[str]:
        """The words of a text; marker tokens stand for themselves."""
        if self.specials is None or "<" not in text or not self.specials.search(text):
            return self._plain(text)
        out: list[str] = []
        for k, part in enumerate(self.specials.split(text)):
            out += [part] if k % 2 else self._plain(part)
        return out

    def _plain(self, text: str) -> list[str]:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        return (self.splitter if self.high.search(text) else self.low_splitter).findall(text)

    def greedy(self, word: str) -> list[int]:
        """Longest vocabulary entries from the left."""
        letters = word.encode().decode("latin-1").translate(self.spread)
        out, at, n, known, reach = [], 0, len(letters), self.vocabulary, self.reach
        while at < n:
            if n - at <= self.longest and (token := known.get(letters[at:] + _END)) is not None:
                out.append(token)
                break
            stop = min(n - 1, at + reach.get(letters[at : at + 3], 2))
            while (token := known.get(letters[at:stop])) is None:
                stop -= 1
            out.append(token)
            at = stop
        return out

    def merged(self, word: str) -> list[int]:
        """The merges in order of rank, then place."""
        letters = word.encode().decode("latin-1").translate(self.spread)
        ids = [self.vocabulary[c] for c in letters[:-1]] + [self.vocabulary[letters[-1] + _END]]
        if len(ids) <= 32:
            ranks, none, size = self.ranks, 1 << 60, self.size
            near = [ranks.get(p, none) for p in zip(ids, ids[1:])]
            while near and (best := min(near)) != none:
                k = near.index(best)
                ids[k : k + 2] = [best % size]
                del near[k]
                if k:
                    near[k - 1] = ranks.get((ids[k - 1], ids[k]), none)
                if k < len(near):
                    near[k] = ranks.get((ids[k], ids[k + 1]), none)
            return ids
        following, before = [*range(1, len(ids)), -1], [-1, *range(len(ids) - 1)]
        heap = [(self.ranks[p], k, *p) for k, p in enumerate(zip(ids, ids[1:])) if p in self.ranks]
        heapq.heapify(heap)
        while heap:
            best, k, a, b = heapq.heappop(heap)
            nxt = following[k]
            if ids[k] != a or nxt < 0 or ids[nxt] != b:
                continue
            ids[k], ids[nxt] = best % self.size, -1
            following[k] = following[nxt]
            if following[k] >= 0:
                before[following[k]] = k
            for i, j in ((before[k], k), (k, following[k])):
                if i >= 0 and j >= 0 and (p := (ids[i], ids[j])) in self.ranks:
                    heapq.heappush(heap, (self.ranks[p], i, *p))
        return [t for t in ids if t >= 0]

    def compatible(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """For each pair, whether the two tokens side by side stay as they are.

        The pair is taken apart from the later merge to the earlier one; it fails if
        the parts that touch would merge before the merge that hides them.
        """
        ok = np.ones(len(left), bool)
        rows, a, b = np.arange(len(left)), left.copy(), right.copy()
        # A merge of touching parts must be later than this to do no harm.
        limit = np.full(len(left), np.iinfo(np.int64).max)
        strict = np.zeros(len(left), bool)
        while len(rows):
            code = a * self.size + b
            at = np.minimum(np.searchsorted(self.pairs, code), len(self.pairs) - 1)
            rank = np.where(self.pairs[at] == code, self.pair_order[at], np.iinfo(np.int64).max)
            bad = (rank < limit) | ((rank == limit) & strict & (rank < np.iinfo(np.int64).max))
            ok[rows[bad]] = False
            oa, ob = self.order[a], self.order[b]
            apart = ~bad & ((oa >= 0) | (ob >= 0))
            rows, a, b, oa, ob = (x[apart] for x in (rows, a, b, oa, ob))
            # Of equal merges the left one happens first, so the right part is opened first.
            open_left = oa > ob
            limit = np.where(open_left, oa, ob)
            strict = ~open_left
            a, b = np.where(open_left, self.second[a], a), np.where(open_left, b, self.first[b])
        return ok

    def learn(self, new: list[str]) -> dict[str, tuple[int, ...]]:
        """Tokens of words not seen before."""
        guesses = [self.greedy(w) for w in new]
        sizes = np.array([len(g) for g in guesses], dtype=np.int64)
        flat = np.fromiter((t for g in guesses for t in g), dtype=np.int64, count=int(sizes.sum()))
        word = np.repeat(np.arange(len(new)), sizes)
        touch = word[1:] == word[:-1]
        fits = self.compatible(flat[:-1][touch], flat[1:][touch])
        failing = set(np.unique(word[1:][touch][~fits]).tolist())
        return {w: tuple(self.merged(w)) if k in failing else tuple(g) for k, (w, g) in enumerate(zip(new, guesses))}

    def prepare(self, split: list[list[str]]) -> None:
        """Learn the words of some texts, within the memory that ``REMEMBERED`` sets."""
        new = set().union(*split).difference(self.known)
        if len(self.known) + len(new) > REMEMBERED:
            stay = set().union(*split).intersection(self.known)
            self.known = {w: self.known[w] for w in stay}
        self.known |= self._found(new)

    def prepare_strings(self, split: list[list[str]]) -> None:
        """Learn the words of some texts, their ids and what these decode to kept as text.

        Once half of ``REMEMBERED_STRINGS`` are known these become the older half, and what
        is used again comes back from it.
        """
        if len(self.known_ids) > REMEMBERED_STRINGS // 2:
            self.older_ids, self.older_text = self.known_ids, self.known_text
            self.known_ids, self.known_text = {}, {}
        ids, text, digits, tokens = self.known_ids, self.known_text, self.digits, self.tokens
        new = set().union(*split).difference(ids)
        for w in new.intersection(self.older_ids):
            ids[w], text[w] = self.older_ids[w], self.older_text[w]
        for w, found in self._found(new.difference(ids)).items():
            ids[w] = " ".join([digits[t] for t in found])
            text[w] = " ".join([tokens[t] for t in found])
            if len(w) > LONGEST_REMEMBERED:
                self.long.append(w)

    def _found(self, new: set[str]) -> dict[str, tuple[int, ...]]:
        found = self.learn([w for w in new if w not in self.special])
        return found | {w: (self.special[w],) for w in new if w in self.special}

    def forget_long(self) -> None:
        for w in self.long:
            del self.known_ids[w], self.known_text[w]
        self.long = []
        for w in [w for w in self.known if len(w) > LONGEST_REMEMBERED]:
            del self.known[w]

    def decode(self, ids: list[int]) -> str:
        """The tokens' texts joined by spaces; unknown ids are skipped."""
        return " ".join([self.tokens[t] for t in ids if 0 <= t < self.size and self.tokens[t]])


class Shared:
    """A vocabulary file's text and, in each Python worker, the encoder made from it.

    It is broadcast, its size bounded by the vocabulary. A worker keeps a broadcast's
    value from task to task, and with it the words its encoder remembers.
    """

    def __init__(self, spec: str):
        self.spec, self.made = spec, None

    def __getstate__(self):
        return {"spec": self.spec, "made": None}

    def encoder(self) -> Encoder:
        if self.made is None:
            self.made = Encoder(self.spec)
        return self.made


def vocabulary(path: str) -> str:
    """The text of a vocabulary file that the driver can read."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode(docs: DataFrame, spec: str, key: str = "doc_id", text: str = "text", decoded: bool = False) -> DataFrame:
    """``key, n_tokens, ids`` of every whole text; a null text counts as empty.

    With ``decoded`` also ``decoded_sha256``, the hash of the text that ``decode`` makes
    from the ids.

    One row per input row, repeated or null keys included. Other columns are ignored,
    whatever their names. An empty text has no tokens. ``spec`` is the vocabulary
    file's text; it goes to the executors once, as a broadcast of that bounded size.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Shared(spec))
    base = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = dict(base.dtypes)["key"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared.value.encoder()
        for batch in batches:
            for piece in words.pieces(batch, "text", words.PIECE_BYTES // 4):
                split = [encoder.split(t or "") for t in piece.column("text").to_pylist()]
                encoder.prepare(split)
                sizes, flat = [0], []
                for text_words in split:
                    for w in text_words:
                        flat.extend(encoder.known[w])
                    sizes.append(len(flat))
                encoder.forget_long()
                ids = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(np.array(flat, dtype=np.int32)))
                counts = pa.array(np.diff(np.array(sizes, dtype=np.int64)))
                columns = {"key": piece.column("key"), "n_tokens": counts, "ids": ids}
                if decoded:
                    texts = (encoder.decode(flat[a:b]) for a, b in zip(sizes[:-1], sizes[1:]))
                    columns["decoded_sha256"] = pa.array([sha256(t.encode()).hexdigest() for t in texts], pa.string())
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    more = ", decoded_sha256 string" if decoded else ""
    out = base.mapInArrow(run, f"key {kind}, n_tokens long, ids array<int>{more}")
    return out.withColumnRenamed("key", key)


def decode(tokens: DataFrame, spec: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key, decoded`` of every row of token ids; null ids give an empty text.

    Token texts are joined by one space, word-end marks included, as a vocabulary
    without a decoder gives them back. Ids outside the vocabulary are skipped.
    """
    shared = tokens.sparkSession.sparkContext.broadcast(Shared(spec))
    base = tokens.select(F.col(key).alias("key"), F.col(ids).cast("array<int>").alias("ids"))
    kind = dict(base.dtypes)["key"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared.value.encoder()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                piece = batch.slice(at, 256)
                texts = [encoder.decode([t for t in row or [] if t is not None]) for row in piece.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([piece.column("key"), pa.array(texts, pa.string())], ["key", "decoded"])

    return base.mapInArrow(run, f"key {kind}, decoded string").withColumnRenamed("key", key)


def round_trip(docs: DataFrame, spec: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_tokens, ids_sha256, decoded_sha256``: ``encode`` and ``decode`` in one
    task, with hashes of the ids and of the decoded text instead of the values.

    The rules for nulls, empty texts and repeated rows are those of ``encode``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Shared(spec))
    base = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = dict(base.dtypes)["key"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared.value.encoder()
        for batch in batches:
            for piece in words.pieces(batch, "text"):
                split = [encoder.split(t or "") for t in piece.column("text").to_pylist()]
                encoder.prepare_strings(split)
                counts, ids, texts = [], [], []
                for text_words in split:
                    joined = " ".join(map(encoder.known_ids.__getitem__, text_words))
                    decoded = " ".join(map(encoder.known_text.__getitem__, text_words))
                    counts.append(joined.count(" ") + 1 if joined else 0)
                    ids.append(sha256(joined.encode()).hexdigest())
                    texts.append(sha256(decoded.encode()).hexdigest())
                encoder.forget_long()
                yield pa.RecordBatch.from_arrays(
                    [piece.column("key"), pa.array(counts, pa.int64()), pa.array(ids), pa.array(texts)],
                    ["key", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    out = base.mapInArrow(run, f"key {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("key", key)
