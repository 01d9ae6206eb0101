"""Token ids of whole texts as binary files, and reading them back.

Documents are ordered over all tasks by key, encoded in that order, and written as files
of patched frame-of-reference blocks (``patched``). A file, little-endian:

    header  "MRIDS1\\0\\n" | part u32 | number in the part u32 | documents u64 | ids u64
            | blocks u64 | place of the block index u64 | place of the document table u64
    blocks  all ids of the file's documents, one after another
    index   place of each block u64: id k of the file lies in block k // 1024
    table   keys i64 | whether the key is null u8 | ids of each document u64

and a line feed that the writer of the file adds. Files sort by (part, number); a file is
closed once it has ``FILE_IDS`` ids, and no document is split. Files are written and read
by Spark's own sources, so that they may lie in any store that Spark knows, a task that
is run again replaces its file, and nothing passes through the driver.
"""

from __future__ import annotations

import gc
import re
import struct
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from millrace.llm import patched, words
from millrace.llm.bpe import byte_letters
from millrace.llm.tables import bounded, stored

#: Ids after which a file is closed.
FILE_IDS = 1 << 24
#: Ids that are packed at a time.
SEGMENT = 256 * patched.BLOCK
#: Strings whose ids a task remembers, and the longest that it does.
REMEMBERED, LONGEST_REMEMBERED = 1_200_000, 48
#: Bytes of text that are encoded at a time.
PIECE_BYTES = 6_000_000
#: Files whose starts are broadcast to be joined to their documents, at most.
BROADCAST_FILES = 200_000

_HEAD = "<8sIIQQQQQ"
_HEAD_SIZE = struct.calcsize(_HEAD)
_MAGIC = b"MRIDS1\0\n"
# Marks that never join the letters before them into one word.
_MARKS = "!\"#$%&()*+,-./:;=>?@[\\]^_`{|}~"
# str.split() splits at these too, the library doesn't.
_CONTROLS = re.compile("[\x1c-\x1f]")
_SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
# The letters in which byte-level vocabularies write bytes above ASCII.
_SPREAD = {b: c for b, c in byte_letters().items() if b > 127}


class Known(dict):
    """Ids of strings seen before, by string.

    A string of letters and marks behind them is learned when it is first looked up: its
    letters count in lower case and without the marks. Any other string gives None and
    is noted in ``lacking``, to go through the whole library.
    """

    def __init__(self, older: dict[str, bytes], library):
        self.older, self.library, self.tokenize = older, library, library.model.tokenize
        # A word has no more ids than bytes, two a letter.
        self.pack = [struct.Struct(f"<{n}I").pack for n in range(2 * LONGEST_REMEMBERED + 1)]
        self.lacking: list[str] = []

    def __missing__(self, w: str) -> bytes | None:
        older = self.older.get
        if (ids := older(w)) is None:
            core = w.rstrip(_MARKS)
            mark = w[len(core) :]
            # Of these letters all Unicode versions in use know the same.
            if len(w) > LONGEST_REMEMBERED or not core.isalpha() or max(core) >= "\u0530" or "\u0130" in core:
                self.lacking.append(w)
                return None
            if not core.isascii():
                core = unicodedata.normalize("NFC", core).replace("Σ", "σ")
            core = core.lower()
            if (ids := self.get(core) or older(core)) is None:
                ids = self._tokenized(core)
            self[core] = ids
            if mark:
                if (last := self.get(mark)) is None:
                    self[mark] = last = self.whole([mark])[0]
                ids += last
        self[w] = ids
        return ids

    def _tokenized(self, core: str) -> bytes:
        """Ids of a word, which the model wants in byte letters; ASCII letters are that already."""
        spread = core if core.isascii() else core.encode().decode("latin-1").translate(_SPREAD)
        found = [x.id for x in self.tokenize(spread)]
        return self.pack[len(found)](*found)

    def whole(self, strings: list[str]) -> list[bytes]:
        """Ids of any strings."""
        found = self.library.encode_batch_fast(strings, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in found]


class WordEncoder:
    """Encodes texts with the tokenizers library, each distinct string of a text once.

    The vocabulary drops white space and marks word ends, so a text's ids are those of
    its strings between white space. Strings are remembered within ``REMEMBERED``. The
    library's model gets words of letters as they come out of its normaliser and byte
    letters; any other string goes through the whole library.
    """

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(spec)
        self.library.no_truncation()
        self.library.no_padding()
        self.known = Known({}, self.library)

    def ids(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        if len(self.known) > REMEMBERED // 2:  # what is used again comes back from the older half
            self.known.older = {}
            self.known = Known(self.known, self.library)
        known, lacking = self.known, self.known.lacking
        look, out, open_, noted = known.__getitem__, [], [], 0
        for t in texts:
            split = (_SPACE.sub(" ", t).strip(" ").split(" ") if t else []) if _CONTROLS.search(t) else t.split()
            found = list(map(look, split))
            if len(lacking) > noted:
                noted = len(lacking)
                open_.append((len(out), split, found))
                out.append(b"")
            else:
                out.append(b"".join(found))
        new = list(set(lacking))
        lacking.clear()
        known |= zip(new, known.whole(new))
        for k, split, found in open_:
            out[k] = b"".join([known[w] if f is None else f for w, f in zip(split, found)])
        for w in new:
            if len(w) > LONGEST_REMEMBERED:
                del known[w]
        return out


class Writer:
    """Puts documents into files one after another."""

    def __init__(self, part: int):
        self.part, self.number = part, 0
        self._clear()

    def _clear(self) -> None:
        self.blocks, self.waiting, self.n_waiting, self.n_ids = [], [], 0, 0
        self.keys, self.nulls, self.sizes = [], [], []

    def _pack(self, whole: bool) -> None:
        ids = np.concatenate([np.frombuffer(w, "<u4") for w in self.waiting]) if self.waiting else np.zeros(0, "<u4")
        stop = len(ids) if whole else len(ids) // patched.BLOCK * patched.BLOCK
        for at in range(0, stop, SEGMENT):
            self.blocks += patched.encode(ids[at : min(stop, at + SEGMENT)])
        self.waiting, self.n_waiting = [ids[stop:].tobytes()], len(ids) - stop

    def add(self, key: int | None, ids: bytes) -> bytes | None:
        """A finished file, if this document has filled it."""
        self.keys.append(key or 0)
        self.nulls.append(key is None)
        self.sizes.append(len(ids) // 4)
        self.waiting.append(ids)
        self.n_waiting += len(ids) // 4
        self.n_ids += len(ids) // 4
        if self.n_waiting >= SEGMENT:
            self._pack(False)
        return self.close() if self.n_ids >= FILE_IDS else None

    def close(self) -> bytes | None:
        if not self.keys:
            return None
        self._pack(True)
        sizes = np.array([len(b) for b in self.blocks], dtype=np.int64)
        places = _HEAD_SIZE + np.cumsum(sizes) - sizes
        index = _HEAD_SIZE + int(sizes.sum())
        head = struct.pack(_HEAD, _MAGIC, self.part, self.number, len(self.keys), self.n_ids, len(sizes), index, index + 8 * len(sizes))
        table = [np.array(self.keys, "<i8").tobytes(), np.array(self.nulls, "u1").tobytes(), np.array(self.sizes, "<u8").tobytes()]
        body = b"".join([head, *self.blocks, places.astype("<u8").tobytes(), *table])
        self.number += 1
        self._clear()
        return body


class Reader:
    """A file's bytes. ``ids`` opens only the blocks it needs."""

    def __init__(self, body: bytes):
        magic, self.part, self.number, self.n_docs, self.n_ids, blocks, index, table = struct.unpack_from(_HEAD, body)
        if magic != _MAGIC:
            raise ValueError("not a file of token ids")
        self.body = body
        self.places = np.frombuffer(body, "<u8", blocks, index)
        self.keys = np.frombuffer(body, "<i8", self.n_docs, table)
        self.nulls = np.frombuffer(body, "u1", self.n_docs, table + 8 * self.n_docs).astype(bool)
        self.sizes = np.frombuffer(body, "<u8", self.n_docs, table + 9 * self.n_docs).astype(np.int64)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the file."""
        start, stop = max(0, start), min(stop, self.n_ids)
        if start >= stop:
            return np.zeros(0, np.uint32)
        first, last = start // patched.BLOCK, -(-stop // patched.BLOCK)
        found = patched.decode(self.body, self.places[first:last])
        return found[start - first * patched.BLOCK : stop - first * patched.BLOCK]


def write(docs: DataFrame, spec: str, path: str, key: str = "doc_id", text: str = "text", end_id: int | None = 1) -> None:
    """Writes the ids of every whole text in ascending order of ``key`` below ``path``.

    ``spec`` is the text of a tokenizers file; ``end_id`` follows each document (None:
    nothing does). A null text counts as empty. Rows with a null key come last; rows that
    share a key are written each, in an order that their texts decide. Other columns are
    ignored, whatever their names. A table without rows gives no file with content.
    The order is dealt out over tasks by key, then text, then row, so neither one key nor
    one repeated row has to fit into one task.
    """
    shared = docs.sparkSession.sparkContext.broadcast({"spec": spec})
    last = b"" if end_id is None else struct.pack("<I", end_id)
    base = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    base = base.withColumns({"tie": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    order = [F.col("key").asc_nulls_last(), F.col("tie"), F.col("row")]
    base = base.repartitionByRange(*order).sortWithinPartitions(*order).select("key", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A worker keeps a broadcast's value from task to task, and so what it has learned.
        made, writer = shared.value, Writer(TaskContext.get().partitionId())
        encoder = made["encoder"] = made.get("encoder") or WordEncoder(made["spec"])
        gc.disable()  # nothing here is cyclic, and the memory of strings is dear to go through
        try:
            for batch in batches:
                for piece in words.pieces(batch, "text", PIECE_BYTES):
                    found = encoder.ids(piece.column("text").to_pylist())
                    for k, ids in zip(piece.column("key").to_pylist(), found):
                        if body := writer.add(k, ids + last):
                            yield pa.RecordBatch.from_arrays([pa.array([body], pa.binary())], ["body"])
            if body := writer.close():
                yield pa.RecordBatch.from_arrays([pa.array([body], pa.binary())], ["body"])
        finally:
            gc.enable()

    files = base.mapInArrow(run, "body binary").select(F.col("body").cast("string").alias("value"))
    files.write.option("maxRecordsPerFile", 1).option("compression", "none").text(path)


def read(spark: SparkSession, path: str, ids: bool = False) -> DataFrame:
    """``part, number, key, first, n_tokens, ids_crc32`` of each document of the files.

    ``first`` counts the ids before it in its file; ``ids_crc32`` is the unsigned crc32 of
    its ids as little-endian unsigned 32-bit numbers. With ``ids`` also the ids.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path).select("content")
    more = ", ids array<int>" if ids else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body in batch.column(0):
                if len(body.as_buffer()):
                    yield from _documents(Reader(body.as_buffer().to_pybytes()), ids)

    return files.mapInArrow(run, "part long, number long, key long, first long, n_tokens long, ids_crc32 long" + more)


def _documents(file: Reader, ids: bool) -> Iterator[pa.RecordBatch]:
    ends = np.cumsum(file.sizes)
    at = 0
    while at < file.n_docs:
        before = int(ends[at] - file.sizes[at])
        stop = max(at + 1, int(np.searchsorted(ends, before + SEGMENT, side="right")))
        found = file.ids(before, int(ends[stop - 1])).astype("<u4")
        starts = ends[at:stop] - file.sizes[at:stop]
        crc = [zlib.crc32(found[a - before : b - before]) for a, b in zip(starts.tolist(), ends[at:stop].tolist())]
        n = stop - at
        columns = {
            "part": pa.array(np.full(n, file.part, np.int64)),
            "number": pa.array(np.full(n, file.number, np.int64)),
            "key": pa.array(file.keys[at:stop], mask=file.nulls[at:stop]),
            "first": pa.array(starts),
            "n_tokens": pa.array(file.sizes[at:stop]),
            "ids_crc32": pa.array(crc, pa.int64()),
        }
        if ids:
            cut = np.concatenate([[0], ends[at:stop] - before]).astype(np.int32)
            columns["ids"] = pa.ListArray.from_arrays(pa.array(cut), pa.array(found.astype(np.int32)))
        yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))
        at = stop


def positions(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """``key, start, n_tokens, ids_crc32`` of each document, ``start`` counted over all files.

    The files are opened once. Their totals, a row for each file, are added up in order;
    that table of at most a row for each task and ``FILE_IDS`` ids is the only thing that
    one task sees whole.
    """
    docs = stored(read(spark, path))
    totals = docs.groupBy("part", "number").agg(F.sum("n_tokens").alias("ids"))
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("part", "number", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("before"))
    found = docs.join(bounded(starts, BROADCAST_FILES, totals), ["part", "number"])
    return found.select(F.col("key").alias(key), (F.col("before") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")
