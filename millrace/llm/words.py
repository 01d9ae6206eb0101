"""Words of Arrow text columns as hashes in numpy arrays; used inside tasks.

Words are runs of bytes other than space and 0x09-0x0D. Hashes depend on the bytes
alone, so every executor and every run gives the same values.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are worked on at a time; the arrays take about 100 times that.
PIECE_BYTES = 2_000_000
#: Bytes hashed with one table of powers; a longer word is hashed by itself.
BLOCK_BYTES = 1 << 19

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_TABLES: dict[str, np.ndarray] = {}


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit numbers in which every input bit reaches every output bit."""
    x = x ^ np.uint64((int(seed) * 0xD6E8FEB86659FD93) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def pieces(batch: pa.RecordBatch, column: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``limit`` bytes of text each, one row at least."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes.astype(np.int64))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after another, and where each begins (and the end)."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    if data is None or not len(offsets) or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each word begins and ends; no word crosses two texts."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    first = edge[:-1].copy()
    first[0] = True
    first[1:] |= ~inside[:-1]
    last = edge[1:].copy()
    last[-1] = True
    last[:-1] |= ~inside[1:]
    return np.flatnonzero(inside & first), np.flatnonzero(inside & last) + 1


def _powers() -> tuple[np.ndarray, np.ndarray]:
    if not _TABLES:
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            table = np.full(BLOCK_BYTES + 1, base, dtype=np.uint64)
            table[0] = 1
            _TABLES[name] = np.cumprod(table, dtype=np.uint64)
    return _TABLES["up"], _TABLES["down"]


def word_hashes(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each word of all texts, and where each text's words begin (and the end).

    With ``lower`` the letters A-Z count as a-z.
    """
    data, offsets = text_bytes(texts)
    starts, ends = bounds(data, offsets)
    out = np.zeros(len(starts), np.uint64)
    up, down = _powers()
    at = 0
    while at < len(starts):
        begin = starts[at]
        stop = max(at + 1, int(np.searchsorted(ends, begin + BLOCK_BYTES, side="right")))
        block = data[begin : ends[stop - 1]]
        if lower:
            block = np.where((block >= 65) & (block <= 90), block + np.uint8(32), block)
        if len(block) > BLOCK_BYTES:
            out[at] = int.from_bytes(hashlib.blake2b(block.tobytes(), digest_size=8).digest(), "little")
        else:
            sums = np.zeros(len(block) + 1, np.uint64)
            np.cumsum((block.astype(np.uint64) + np.uint64(1)) * up[: len(block)], out=sums[1:])
            a, b = starts[at:stop] - begin, ends[at:stop] - begin
            out[at:stop] = mix((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64))
        at = stop
    return out, np.searchsorted(starts, offsets)


def rolling(hashes: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """Rabin-Karp hash of every run of ``width`` hashes; runs may cross texts."""
    n = max(0, len(hashes) - width + 1)
    out = np.zeros(n, np.uint64)
    base = np.uint64((_BASE * (2 * int(seed) + 1)) & 0xFFFFFFFFFFFFFFFF)
    for k in range(width):
        out *= base
        out += hashes[k : k + n]
    return mix(out, seed)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` values in a row."""
    out, have = values, 1
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def inside(n: int, offsets: np.ndarray, width: int) -> np.ndarray:
    """For each of n runs of ``width`` words, the text that holds it wholly, or -1."""
    starts, stops = offsets[:-1], np.maximum(offsets[1:] - width + 1, offsets[:-1])
    out = np.full(n, -1, np.int64)
    lengths = stops - starts
    text = np.repeat(np.arange(len(starts)), lengths)
    position = np.arange(len(text)) - np.repeat(np.cumsum(lengths) - lengths, lengths) + np.repeat(starts, lengths)
    out[position] = text
    return out


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, and where each set begins.

    Letters A-Z count as a-z. A text with fewer words than ``width`` has its whole
    sequence as its one shingle; a text without words has an empty set.
    """
    hashes, offsets = word_hashes(texts, lower=True)
    runs = rolling(hashes, width)
    sets = []
    for a, b in zip(offsets[:-1], offsets[1:]):
        if b - a >= width:
            sets.append(np.unique(runs[a : b - width + 1]))
        elif b > a:
            sets.append(rolling(hashes[a:b], b - a, seed=int(b - a)))
        else:
            sets.append(hashes[:0])
    lengths = np.array([len(s) for s in sets], dtype=np.int64)
    return (np.concatenate(sets) if sets else hashes[:0]), np.concatenate([[0], np.cumsum(lengths)])
