"""Patched frame-of-reference blocks of whole numbers, as bytes; used inside tasks.

A block holds up to ``BLOCK`` numbers. Its least number is subtracted, the differences
are packed with the width that a stated percentile of them fits, and the high bits of
the others follow in an exception list of (place, high bits) with which the packed low
bits are patched. Layout of a block, little-endian:

    least u32 | numbers u16 | width u8 | 0 u8 | exceptions u16
    packed 64-bit words, number k at bit k * width of the block
    places u16 for each exception | high bits u32 for each exception
"""

from __future__ import annotations

import struct

import numpy as np

BLOCK = 1024
#: Share of a block's differences, in percent, that the width must fit.
PERCENTILE = 98
_HEAD = "<IHBBH"
_HEAD_SIZE = struct.calcsize(_HEAD)


def _shifts(width: int):
    """Word and shift of each of the 64 numbers that fill ``width`` 64-bit words."""
    for k in range(64 if width else 0):
        yield k, *divmod(k * width, 64)


def _packed(rows: np.ndarray, width: int) -> np.ndarray:
    """Rows of ``BLOCK`` numbers below 2^width as rows of 64-bit words."""
    groups = rows.reshape(len(rows), BLOCK // 64, 64)
    out = np.zeros((len(rows), BLOCK // 64, width), np.uint64)
    for k, word, shift in _shifts(width):
        out[:, :, word] |= groups[:, :, k] << np.uint64(shift)
        if shift + width > 64:
            out[:, :, word + 1] |= groups[:, :, k] >> np.uint64(64 - shift)
    return out.reshape(len(rows), -1)


def _unpacked(words: np.ndarray, width: int) -> np.ndarray:
    """The inverse of ``_packed``."""
    groups = words.reshape(len(words), BLOCK // 64, width)
    out = np.zeros((len(words), BLOCK // 64, 64), np.uint64)
    mask = np.uint64((1 << width) - 1)
    for k, word, shift in _shifts(width):
        value = groups[:, :, word] >> np.uint64(shift)
        if shift + width > 64:
            value = value | (groups[:, :, word + 1] << np.uint64(64 - shift))
        out[:, :, k] = value & mask
    return out.reshape(len(words), -1)


def encode(values: np.ndarray) -> list[bytes]:
    """Blocks of ``values`` (below 2^32); only the last may hold fewer than ``BLOCK``."""
    n = -(-len(values) // BLOCK)
    rows = np.zeros((n, BLOCK), np.uint64)
    rows.reshape(-1)[: len(values)] = values
    counts = np.full(n, BLOCK)
    if n and len(values) % BLOCK:
        counts[-1] = len(values) % BLOCK
        rows[-1, counts[-1] :] = rows[-1, : counts[-1]].min()
    least = rows.min(axis=1)
    rows -= least[:, None]
    bits = np.frexp(rows.astype(np.float64))[1]
    fit = BLOCK * PERCENTILE // 100
    widths = np.partition(bits, fit, axis=1)[:, fit] if n else bits[:, :0]
    out: list[bytes] = [b""] * n
    for width in np.unique(widths):
        which = np.flatnonzero(widths == width)
        part = rows[which]
        words = _packed(part & np.uint64((1 << int(width)) - 1), int(width)).astype("<u8")
        odd = bits[which] > width
        for at, k in enumerate(which):
            places = np.flatnonzero(odd[at])
            high = (part[at, places] >> np.uint64(width)).astype("<u4")
            used = -(-int(counts[k]) * int(width) // 64)
            head = struct.pack(_HEAD, int(least[k]), int(counts[k]), int(width), 0, len(places))
            out[k] = b"".join((head, words[at, :used].tobytes(), places.astype("<u2").tobytes(), high.tobytes()))
    return out


def decode(data: bytes | memoryview, starts: np.ndarray) -> np.ndarray:
    """The numbers of the blocks that begin at ``starts``, one after another."""
    heads = [struct.unpack_from(_HEAD, data, int(s)) for s in starts]
    out = np.zeros((len(heads), BLOCK), np.uint64)
    by_width: dict[int, list[int]] = {}
    for k, head in enumerate(heads):
        by_width.setdefault(head[2], []).append(k)
    for width, which in by_width.items():
        words = np.zeros((len(which), BLOCK * width // 64), np.uint64)
        for at, k in enumerate(which):
            used = -(-heads[k][1] * width // 64)
            words[at, :used] = np.frombuffer(data, "<u8", used, int(starts[k]) + _HEAD_SIZE)
        out[which] = _unpacked(words, width)
    for k, (least, count, width, _, odd) in enumerate(heads):
        if odd:
            at = int(starts[k]) + _HEAD_SIZE + 8 * -(-count * width // 64)
            places = np.frombuffer(data, "<u2", odd, at)
            out[k, places] |= np.frombuffer(data, "<u4", odd, at + 2 * odd).astype(np.uint64) << np.uint64(width)
        out[k] += np.uint64(least)
    counts = np.array([h[1] for h in heads], dtype=np.int64)
    return out.reshape(-1)[(np.arange(BLOCK)[None, :] < counts[:, None]).reshape(-1)].astype(np.uint32)
