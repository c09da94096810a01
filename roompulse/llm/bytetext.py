"""Whole-batch text work on the UTF-8 buffer of an Arrow string column, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19
_ODD = np.uint64(0x9E3779B97F4A7C15)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all rows and the n + 1 offsets between them; NULL counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    data = column.buffers()[2]
    data = np.empty(0, np.uint8) if data is None else np.frombuffer(data, dtype=np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def binaries(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """One binary value per stretch of an array between neighbouring bounds, over the array's own bytes.

    (An Arrow array made from memory views would keep a reference to the whole array for ever.)
    """
    item = data.dtype.itemsize
    kind, wide = (pa.binary(), np.int32) if data.nbytes < 1 << 31 else (pa.large_binary(), np.int64)
    offsets = np.ascontiguousarray(bounds * item, dtype=wide)
    return pa.Array.from_buffers(kind, len(bounds) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes; a longer row stands alone."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of an odd multiplier modulo 2**64 and their inverses, grown as needed."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) <= n:
            size = max(n + 1, SLICE_BYTES + 1)
            for name, base in (("up", self.base), ("down", self.inverse)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up, self.down


_POWERS = Powers(0x8F14E45FCEEA1A6D)
_LETTERS = mix(np.arange(256, dtype=np.uint64) + _ODD)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span, from prefix sums of a polynomial."""
    up, down = _POWERS.upto(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_LETTERS[data] * up[:len(data)], out=sums[1:])
    spans = (sums[ends] - sums[starts]) * down[starts]
    return mix(spans + (ends - starts).astype(np.uint64) * _ODD)


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """``span_hashes`` of all spans of one size, in order."""
    count = len(data) - size + 1
    up, down = _POWERS.upto(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_LETTERS[data] * up[:len(data)], out=sums[1:])
    spans = sums[size:] - sums[:count]
    spans *= down[:count]
    spans += np.uint64(size * int(_ODD) & (1 << 64) - 1)
    return mix(spans)


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def words(data: np.ndarray, offsets: np.ndarray, letters: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and each row's first word.

    ``letters`` tells which of the 256 byte values belong to words; by default all but white space
    (0x20, 0x09 to 0x0D). Words don't cross rows.
    """
    inside = (~_SPACE if letters is None else letters)[data]
    before = np.empty_like(inside)
    if len(inside):
        before[0] = False
        before[1:] = inside[:-1]
    cuts = offsets[1:-1]
    cuts = cuts[cuts < len(data)]
    before[cuts] = False
    starts = np.flatnonzero(inside & ~before)
    stop = np.zeros(len(data) + 1, bool)
    stop[1:-1] = inside[:-1] & ~(inside[1:] & before[1:]) if len(data) else False
    if len(data):
        stop[-1] = inside[-1]
    ends = np.flatnonzero(stop)
    return starts, ends, np.searchsorted(starts, offsets)


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lower(data: np.ndarray) -> np.ndarray:
    """A to Z in lower case, all other bytes as they are."""
    return _LOWER[data]


def ragged(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The indexes first[i], first[i] + 1, ... (count[i] of them) for all i, in one array."""
    total = int(count.sum())
    if not total:
        return np.empty(0, np.int64)
    ends = np.cumsum(count)
    return np.arange(total) + np.repeat(first - (ends - count), count)
