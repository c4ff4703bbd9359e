"""Byte-level helpers: texts of an Arrow batch as one buffer, words and hashes found with numpy.

A *chunk* is a slice of an Arrow batch whose texts hold at most a few
megabytes (one text at least).  Its texts are one ``uint8`` array plus row
offsets, so words, windows and hashes of thousands of documents come from
a handful of vector operations, and memory is bounded by the chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 4 << 20

_UPPER_TO_LOWER = np.arange(256, dtype=np.uint8)
_UPPER_TO_LOWER[ord("A"):ord("Z") + 1] += 32

#: ``[\x20\x09-\x0D]``: the white space that parts words.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


#: One pseudo-random word per byte value, by rule.
BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of a string or binary column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
        width, column = np.int32, (column if column.null_count == 0 else pc.fill_null(column, b"" if pa.types.is_binary(column.type) else ""))
    else:
        width = np.int64
        column = column if column.null_count == 0 else pc.fill_null(column, b"" if pa.types.is_large_binary(column.type) else "")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, width, n + 1, column.offset * np.dtype(width).itemsize).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def slices(batch: pa.RecordBatch, text: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Row slices of a batch with at most ``limit`` bytes of text each (a longer text is alone)."""
    _, off = text_buffer(batch.column(batch.schema.get_field_index(text)))
    start, n = 0, batch.num_rows
    while start < n:
        end = int(np.searchsorted(off, off[start] + limit, "right")) - 1
        end = min(max(end, start + 1), n)
        yield batch.slice(start, end - start)
        start = end


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _UPPER_TO_LOWER[data]


def words(data: np.ndarray, off: np.ndarray, gap: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of every maximal run of non-gap bytes; runs never cross rows."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = ~gap[data]
    before = np.empty(n, bool)
    before[0], before[1:] = False, inside[:-1]
    first = off[:-1][(off[:-1] < n) & (off[1:] > off[:-1])]
    before[first] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, inside[1:]
    after[first[first > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    rows = np.searchsorted(off, starts, "right") - 1
    return starts, ends, rows


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every byte span (spans in order, not overlapping, not empty)."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    lens = ends - starts
    total = int(lens.sum())
    first = np.cumsum(lens) - lens
    place = np.arange(total) - np.repeat(first, lens)
    longest = int(lens.max())
    power = np.full(longest, 0x9E3779B97F4A7C15 | 1, np.uint64)
    power[0] = 1
    power = np.cumprod(power)
    code = BYTE_CODE[data[place + np.repeat(starts, lens)]]
    code *= power[place]
    return mix(np.add.reduceat(code, first) + lens.astype(np.uint64))
