"""Words, hashes and windows of whole Arrow text batches with numpy.

Everything works on the UTF-8 bytes of many texts at once: a batch is one byte array with
row offsets. A null text counts as empty. Hashes are 64 bit and depend on content only.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 2_000_000

_U = np.uint64
_BYTE_BASE = 0x9E3779B97F4A7C15
_WORD_BASE = 0xC2B2AE3D27D4EB4F
_SECOND_BASE = 0xD6E8FEB86659FD93

# Byte classes: what belongs to a word.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_BYTE_CODES = np.random.default_rng(20240607).integers(0, 2**64, 256, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64 bit values."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


@lru_cache(maxsize=8)
def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(size, base, np.uint64), np.full(size, pow(base, -1, 2**64), np.uint64)
    up[:1] = down[:1] = 1
    return np.cumprod(up), np.cumprod(down)


def powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``base`` and of its inverse modulo 2^64, ``size`` at least (kept by size class, but for very long texts)."""
    room = 1 << max(12, int(size).bit_length())
    return _powers(base, room) if room <= 1 << 22 else _powers.__wrapped__(base, size)


def prefix_hash(codes: np.ndarray, base: int) -> np.ndarray:
    out = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * powers(base, len(codes) + 1)[0][: len(codes)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, stop: np.ndarray, base: int) -> np.ndarray:
    """Hash of each ``[start, stop)``; equal content gives equal values wherever it stands."""
    return mix((prefix[stop] - prefix[start]) * powers(base, len(prefix))[1][start] + (stop - start).astype(np.uint64))


def window_hash(prefix: np.ndarray, size: int, base: int) -> np.ndarray:
    """As :func:`span_hash` for the windows of ``size`` at every start."""
    count = max(0, len(prefix) - size)
    return mix((prefix[size:] - prefix[:count]) * powers(base, len(prefix))[1][:count] + _U(size))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary array and its row offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary()
    array = pc.fill_null(column.cast(kind), pa.scalar(b"", kind))
    offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset: array.offset + len(array) + 1]
    buffer = array.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    return data[offsets[0]: offsets[-1]], offsets - offsets[0]


def pieces(batches: Iterator[pa.RecordBatch], column: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut so that the texts of one hold ``limit`` bytes at most, or are a single row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(sizes)
        low = 0
        while low < batch.num_rows:
            before = ends[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(low, high - low)
            low = high


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


class Words:
    """The words of a batch: byte spans, and per row the range of its words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray):
        inside = word_bytes[data]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        filled = offsets[:-1] < offsets[1:]
        heads, tails = offsets[:-1][filled], offsets[1:][filled] - 1
        first[heads], last[tails] = inside[heads], inside[tails]
        self.data, self.offsets = data, offsets
        self.start, self.stop = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.rows = np.searchsorted(self.start, offsets)

    def __len__(self) -> int:
        return len(self.start)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.rows)

    def hashes(self) -> np.ndarray:
        prefix = prefix_hash(_BYTE_CODES[self.data], _BYTE_BASE)
        return span_hash(prefix, self.start, self.stop, _BYTE_BASE)

    def heads(self, sizes: tuple[int, ...]) -> list[np.ndarray]:
        """Hashes of the first bytes of each word, per size; a shorter word gives the hash of itself."""
        prefix = prefix_hash(_BYTE_CODES[self.data], _BYTE_BASE)
        return [span_hash(prefix, self.start, np.minimum(self.stop, self.start + k), _BYTE_BASE) for k in sizes]


def byte_codes(data: np.ndarray) -> np.ndarray:
    return _BYTE_CODES[data]


def sequence_prefix(hashes: np.ndarray) -> np.ndarray:
    return prefix_hash(hashes, _WORD_BASE)


def sequence_hash(prefix: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    return span_hash(prefix, start, stop, _WORD_BASE)


def second_prefix(hashes: np.ndarray) -> np.ndarray:
    """A prefix hash to another base, for a second, independent 64 bits."""
    return prefix_hash(mix(hashes ^ _U(0xA5A5A5A5A5A5A5A5)), _SECOND_BASE)


def second_hash(prefix: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    return span_hash(prefix, start, stop, _SECOND_BASE)


def row_of(rows: np.ndarray) -> np.ndarray:
    """For row ranges ``rows``, the row of every element."""
    return np.repeat(np.arange(len(rows) - 1), np.diff(rows))


def ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """``start[i], start[i] + 1, ...`` with ``count[i]`` values for every i, in one array."""
    total = int(count.sum())
    ends = np.cumsum(count)
    return np.arange(total) - np.repeat(ends - count - start, count)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def lists(values: pa.Array | np.ndarray, counts: np.ndarray) -> pa.ListArray:
    """A list column with ``counts[i]`` of the values in row i."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), values if isinstance(values, pa.Array) else pa.array(values))
