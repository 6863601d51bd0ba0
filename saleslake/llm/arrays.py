"""Ragged numpy arrays over Arrow string columns: slices, gathers, word hashes."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1_000_000  # text handled at once; bounds a worker's memory

# Fixed values of the word hash: an odd base and a seed for one random number per byte value.
_BASE = 0x9E3779B97F4A7C15 | 5
_TABLE = np.random.default_rng(20240229).integers(0, 2**64, 256, dtype=np.uint64)
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts one after the other, and n + 1 offsets; null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``limit`` bytes each; a longer text is a range of its own."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def pieces(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in parts of one slice of text each, without a copy; what is filtered out of one is small."""
    _, offsets = text_bytes(batch.column(text))
    for low, high in slices(offsets):
        yield batch.slice(low, high - low)


def ragged_index(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of all elements of the ranges [start, start + length)."""
    total = int(lengths.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    shift = np.repeat(starts - np.cumsum(lengths) + lengths, lengths)
    return shift + np.arange(total)


def offsets_of(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _grow(n: int) -> None:
    global _powers, _inverses
    if len(_powers) <= n:
        size = max(n + 1, SLICE_BYTES + 1)
        steps = np.full(size, _BASE, np.uint64)
        steps[0] = 1
        back = np.full(size, pow(_BASE, -1, 2**64), np.uint64)
        back[0] = 1
        _powers, _inverses = np.cumprod(steps), np.cumprod(back)


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running sums from which ``span_hash`` takes the hash of any span."""
    _grow(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_TABLE[data] * _powers[: len(data)], out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[start:end]; equal bytes have equal hashes wherever they stand."""
    value = (sums[ends] - sums[starts]) * _inverses[starts]
    return mix(value + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def binary_column(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Arrow binary column over the bytes of ``data``; offsets count bytes."""
    buffers = [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
    column = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, buffers)
    return column.cast(pa.binary())
