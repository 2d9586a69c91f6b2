"""Words and shingles of whole texts, worked out on the UTF-8 bytes of an Arrow column, many documents at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
MULTIPLIER = U64(0x9E3779B97F4A7C15)
# Texts are worked on in slices of about this size; one longer text makes a slice of its own.
SLICE_BYTES = 1 << 20
SHINGLE_WORDS = 5


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits depend on all input bits."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def unit(x: np.ndarray) -> np.ndarray:
    """64-bit numbers as doubles above 0 and up to 1."""
    return ((x >> U64(11)).astype(np.float64) + 1.0) * 2.0**-53


_BYTE_CODES = mix(np.arange(1, 257, dtype=U64) * MULTIPLIER)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE_CODES_LOWER = _BYTE_CODES[_LOWER]

# Words end at a blank or at one of the control characters 9 to 13.
NOT_BLANK = np.ones(256, bool)
NOT_BLANK[[32, *range(9, 14)]] = False
# Letters, digits and all bytes of characters beyond ASCII.
WORD_CHARS = np.zeros(256, bool)
WORD_CHARS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True

_powers = np.ones(1, U64)
_inverses = np.ones(1, U64)
_BASE = 0xD6E8FEB86659FD93
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, SLICE_BYTES + (1 << 16))
        for_all = np.ones(size, U64)
        for_all[1:] = U64(_BASE)
        _powers = np.multiply.accumulate(for_all)
        for_all[1:] = U64(_BASE_INVERSE)
        _inverses = np.multiply.accumulate(for_all)
    return _powers[:n], _inverses[:n]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and where each text begins, with the end of the last; a null text has no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    buffers = column.buffers()
    bounds = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if buffers[2] is None or bounds[-1] == bounds[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(buffers[2], np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def slices(batch: pa.RecordBatch, column: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose texts hold about ``size`` bytes, so that working arrays stay small whatever Spark sends."""
    if not batch.num_rows:
        return
    _, bounds = utf8(batch[column])
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + size, side="right")) - 1)
        yield batch.slice(at, to - at)
        at = to


class Words:
    """The words of some texts: ``start`` and ``end`` as bytes, ``text`` (row number) and a 64-bit ``code`` each; the
    words of row ``i`` are ``bounds[i]`` up to ``bounds[i + 1]``. Only A to Z are lower-cased."""

    def __init__(self, column: pa.Array, chars: np.ndarray = NOT_BLANK, lower: bool = True):
        data, offsets = utf8(column)
        self.data, self.offsets, self.rows = data, offsets, len(offsets) - 1
        inside = chars[data]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        firsts = offsets[:-1][offsets[:-1] < len(data)]
        begins[firsts] = inside[firsts]
        ends = inside.copy()
        ends[:-1] &= ~inside[1:]
        lasts = offsets[1:][offsets[1:] > 0] - 1
        ends[lasts] = inside[lasts]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        self.bounds = np.searchsorted(self.start, offsets)
        self.text = np.repeat(np.arange(self.rows), np.diff(self.bounds))
        powers, inverses = _power_tables(len(data) + 1)
        sums = np.zeros(len(data) + 1, U64)
        np.cumsum((_BYTE_CODES_LOWER if lower else _BYTE_CODES)[data] * powers[:-1], out=sums[1:])
        self.code = mix((sums[self.end] - sums[self.start]) * inverses[self.start])

    def __len__(self) -> int:
        return len(self.start)


_SHINGLE_FACTORS = mix(np.arange(1, SHINGLE_WORDS + 1, dtype=U64) * U64(0xA0761D6478BD642F)) | U64(1)


def shingles(words: Words, size: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all shingles in text order and the bounds of each text's: up to five words running, or the whole text when
    it has fewer; none without words."""
    counts = np.diff(words.bounds)
    n = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    bounds = np.concatenate([[0], np.cumsum(n)])
    at = np.arange(bounds[-1]) - np.repeat(bounds[:-1], n) + np.repeat(words.bounds[:-1], n)
    have = np.repeat(np.minimum(counts, size), n)
    codes = have.astype(U64)
    last = max(len(words) - 1, 0)
    for k in range(size):
        part = words.code[np.minimum(at + k, last)] * _SHINGLE_FACTORS[k] if len(at) else codes
        codes = codes + np.where(k < have, part, U64(0))
    return mix(codes), bounds


def shingle_sets(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle codes of each text, ascending, and the bounds of each text's."""
    codes, bounds = shingles(words)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        codes[a:b].sort()
    fresh = np.ones(len(codes), bool)
    fresh[1:] = codes[1:] != codes[:-1]
    fresh[bounds[:-1][bounds[:-1] < len(codes)]] = True
    kept = np.concatenate([[0], np.cumsum(fresh)])
    return codes[fresh], kept[bounds]


def fixed_binary(values: np.ndarray) -> pa.Array:
    """One binary value per row of a two-dimensional array."""
    values = np.ascontiguousarray(values)
    width = values.shape[1] * values.itemsize
    bounds = np.arange(len(values) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(values), [None, pa.py_buffer(bounds), pa.py_buffer(values.tobytes())])


def lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values))


def over_batches(work: Callable[[pa.RecordBatch], pa.RecordBatch]) -> Callable:
    """For ``mapInArrow``: ``work`` on slices of each batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield work(part)

    return run
