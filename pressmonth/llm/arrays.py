"""Words and shingles of an Arrow batch of texts as flat numpy arrays (used inside Spark tasks)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20  # texts of one numpy pass; a longer single text is a pass of its own
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_EMPTY = np.zeros(0, np.uint64)
_powers: dict[int, np.ndarray] = {}


def mix(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser; another seed gives an independent hash."""
    x = values + np.uint64((seed * 0xD1342543DE82EF95 + 0x2545F4914F6CDD1D) & (2**64 - 1))
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power(base: int, length: int) -> np.ndarray:
    have = _powers.get(base, _EMPTY)
    if len(have) < length:
        have = np.full(max(length, SLICE_BYTES), base, np.uint64)
        have[0] = 1
        np.cumprod(have, out=have)
        if length <= 2 * SLICE_BYTES:
            _powers[base] = have
    return have[:length]


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the offset of each; a null text is empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Pieces of ``batch`` whose texts hold at most ``limit`` bytes (or one row)."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    start = 0
    while start < batch.num_rows:
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop
    pa.default_memory_pool().release_unused()  # workers are reused: what a batch took goes back


@dataclass
class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a slice, in order: their row, byte range and 64-bit hash."""

    rows: int
    data: np.ndarray
    offsets: np.ndarray
    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.bincount(self.row, minlength=self.rows)


def range_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each byte range."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power(_BASE, len(data)), out=sums[1:])
    return mix((sums[end] - sums[start]) * _power(_INVERSE, len(data) + 1)[start]) if len(start) else _EMPTY


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z; all other bytes stay."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def words(data: np.ndarray, offsets: np.ndarray) -> Words:
    solid = ~((data == 32) | ((data >= 9) & (data <= 13)))
    before = np.zeros(len(data), bool)
    before[1:] = solid[:-1]
    edges = offsets[offsets < len(data)]
    before[edges] = False
    after = np.zeros(len(data), bool)
    after[:-1] = solid[1:]
    after[offsets[offsets > 0] - 1] = False
    start = np.flatnonzero(solid & ~before)
    end = np.flatnonzero(solid & ~after) + 1
    row = np.searchsorted(offsets, start, side="right") - 1
    return Words(len(offsets) - 1, data, offsets, row, start, end, range_hashes(data, start, end))


def shingles(found: Words, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct ``size``-word shingles, by row then hash; fewer words make one shingle."""
    hashed = mix(found.hash, 7)
    counts = found.counts
    if len(hashed) >= size:
        full = np.flatnonzero(found.row[: len(hashed) - size + 1] == found.row[size - 1 :])
    else:
        full = np.zeros(0, np.int64)
    values = np.zeros(len(full), np.uint64)
    factors = [np.uint64(mix(np.array([k], np.uint64), 11)[0] | np.uint64(1)) for k in range(size)]
    for k in range(size):
        values += hashed[full + k] * factors[k]
    rows = [found.row[full]]
    hashes = [mix(values)]
    firsts = np.cumsum(counts) - counts
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        values = counts[short].astype(np.uint64) * np.uint64(0xA0761D6478BD642F)
        for k in range(size - 1):
            has = counts[short] > k
            values[has] += hashed[firsts[short[has]] + k] * factors[k]
        rows.append(short)
        hashes.append(mix(values, 3))
    row, value = np.concatenate(rows), np.concatenate(hashes)
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    return row[new], value[new]


def span_sums(hashes: np.ndarray) -> np.ndarray:
    """Running sums from which :func:`span_hashes` takes the hash of any span of a sequence of hashes."""
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * _power(_BASE, len(hashes)), out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int) -> np.ndarray:
    """Hash of each span [start, end); equal sequences have equal hashes wherever they lie."""
    return mix((sums[end] - sums[start]) * _power(_INVERSE, len(sums))[start], seed) if len(start) else _EMPTY
