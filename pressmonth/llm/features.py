"""Hashed word and character n-gram features of Arrow batches, and the linear models over them.

Three streams of n-grams are hashed into buckets of their own: characters (runs of 3 and 4 UTF-8 bytes), words (one and
two), and word shapes (runs of three; case, digits, symbols, and whether the word repeats the one before).  A text's
value of a bucket is its share of the stream, so a linear model's score is the mean weight of a text's n-grams: one
look-up an n-gram, no matter how long the text.  Models are fitted on a bounded sample with plain numpy.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressmonth.llm.arrays import mix, slices, text_bytes, words
from pressmonth.llm.staging import staged, widened

BUCKETS = 1 << 13  # of each kind of n-gram
STEPS, RUN_ROWS, DECAY = 200, 256, 0.2
KINDS = ("char3", "char4", "word1", "word2", "shape3")


def _pair(first: range, second: range) -> np.ndarray:
    """A table by byte whose running sum counts two kinds of bytes at once, in the lower and the upper half."""
    table = np.zeros(256, np.int64)
    table[first], table[second] = 1, 1 << 32
    return table


_CASE = _pair(range(65, 91), range(97, 123))  # upper, lower
_OTHER = _pair(range(128, 256), range(48, 58))  # beyond ASCII, digits


def _counts(table: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sums = np.zeros(len(data) + 1, np.int64)
    np.cumsum(table[data], out=sums[1:])
    both = sums[end] - sums[start]
    return both & 0xFFFFFFFF, both >> 32


def ngrams(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, bucket) of every n-gram, one pair of arrays a kind; buckets of the kinds do not overlap."""
    sizes = np.diff(offsets)
    wide = data.astype(np.uint64)
    value = wide[: max(0, len(data) - 2)] * np.uint64(257 * 257)
    value += wide[1 : 1 + len(value)] * np.uint64(257)
    value += wide[2 : 2 + len(value)]
    for kind, size in enumerate((3, 4)):
        if size == 4:
            value = value[: max(0, len(data) - 3)] * np.uint64(257)
            value += wide[3 : 3 + len(value)]
        whole = np.ones(len(data), bool)  # not across the end of a text
        for short in range(1, size):
            whole[offsets[1:][sizes >= short] - short] = False
        rows = np.repeat(np.arange(len(sizes)), np.maximum(sizes - size + 1, 0))
        yield rows, _bucket(value[whole[: len(value)]], kind)
    found = words(data, offsets)
    yield found.row, _bucket(found.hash, 2)
    pairs = np.flatnonzero(found.row[:-1] == found.row[1:])
    yield found.row[pairs], _bucket(found.hash[pairs] * np.uint64(3) + mix(found.hash[pairs + 1], 1), 3)
    upper, lower = _counts(_CASE, data, found.start, found.end)
    high, digit = _counts(_OTHER, data, found.start, found.end)
    size = found.end - found.start
    mark = size - upper - lower - high - digit
    same = np.zeros(len(size), np.int64)
    same[1:] = (found.hash[1:] == found.hash[:-1]) & (found.row[1:] == found.row[:-1])
    shape = (
        np.minimum(upper, 2) + 3 * (lower > 0) + 6 * np.minimum(mark, 3) + 24 * (digit > 0) + 48 * same
        + 96 * np.searchsorted([2, 4, 8, 16], size) + 480 * (mark == size)
    ).astype(np.uint64)
    count = max(0, len(shape) - 2)
    inside = np.flatnonzero(found.row[:count] == found.row[2:]) if count else np.zeros(0, np.int64)
    triple = (shape[inside] * np.uint64(1000) + shape[inside + 1]) * np.uint64(1000) + shape[inside + 2]
    yield found.row[inside], _bucket(triple, 4)


def _bucket(values: np.ndarray, kind: int) -> np.ndarray:
    hashed = mix(values, 31 + kind)
    hashed >>= np.uint64(45)
    hashed &= np.uint64(BUCKETS - 1)  # a power of two
    hashed += np.uint64(kind * BUCKETS)
    return hashed.view(np.int64)


def sparse_shares(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each row: its buckets and their shares."""
    rows = len(offsets) - 1
    parts: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(rows)]
    for row, bucket in ngrams(data, offsets):
        ends = np.searchsorted(row, np.arange(rows + 1))
        for r in range(rows):
            own = bucket[ends[r] : ends[r + 1]]
            if len(own):
                at, counts = np.unique(own, return_counts=True)
                parts[r].append((at, counts / len(own)))
    for own in parts:
        yield (
            np.concatenate([a for a, _ in own]) if own else np.zeros(0, np.int64),
            np.concatenate([s for _, s in own]) if own else np.zeros(0),
        )


def sample_features(docs: DataFrame, text: str, carry: list[str]) -> DataFrame:
    """The columns ``carry`` of (few) ``docs`` with ``buckets`` and ``shares``."""
    schema = widened(docs.select(*carry).schema, buckets="array<int>", shares="array<float>")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, text):
                shares = list(sparse_shares(*text_bytes(piece.column(text))))
                yield pa.RecordBatch.from_arrays(
                    [piece.column(c) for c in carry]
                    + [pa.array([a.astype(np.int32) for a, _ in shares], pa.list_(pa.int32())),
                       pa.array([s.astype(np.float32) for _, s in shares], pa.list_(pa.float32()))],
                    schema.names,
                )

    return docs.mapInArrow(run, schema)


PARTS = 8  # the sample comes to the driver in so many parts


def shuffled(ids: list) -> list[int]:
    """An order fixed by a hash of the ids (and the ids): training does not depend on the partitioning."""
    hashes = mix(np.array([zlib.crc32(str(i).encode()) for i in ids], np.uint64), 3)
    return sorted(range(len(ids)), key=lambda i: (int(hashes[i]), str(ids[i])))


def collected(features: DataFrame, key: str, flag: str) -> tuple[list, np.ndarray, Sample]:
    """(ids, flags, features) of the rows of a bounded sample, shuffled; parts become compact arrays as they come."""
    features = staged(features)
    ids, flags, parts = [], [], []
    for part in range(PARTS):
        table = features.where(F.pmod(F.xxhash64(key), F.lit(PARTS)) == part).toArrow()
        for batch in table.to_batches():
            ids += batch.column(key).to_pylist()
            flags += batch.column(flag).to_pylist()
            lengths = batch.column("buckets").value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            buckets = batch.column("buckets").flatten().to_numpy().astype(np.uint16)  # KINDS x BUCKETS fit
            parts.append((lengths, buckets, batch.column("shares").flatten().to_numpy().copy()))
        table = batch = None
        pa.default_memory_pool().release_unused()
    order = shuffled(ids)
    sample = Sample.of(parts, order)
    return [ids[i] for i in order], np.array([flags[i] for i in order]), sample


@dataclass
class Sample:
    """Collected features of a bounded sample, as compressed rows."""

    buckets: np.ndarray
    shares: np.ndarray
    first: np.ndarray  # entry at which each row begins, and the end
    scale: np.ndarray  # by bucket: shares vary as the square root of their mean

    @classmethod
    def of(cls, parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]], order: list[int]) -> Sample:
        """From (entries of each row, buckets, shares) of some rows at a time, the rows in another order.

        ``parts`` is emptied, each part as it is copied, and no other array is as long as the entries."""
        lengths = np.concatenate([np.zeros(0, np.int64), *(n for n, _, _ in parts)])
        first = np.append(0, np.cumsum(lengths[order])).astype(np.int64)
        start = np.empty(len(order), np.int64)
        start[order] = first[:-1]
        buckets, shares = np.empty(first[-1], np.uint16), np.empty(first[-1], np.float32)
        row = 0
        while parts:
            sizes, own_buckets, own_shares = parts.pop(0)
            done = 0
            for size, at in zip(sizes.tolist(), start[row : row + len(sizes)].tolist()):
                buckets[at : at + size] = own_buckets[done : done + size]
                shares[at : at + size] = own_shares[done : done + size]
                done += size
            row += len(sizes)
        sample = cls(buckets, shares, first, np.ones(len(KINDS) * BUCKETS, np.float32))
        total = np.zeros(len(sample.scale))
        for own in sample.runs():
            np.add.at(total, own.buckets, own.shares.astype(np.float64))
        sample.scale = (1 / np.sqrt(total / max(len(sample), 1) + 1e-4)).astype(np.float32)
        for own in sample.runs():
            np.multiply(own.shares, sample.scale[own.buckets], out=own.shares)  # a view of the sample's
        return sample

    def runs(self) -> Iterator[Sample]:
        """The rows in runs of RUN_ROWS: what is made for each entry lasts for a run only."""
        for start in range(0, len(self), RUN_ROWS):
            yield self.rows(start, min(start + RUN_ROWS, len(self)))

    def __len__(self) -> int:
        return len(self.first) - 1

    def rows(self, start: int, stop: int) -> Sample:
        lo, hi = self.first[start], self.first[stop]
        return Sample(self.buckets[lo:hi], self.shares[lo:hi], self.first[start : stop + 1] - lo, self.scale)

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), np.diff(self.first))

    def scores(self, weights: np.ndarray, bias: float) -> np.ndarray:
        found = [np.bincount(own.row, own.shares * weights[own.buckets], len(own)) for own in self.runs()]
        return np.concatenate([np.zeros(0), *found]) + bias

    def gradient(self, by_row: np.ndarray) -> np.ndarray:
        total, done = np.zeros(len(KINDS) * BUCKETS), 0
        if len(self) < 2 * RUN_ROWS:
            return np.bincount(self.buckets, self.shares * by_row[self.row], len(total))
        for own in self.runs():
            # entry after entry, so the sums do not depend on the runs
            np.add.at(total, own.buckets, own.shares * by_row[done + own.row])
            done += len(own)
        return total


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def descend(
    sample: Sample, slope: Callable[[np.ndarray, slice], np.ndarray], steps: int = STEPS, rate: float = 0.05, decay: float = DECAY,
    start: tuple[np.ndarray, float] | None = None, extra: Callable[[], np.ndarray] | None = None,
) -> tuple[np.ndarray, float]:
    """Weights and bias by Adam with decoupled decay over runs of the (randomly ordered) rows.

    ``slope(scores, rows)`` gives the derivative of the run's mean loss by each of its rows' scores; ``extra()`` (called
    after it) what is to be added to the run's gradient by weights and bias.
    """
    weights, bias = (np.zeros(len(KINDS) * BUCKETS), 0.0) if start is None else start
    m, v = np.zeros(len(weights) + 1), np.zeros(len(weights) + 1)
    runs = max(1, len(sample) // RUN_ROWS)
    edges = np.linspace(0, len(sample), runs + 1).astype(int)
    for step in range(1, steps + 1):
        own = slice(edges[step % runs], edges[step % runs + 1])
        part = sample.rows(own.start, own.stop)
        by_row = slope(part.scores(weights, bias), own)
        g = np.append(part.gradient(by_row), by_row.sum())
        if extra is not None:
            g += extra()
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        move = rate * (1 - step / (steps + 1)) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
        weights, bias = weights * (1 - rate * decay) - move[:-1], bias - move[-1]
    return weights, float(bias)


def platt(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """(a, b) so that sigmoid(a z + b) is calibrated for the labels y (smoothed targets, damped Newton steps)."""
    middle, spread = float(np.average(z, weights=weight)), float(np.std(z)) or 1.0
    x = (z - middle) / spread
    up, down = (weight * y).sum(), (weight * (1 - y)).sum()
    target = np.where(y > 0, (up + 1) / (up + 2), 1 / (down + 2))

    def loss(at: np.ndarray) -> float:
        s = at[0] * x + at[1]
        return float((weight * (np.logaddexp(0, s) - target * s)).sum() + 1e-3 * at[0] ** 2)

    at = np.array([1.0, np.log((up + 1) / (down + 1))])
    for _ in range(50):
        p = sigmoid(at[0] * x + at[1])
        r, h = weight * (p - target), weight * p * (1 - p)
        g = np.array([(r * x).sum() + 2e-3 * at[0], r.sum()])
        hess = np.array([[(h * x * x).sum() + 2e-3, (h * x).sum()], [(h * x).sum(), h.sum() + 1e-6]])
        move = np.linalg.solve(hess, g)
        size = 1.0
        while size > 1e-4 and loss(at - size * move) > loss(at):
            size /= 2
        at = at - size * move
        if abs(size * move).max() < 1e-7:
            break
    a = max(at[0], 1e-3) / spread
    return float(a), float(at[1] - a * middle)


@dataclass
class LinearModel:
    """Weights by bucket (already scaled) and a bias; fixed size, whatever the corpus."""

    weights: np.ndarray
    bias: float

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row."""
        return sigmoid(self.raw(data, offsets))

    def raw(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Score of each row; a kind without n-grams adds nothing."""
        rows = len(offsets) - 1
        z = np.full(rows, self.bias)
        for row, bucket in ngrams(data, offsets):
            counts = np.bincount(row, minlength=rows)
            z += np.bincount(row, self.weights[bucket], rows) / np.maximum(counts, 1)
        return z


def sample_of(labels: DataFrame, limit: int, key: str, seed: int) -> DataFrame:
    """At most ``limit`` rows, those with the least hash of their id: the same ones whatever the partitioning."""
    return labels.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key).limit(limit)


def one_label(labels: DataFrame, key: str, label: str) -> DataFrame:
    """One row (key, y) for each labelled id: null ids and labels are left out, of several labels the greatest counts."""
    y = F.col(label).cast("int")
    return labels.where(F.col(key).isNotNull() & y.isin(0, 1)).groupBy(key).agg(F.max(y).alias("y"))
