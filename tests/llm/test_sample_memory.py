"""The classifiers' sample on the driver: no array but the sample's own is as long as its entries."""

import tracemalloc

import numpy as np
import pyarrow as pa

from pressmonth.llm import toxicity
from pressmonth.llm.features import BUCKETS, KINDS, RUN_ROWS, Sample

SIZE = len(KINDS) * BUCKETS


def _parts(rows: int, entries: int) -> tuple[list, list[int]]:
    rng = np.random.default_rng(5)
    parts = []
    for part in np.array_split(np.arange(rows), 8):
        lengths = rng.integers(0, 2 * entries, len(part))
        n = int(lengths.sum())
        parts.append((lengths, rng.integers(0, SIZE, n).astype(np.uint16), rng.random(n).astype(np.float32)))
    return parts, rng.permutation(rows).tolist()


def test_runs_give_what_whole_arrays_give():
    parts, order = _parts(4 * RUN_ROWS + 3, 20)
    rows = [x for n, b, s in parts for x in zip(np.split(b, np.cumsum(n)[:-1]), np.split(s, np.cumsum(n)[:-1]))]
    buckets = np.concatenate([rows[i][0] for i in order])
    shares = np.concatenate([rows[i][1] for i in order])
    scale = (1 / np.sqrt(np.bincount(buckets, shares, SIZE) / len(order) + 1e-4)).astype(np.float32)
    sample = Sample.of(parts, order)
    row = np.repeat(np.arange(len(order)), [len(rows[i][0]) for i in order])
    assert np.array_equal(sample.buckets, buckets) and np.array_equal(sample.scale, scale)
    assert np.array_equal(sample.shares, shares * scale[buckets])
    weights, by_row = np.random.default_rng(6).normal(size=(2, SIZE))
    by_row = by_row[: len(order)]
    assert np.array_equal(sample.scores(weights, 0.5), np.bincount(row, sample.shares * weights[buckets], len(order)) + 0.5)
    assert np.array_equal(sample.gradient(by_row), np.bincount(buckets, sample.shares * by_row[row], SIZE))
    assert np.array_equal(sample.rows(3, 9).gradient(by_row[3:9]), np.bincount(
        buckets[sample.first[3] : sample.first[9]], sample.shares[sample.first[3] : sample.first[9]] * by_row[row][sample.first[3] : sample.first[9]], SIZE))


def test_memory_beside_the_sample_does_not_follow_its_entries():
    parts, order = _parts(4000, 400)
    entries = sum(len(b) for _, b, _ in parts)
    tracemalloc.start()
    try:
        sample = Sample.of(parts, order)
        del parts
        weights, by_row = np.ones(SIZE), np.ones(len(order))
        before = tracemalloc.get_traced_memory()[0]
        tracemalloc.reset_peak()
        sample.scores(weights, 0.0)
        sample.gradient(by_row)
        assert tracemalloc.get_traced_memory()[1] - before < 8 * entries
    finally:
        tracemalloc.stop()


def test_empty_sample():
    sample = Sample.of([], [])
    assert len(sample) == 0 and len(sample.scores(np.ones(SIZE), 0.0)) == 0 and not sample.gradient(np.zeros(0)).any()


def test_toxicity_gives_back_what_came_to_the_driver(spark, monkeypatch):
    released = []
    pool = pa.default_memory_pool()

    class Pool:
        def release_unused(self):
            released.append(pool.bytes_allocated())
            pool.release_unused()

    monkeypatch.setattr(toxicity.pa, "default_memory_pool", Pool)
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet") for name in ("documents", "labels"))
    assert not isinstance(toxicity.fit(docs, labels, "toxic", "doc_id", "text"), float)
    assert released and max(released) < 1 << 20  # no table is held any more when the rest goes back
