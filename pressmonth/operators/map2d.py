"""A map of articles: their place on the two main axes of the embeddings.

Tasks add up products of components (whole numbers, floor(2^10 x)), and one grouped sum gives the covariance: as many
numbers as the vectors' width squared, however many articles there are.  The axes come from a stated number of power
iterations on that small matrix, in whole numbers as well, so any engine gets the same axes: the first starts at the
column of the component that varies most, the second at that of the next one and is set square to the first in every
step.  The largest component of an axis (the first of equal ones) is positive.  How far the axes are from eigenvectors
is told by :func:`residual`; axes of nearly equal weight need more iterations.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, UNIT, WEIGHT = 1 << 10, 1 << 20, 1 << 30  # of components, axes and covariances
STEPS = 30


@dataclass
class Moments:
    """Number of vectors, sums of their components and of the products of any two."""

    n: int
    sums: list[int]
    products: list[list[int]]

    def covariance(self) -> list[list[int]]:
        """n^2 times the covariance."""
        width = range(len(self.sums))
        return [[self.n * self.products[i][j] - self.sums[i] * self.sums[j] for j in width] for i in width]


def moments(news: DataFrame) -> Moments:
    def add_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = [np.floor(np.array(v, np.float64) * SCALE).astype(np.int64) for v in batch.column(0).to_pylist()]
            for width in {len(v) for v in vectors}:
                x = np.stack([v for v in vectors if len(v) == width])
                x = np.hstack([np.ones((len(x), 1), np.int64), x])  # so that counts and sums are products too
                i, j = np.triu_indices(width + 1)
                yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array((x.T @ x)[i, j])], ["i", "j", "total"])

    found = news.filter("embedding IS NOT NULL").select("embedding").mapInArrow(add_up, "i bigint, j bigint, total bigint")
    totals = {(r["i"], r["j"]): int(r["total"]) for r in found.groupBy("i", "j").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    ).collect()}  # width squared, whatever the number of articles
    width = max((j for _, j in totals), default=0)
    get = lambda i, j: totals.get((min(i, j), max(i, j)), 0)
    return Moments(get(0, 0), [get(0, j) for j in range(1, width + 1)], [
        [get(i, j) for j in range(1, width + 1)] for i in range(1, width + 1)
    ])


def _cut(a: int, b: int) -> int:
    """a / b without its fraction."""
    return abs(a) // abs(b) * (1 if (a < 0) == (b < 0) else -1)


def _dot(a: list[int], b: list[int]) -> int:
    return sum(x * y for x, y in zip(a, b))


def _unit(v: list[int]) -> list[int]:
    largest = max(map(abs, v), default=0)
    return [_cut(x * UNIT, largest) for x in v] if largest else [0] * len(v)


def _square_to(v: list[int], axis: list[int] | None) -> list[int]:
    if not axis or not any(axis):
        return v
    along, length = _dot(v, axis), _dot(axis, axis)
    return [x - _cut(along * a, length) for x, a in zip(v, axis)]


def principal_axes(found: Moments, steps: int = STEPS) -> list[list[int]]:
    """Two axes as whole numbers, the largest component 2^20; zeros where nothing varies."""
    covariance = found.covariance()
    width = len(covariance)
    largest = max((abs(x) for row in covariance for x in row), default=0)
    if not largest:
        return [[0] * width, [0] * width]
    matrix = [[_cut(x * WEIGHT, largest) for x in row] for row in covariance]
    varied = sorted(range(width), key=lambda i: (-matrix[i][i], i))
    axes: list[list[int]] = []
    for number in range(min(2, width)):
        before = axes[0] if axes else None
        axis = _unit(_square_to(matrix[varied[number]], before))
        for _ in range(steps):
            axis = _unit(_square_to([_dot(row, axis) for row in matrix], before))
        peak = max(range(width), key=lambda i: (abs(axis[i]), -i))
        axes.append([-x for x in axis] if axis[peak] < 0 else axis)
    return [*axes, *[[0] * width] * (2 - len(axes))]


def residual(found: Moments, axis: list[int]) -> tuple[float, float]:
    """Variance along an axis, and how much of the covariance's image of the axis points elsewhere (0 to 1)."""
    c = np.array(found.covariance(), float) / max(found.n, 1) ** 2 / SCALE**2
    v = np.array(axis, float)
    if not v.any():
        return 0.0, 0.0
    v /= np.linalg.norm(v)
    image = c @ v
    return float(v @ image), float(np.linalg.norm(image - v * (v @ image)) / max(np.linalg.norm(image), 1e-300))


def map_2d(news: DataFrame, steps: int = STEPS) -> DataFrame:
    """Articles with embedding (id) and their place, measured from the mean article."""
    found = moments(news)
    vectors = news.filter("embedding IS NOT NULL").select(
        "id", F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE)).alias("vector")
    )
    if not found.sums:
        return vectors.select("id", F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
    places = []
    for name, axis in zip("xy", principal_axes(found, steps)):
        weights = F.array(*[F.lit(a).cast("bigint") for a in axis])
        products = F.zip_with("vector", weights, lambda v, a: F.coalesce(v, F.lit(0)) * F.coalesce(a, F.lit(0)))
        along = F.aggregate(products, F.lit(0).cast("bigint"), lambda acc, p: acc + p)
        middle = _dot(axis, found.sums) // found.n
        length = SCALE * math.sqrt(_dot(axis, axis))
        places.append(((along - F.lit(middle)) / F.lit(length or 1.0)).alias(name))
    return vectors.select("id", *places)
