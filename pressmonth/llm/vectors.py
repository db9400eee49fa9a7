"""Vectors as whole numbers: which rows take part, scaled components, matrices inside tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

_EXACT = 1 << 53


def usable(vector: Column) -> Column:
    """Not null, and without null, NaN or infinite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def whole(vector: Column, scale: int, limit: int) -> Column:
    """floor(scale * x) of every component x, held within +-``limit``."""
    return F.transform(
        vector, lambda x: F.floor(F.greatest(F.least(x.cast("double") * scale, F.lit(float(limit))), F.lit(float(-limit)))).cast("int")
    )


def matrix(vectors: pa.Array | pa.ChunkedArray, width: int = 0) -> np.ndarray:
    """Rows of a list column as int64, filled up with zeros to the longest or to ``width``."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values = vectors.flatten().to_numpy(zero_copy_only=False)
    width = max(width, int(lengths.max(initial=0)))
    if len(lengths) and (lengths == width).all():
        return values.astype(np.int64).reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of ``a`` with the rows of ``b``."""
    width = min(a.shape[1], b.shape[1])  # missing components are zeros
    a, b = a[:, :width], b[:, :width]
    if int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * width < _EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances between the rows of ``a`` and ``b`` (of equal width)."""
    return (a * a).sum(axis=1)[:, None] - 2 * products(a, b) + (b * b).sum(axis=1)[None, :]
