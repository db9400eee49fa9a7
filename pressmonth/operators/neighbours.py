"""Nearest articles of many articles at once: a hyperplane index, then exact similarities.

An article gets one bucket in each of ``tables`` tables: ``bits`` signs of its embedding against fixed planes (each
weight is +1 or -1, by the MD5 of table, bit and component, so every engine builds the same index).  Two articles at an
angle of a degrees share a bucket of one table with probability (1 - a / 180) ** bits; all candidates are compared
exactly, as products of matrices between blocks of bounded size.  A pair counts in the first table whose bucket both
share, so no list of pairs is made distinct, and of a block only the best rows of each asked article are passed on.

The defaults suit vectors with little structure, where the tenth neighbour is 70 degrees away, and compare three of
four articles; embeddings with close neighbours want more bits (12 bits find 9 of 10 neighbours within 30 degrees).
:func:`recall` measures what the index finds against a full comparison.  Articles without embedding take no part.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterable, Iterator
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .clusters import whole

TABLES, BITS = 24, 4
BLOCK_ASKED, BLOCK_ROWS = 4096, 16384  # rows of a block; more of them make more blocks
ASKED_AT_ONCE = 128
NO_LENGTH = -2.0  # stands for the missing similarity of a vector of zeros, which ranks last


def planes(tables: int, bits: int, width: int) -> np.ndarray:
    """Weights of every plane (tables * bits rows)."""
    def weight(*place: int) -> int:
        return 1 if hashlib.md5(":".join(map(str, place)).encode()).hexdigest()[0] < "8" else -1

    return np.array([[weight(t, b, i) for i in range(width)] for t in range(tables) for b in range(bits)], np.int64).reshape(tables * bits, width)


def hyperplane_index(news: DataFrame, tables: int = TABLES, bits: int = BITS) -> DataFrame:
    """(id, vector, length, buckets) of every article with an embedding; ``length`` is the squared one."""
    vectors = news.filter("embedding IS NOT NULL").select("id", whole(F.col("embedding")).alias("vector"))

    def bucketed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides: dict[int, np.ndarray] = {}
        for batch in batches:
            lists = batch.column("vector").to_pylist()
            buckets = np.zeros((len(lists), tables), np.int64)
            for width in {len(v) for v in lists}:
                own = [i for i, v in enumerate(lists) if len(v) == width]
                if width not in sides:
                    sides[width] = planes(tables, bits, width)
                x = np.array([lists[i] for i in own], np.int64).reshape(len(own), width)
                signs = (x @ sides[width].T >= 0).reshape(len(own), tables, bits)
                buckets[own] = signs @ (1 << np.arange(bits))
            places = pa.ListArray.from_arrays(pa.array(np.arange(len(lists) + 1) * tables, pa.int32()), pa.array(buckets.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("vector"), places], ["id", "vector", "buckets"])

    id_type = vectors.schema["id"].dataType.simpleString()
    found = vectors.mapInArrow(bucketed, f"id {id_type}, vector array<bigint>, buckets array<bigint>")
    return found.withColumn("length", _dot(F.col("vector"), F.col("vector")))


def _dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: F.coalesce(x * y, F.lit(0)))
    return F.aggregate(products, F.lit(0).cast("bigint"), lambda acc, p: acc + p)


def _matrix(lists: pa.ChunkedArray, width: int) -> np.ndarray:
    """The vectors as rows, zero where a component is missing."""
    sizes = pc.list_value_length(lists).to_numpy().astype(np.int64)
    flat = pc.list_flatten(lists).fill_null(0).to_numpy()
    rows = np.zeros((len(sizes), width), np.int64)
    rows[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return rows


def _rounded(values: np.ndarray) -> np.ndarray:
    """Values to six digits, halves away from zero, as Spark rounds their decimal form."""
    distinct, place = np.unique(values, return_inverse=True)
    digits = [float(Decimal(repr(v)).quantize(Decimal("1e-6"), ROUND_HALF_UP)) for v in distinct.tolist()]
    return np.array(digits, float)[place]


def _best_of_block(top: int, by_bucket: bool) -> Callable[[tuple, pa.Table, pa.Table], pa.Table]:
    """The ``top`` best rows of a block for every asked one in it, before the similarities are rounded; a few asked
    ones at a time are compared with the whole block."""

    def best(key: tuple, asked: pa.Table, others: pa.Table) -> pa.Table:
        width = max(pc.max(pc.list_value_length(t["vector"])).as_py() or 0 for t in (asked, others))
        x, y = _matrix(asked["vector"], width), _matrix(others["vector"], width)
        x_length, y_length = (t["length"].to_numpy().astype(float) for t in (asked, others))
        # no sum of products exceeds the product of the lengths, so below 2^53 doubles hold it exactly
        if math.sqrt(x_length.max()) * math.sqrt(y_length.max()) < 2.0**53:
            x, y = x.astype(float), y.astype(float)
        order = np.unique(np.concatenate([t["id"].to_numpy() for t in (asked, others)]), return_inverse=True)[1]
        x_id, y_id = order[: len(asked)], order[len(asked) :]
        earlier = []
        if by_bucket:  # a pair belongs to the first table whose bucket both share
            x_bucket, y_bucket = (_matrix(t["buckets"], pc.max(pc.list_value_length(t["buckets"])).as_py()) for t in (asked, others))
            earlier = range(key[0].as_py())
        found = []
        for at in range(0, len(asked), ASKED_AT_ONCE):
            own = slice(at, at + ASKED_AT_ONCE)
            lengths = np.sqrt(x_length[own])[:, None] * np.sqrt(y_length)
            with np.errstate(divide="ignore", invalid="ignore"):
                similarity = np.where(lengths > 0, (x[own] @ y.T).astype(float) / lengths, NO_LENGTH)
            other = x_id[own][:, None] != y_id
            for table in earlier:
                other &= x_bucket[own, table][:, None] != y_bucket[:, table]
            similarity[~other] = -np.inf
            least = np.full(len(similarity), -np.inf)
            if len(y) > top:  # what may still tie with the last of the best after the rounding is kept until then
                least = np.partition(similarity, len(y) - top, axis=1)[:, len(y) - top] - 2e-6
            row, column = np.nonzero((similarity >= least[:, None]) & other)
            value = similarity[row, column]
            ranked = np.lexsort((y_id[column], -_rounded(value), row))
            row, column, value = row[ranked], column[ranked], value[ranked]
            place = np.arange(len(row)) - np.searchsorted(row, row)
            kept = place < top
            found.append((row[kept] + at, column[kept], value[kept]))
        row, column, value = (np.concatenate(part) for part in zip(*found))
        return pa.table({
            "asked_id": asked["id"].take(pa.array(row)), "id": others["id"].take(pa.array(column)),
            "similarity": pa.array(value, mask=value == NO_LENGTH),
        })

    return best


def _compared(asked: DataFrame, index: DataFrame, key: list[str], top: int, by_bucket: bool, parts: int = 1) -> DataFrame:
    """Every asked row with the best rows of its key, block by block: a key's rows are cut into blocks of bounded size
    on both sides, and each block of asked rows meets each block of the others in a task of its own."""

    def blocks(rows: DataFrame, name: str, size: int, least: int) -> DataFrame:
        return rows.groupBy(*key).agg(F.greatest(F.ceil(F.count(F.lit(1)) / size), F.lit(least)).cast("int").alias(name))

    cut = blocks(asked, "asked_parts", BLOCK_ASKED, parts).join(blocks(index, "index_parts", BLOCK_ROWS, 1), key)
    own = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    # named anew, because both sides come from the same rows
    columns = [F.col(c).alias(c) for c in (*key, "id", "vector", "length", *(["buckets"] if by_bucket else []))]
    a = asked.join(cut, key).select(*columns, own("asked_parts").alias("p"), every("index_parts").alias("q"))
    b = index.join(cut, key).select(*columns, every("asked_parts").alias("p"), own("index_parts").alias("q"))
    id_type = index.schema["id"].dataType.simpleString()
    pairs = a.groupBy(*key, "p", "q").cogroup(b.groupBy(*key, "p", "q")).applyInArrow(
        _both(_best_of_block(top, by_bucket)), f"asked_id {id_type}, id {id_type}, similarity double"
    )
    return _best(pairs.withColumn("similarity", F.round("similarity", 6)), top)


def _both(best: Callable) -> Callable[[tuple, pa.Table, pa.Table], pa.Table]:
    """``best`` where both sides have rows; a block without asked or other rows has no pairs."""

    def checked(key: tuple, asked: pa.Table, others: pa.Table) -> pa.Table:
        if len(asked) and len(others):
            return best(key, asked, others)
        ids = (asked if len(asked) else others)["id"].slice(0, 0)
        return pa.table({"asked_id": ids, "id": ids, "similarity": pa.array([], pa.float64())})

    return checked


def _best(pairs: DataFrame, top: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("asked_id").orderBy(F.desc_nulls_last("similarity"), "id"))
    return pairs.withColumn("rn", rank).filter(F.col("rn") <= top)


def nearest_many(index: DataFrame, asked: DataFrame, top: int = 10) -> DataFrame:
    """(asked_id, id, similarity, rn): the nearest articles of every article of ``asked``, a part of the index."""
    entries = lambda rows: rows.filter("id IS NOT NULL").select("*", F.posexplode("buckets").alias("table", "bucket"))
    return _compared(entries(asked), entries(index), ["table", "bucket"], top, by_bucket=True)


def nearest_by_comparison(index: DataFrame, asked: DataFrame, top: int = 10, parts: int = 8) -> DataFrame:
    """The same by comparing every asked article with all others, in blocks of the asked ones."""
    one = lambda rows: rows.filter("id IS NOT NULL").withColumn("all", F.lit(0))
    return _compared(one(asked), one(index), ["all"], top, by_bucket=False, parts=parts)


def recall(index: DataFrame, asked: DataFrame, top: int = 10) -> DataFrame:
    """One row: neighbours ``wanted`` by full comparison, how many of them the index ``found``, and their share."""
    wanted = nearest_by_comparison(index, asked, top).select("asked_id", "id")
    found = nearest_many(index, asked, top).select("asked_id", "id", F.lit(1).alias("hit"))
    return wanted.join(found, ["asked_id", "id"], "left").agg(
        F.count(F.lit(1)).alias("wanted"), F.count("hit").alias("found")
    ).withColumn("recall", F.round(F.try_divide("found", "wanted"), 6))
