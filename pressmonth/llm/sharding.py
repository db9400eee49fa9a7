"""Two-pass external shuffle of a corpus into shards.

Pass one scatters the rows: a seeded hash of the id picks the shard by jump hashing (the id and the shard count
decide, and one more shard takes rows only into itself), and a second seeded hash one of the shard's buckets,
whose number follows from the total size so that a bucket fits in memory.  Pass two brings each bucket together,
orders it by id and text (so that a recomputed task repeats its result) and applies a seeded Fisher-Yates shuffle.

Rows that repeat an id share its shard, as the rule demands, but are dealt over that shard's buckets by a hash of
id and text; copies of one text under many ids are spread over all buckets.  Only rows that repeat both id and text
share a bucket.  A null id is the id 0 for the hash and stays null; a null text has no bytes.  An empty table gives
no rows.  Columns named like the results (``shard``, ``slot``, ``grown_shard``, ``size``) are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressmonth.llm.staging import widened

BUCKET_BYTES = 24 << 20


def jump_shard(key: Column, shards: int, seed: int) -> Column:
    """The jump rule: going from n to n + 1 shards, a key moves (into the new shard) with probability 1 / (n + 1)."""
    place = F.lit(0)
    for n in range(1, shards):
        draw = F.pmod(F.xxhash64(key, F.lit(seed), F.lit(n)), F.lit(n + 1))
        place = F.when(draw == n, F.lit(n)).otherwise(place)
    return place.cast("int")


def fisher_yates(count: int, seed: int) -> np.ndarray:
    """A permutation of range(count): from the last place down, swap with a uniform earlier one."""
    order = np.arange(count)
    draws = np.random.default_rng(seed).random(count)
    for i in range(count - 1, 0, -1):
        j = int(draws[i] * (i + 1))
        order[i], order[j] = order[j], order[i]
    return order


def shuffle_into_shards(
    docs: DataFrame, shards: int = 24, seed: int = 17, bucket_bytes: int = BUCKET_BYTES, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """All rows and columns of ``docs`` with ``size`` (UTF-8 bytes of the text plus 8), ``shard``, ``slot``, ``grown_shard``."""
    docs = docs.drop("size", "shard", "slot", "grown_shard", "__bucket", "__place", "__first")
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8
    total = docs.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    per_shard = max(1, -(-total // (shards * bucket_bytes)))
    id_ = F.coalesce(F.col(key), F.lit(0))
    spread = F.pmod(F.xxhash64(id_, F.xxhash64(text), F.lit(seed + 1)), F.lit(per_shard))
    placed = (
        docs.withColumn("size", size)
        .withColumn("shard", jump_shard(id_, shards, seed))
        .withColumn("grown_shard", F.when(
            F.pmod(F.xxhash64(id_, F.lit(seed), F.lit(shards)), F.lit(shards + 1)) == shards, F.lit(shards)
        ).otherwise(F.col("shard")).cast("int"))
        .withColumn("__bucket", F.col("shard") * F.lit(per_shard) + spread)
    )
    # one row a bucket: its first slot (the rows of the buckets before it in the shard)
    before = Window.partitionBy("shard").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = placed.groupBy("shard", "__bucket").agg(F.count("*").alias("n")).select(
        "__bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__first")
    )
    columns = [*docs.columns, "size", "shard", "grown_shard"]
    schema = widened(placed.select(*columns).schema, slot="bigint")

    def shuffle(_: tuple, rows: pa.Table, first: pa.Table) -> pa.Table:
        bucket = rows.column("__bucket")[0].as_py()
        rows = rows.select(columns).sort_by([(key, "ascending"), (text, "ascending")])
        rows = rows.take(pa.array(fisher_yates(rows.num_rows, seed * 1_000_003 + bucket)))
        start = first.column("__first")[0].as_py()
        return rows.append_column("slot", pa.array(np.arange(start, start + rows.num_rows), pa.int64()))

    return placed.groupBy("__bucket").cogroup(firsts.groupBy("__bucket")).applyInArrow(shuffle, schema)


def write_shards(shuffled: DataFrame, path: str) -> None:
    """One folder a shard, rows in slot order within their file."""
    shuffled.write.partitionBy("shard").parquet(path)
