"""Upsert and deduplication on a business key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def latest_per_key(rows: DataFrame, keys: tuple[str, ...], *newest_first: Column) -> DataFrame:
    """One row per key.  The limit on the rank is applied before the shuffle too, so a key with very many
    copies sends one row per task."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest_first))
    return rows.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def upsert(stored: DataFrame, incoming: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """``stored`` with ``incoming`` (unique per key) inserted or replacing rows of the same key."""
    kept = stored.join(incoming.select(*keys), list(keys), "left_anti").select(*stored.columns)
    return kept.unionByName(incoming.select(*stored.columns))
