"""Row numbers over a whole data set without sorting it in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SPLITTERS = 256


def number_by(rows: DataFrame, key: str, name: str = "number") -> DataFrame:
    """Consecutive numbers from 1 in the order of the unique, non-null string column ``key``.

    A hash-ordered sample of at most ``SPLITTERS`` keys cuts the key space into ranges; each range is
    numbered on its own and shifted by the size of the ranges before it.  Only the per-range counts (at
    most ``SPLITTERS + 1`` rows) meet in one task.  The sample steers balance, never the result.
    """
    sample = rows.select(key).orderBy(F.xxhash64(key), key).limit(SPLITTERS)
    splitters = sample.agg(F.sort_array(F.collect_list(key)).alias("splitters"))
    ranged = rows.select("*", splitters.scalar().alias("_splitters")).withColumn(
        "_range", F.size(F.filter("_splitters", lambda s: s < F.col(key)))
    ).drop("_splitters")
    counts = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(key))
    # `offsets` has at most SPLITTERS + 1 rows by construction
    return ranged.withColumn("_place", place).join(F.broadcast(offsets), "_range").withColumn(
        name, F.col("_offset") + F.col("_place")
    ).drop("_range", "_place", "_offset")
