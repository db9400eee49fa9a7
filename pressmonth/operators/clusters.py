"""Clusters of articles by embedding, for all months at once, and the articles that stand for them.

Lloyd's steps over every month in one job: the month is part of each grouping key, and a step is one assignment (a join
with the month's centres) and one grouped sum.  Components are whole numbers, floor(2^16 x), so that sums and distances
are exact and do not depend on the order of rows or the number of partitions.  A month's centres start as its ``k``
articles with the least MD5 of the id, which a rank with a limit finds without sorting the month; clusters are numbered
in that order.  A tie goes to the lower cluster, and a cluster that loses all articles keeps its centre.

Centres are a table bounded by the calendar (months times ``k`` vectors); no row of it passes through the driver.  Every
step writes them, so a lost executor repeats one step at most.  Articles without embedding have no cluster.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..plans.lineage import computed_once

SCALE = 1 << 16
STEPS = 5


def whole(vector: Column, scale: int = SCALE) -> Column:
    """Components as whole numbers."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


def squared_gap(a: Column, b: Column) -> Column:
    gaps = F.zip_with(a, b, lambda x, y: F.coalesce(x, F.lit(0)) - F.coalesce(y, F.lit(0)))
    return F.aggregate(F.transform(gaps, lambda g: g * g), F.lit(0).cast("bigint"), lambda acc, g: acc + g)


def first_centres(points: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("month_start").orderBy(F.md5(F.col("id").cast("string")), "id"))
    return points.withColumn("rank", rank).filter(F.col("rank") <= k).select(
        "month_start", (F.col("rank") - 1).alias("cluster"), F.col("vector").alias("centre")
    )


def assigned(points: DataFrame, centres: DataFrame) -> DataFrame:
    """``points`` with their nearest centre's ``cluster`` and the squared ``gap`` to it."""
    months = centres.groupBy("month_start").agg(
        F.sort_array(F.collect_list(F.struct("cluster", "centre"))).alias("centres")
    )
    nearest = F.array_min(F.transform("centres", lambda c: F.struct(
        squared_gap(F.col("vector"), c["centre"]).alias("gap"), c["cluster"].alias("cluster")
    )))
    return points.join(months, "month_start").withColumn("nearest", nearest).select(
        *points.columns, F.col("nearest.cluster").alias("cluster"), F.col("nearest.gap").alias("gap")
    )


def moved(points: DataFrame, centres: DataFrame) -> DataFrame:
    """Centres after one step: the means, rounded down, of the articles that each holds."""
    sums = assigned(points, centres).select("month_start", "cluster", F.posexplode("vector").alias("place", "value")).groupBy(
        "month_start", "cluster", "place"
    ).agg(F.sum("value").alias("total"), F.count("value").alias("n"))
    means = sums.withColumn("mean", F.expr("(total - pmod(total, n)) div n")).groupBy("month_start", "cluster").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("place", "mean"))), lambda m: m["mean"]).alias("mean")
    )
    return centres.join(means, ["month_start", "cluster"], "left").select(
        "month_start", "cluster", F.coalesce("mean", "centre").alias("centre")
    )


def clustered(
    articles: DataFrame, k: int = 8, steps: int = STEPS, keep: Callable[[DataFrame], DataFrame] = computed_once
) -> DataFrame:
    """Articles (id, month_start) with their cluster in the month and the squared distance to its centre.

    ``keep`` stages the points and the centres of each step.
    """
    points = keep(articles.filter(F.col("embedding").isNotNull()).select(
        "id", "month_start", whole(F.col("embedding")).alias("vector")
    ))
    centres = keep(first_centres(points, k))
    for _ in range(steps):
        centres = keep(moved(points, centres))
    return assigned(points, centres).select(
        "id", "month_start", "cluster", (F.col("gap") / float(SCALE * SCALE)).alias("distance")
    )


def monthly_clusters(articles: DataFrame) -> DataFrame:
    """Size and spread of each month's clusters; ``articles`` come from :func:`clustered`."""
    return articles.groupBy("month_start", "cluster").agg(
        F.count(F.lit(1)).alias("news_count"), F.max("distance").alias("farthest")
    )


def cluster_representatives(articles: DataFrame, top: int = 3) -> DataFrame:
    """Articles closest to the centre of their cluster, per month."""
    rank = F.row_number().over(Window.partitionBy("month_start", "cluster").orderBy("distance", "id"))
    return articles.select("month_start", "cluster", "id", "distance", rank.alias("rn")).filter(F.col("rn") <= top)
