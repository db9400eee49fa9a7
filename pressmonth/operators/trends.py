"""Comparisons between months and views across sources, categories and days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def month_over_month(keyword_stats: DataFrame) -> DataFrame:
    """Articles per keyword in a month and in the calendar month before; a missing month counts as zero.

    Every row speaks for its own month and, as the previous value, for the next one: one grouping replaces
    the dense month grid and the self-join.  Months after the last one with data are not reported.
    """
    spoken = keyword_stats.select("normalized_keyword", F.inline(F.array(
        F.struct(F.col("month_start"), F.col("news_count").alias("now"), F.lit(0).alias("before")),
        F.struct(F.add_months("month_start", 1).alias("month_start"), F.lit(0).alias("now"),
                 F.col("news_count").alias("before")),
    )))
    last = keyword_stats.agg(F.max("month_start")).scalar()
    return spoken.filter(F.col("month_start") <= last).groupBy("month_start", "normalized_keyword").agg(
        F.sum("now").cast("int").alias("news_count"), F.sum("before").cast("int").alias("previous_count")
    ).withColumn("change", F.col("news_count") - F.col("previous_count"))


def _top(rows: DataFrame, top: int, *order) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("month_start").orderBy(*order))
    return rows.withColumn("rn", rank).filter(F.col("rn") <= top)


def emerging_topics(changes: DataFrame, min_count: int = 2, growth: float = 2.0, top: int = 10) -> DataFrame:
    """Strongest risers per month: enough articles, and at least ``growth`` times (smoothed) as many."""
    rising = changes.filter(
        (F.col("news_count") >= min_count)
        & (F.col("news_count") + 1 >= growth * (F.col("previous_count") + 1))
    )
    return _top(rising, top, F.desc("change"), F.desc("news_count"), F.asc("normalized_keyword"))


def falling_topics(changes: DataFrame, min_count: int = 2, top: int = 10) -> DataFrame:
    """Strongest losers per month; ``disappeared`` marks keywords without any article left."""
    falling = changes.filter((F.col("previous_count") >= min_count) & (F.col("change") < 0)).withColumn(
        "disappeared", F.col("news_count") == 0
    )
    return _top(falling, top, F.asc("change"), F.desc("previous_count"), F.asc("normalized_keyword"))


def source_topic_heatmap(source_keywords: DataFrame, topics: list[str]) -> DataFrame:
    """Articles per month, source (rows) and topic (columns) for a short list of topics."""
    return (
        source_keywords.filter(F.col("normalized_keyword").isin(*topics))
        .groupBy("month_start", "source_media").pivot("normalized_keyword", topics)
        .agg(F.sum("news_count").cast("int")).fillna(0)
    )


def dominant_categories(keyword_stats: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Dictionary categories of each month, ranked by the articles of their keywords."""
    categories = dictionary.filter(F.col("category").isNotNull()).select(
        F.col("normalized_keyword").alias("entry"), "category"
    )
    key = F.coalesce("normalized_canonical_keyword", "normalized_keyword")
    summed = keyword_stats.join(categories, key == F.col("entry")).groupBy("month_start", "category").agg(
        F.sum("news_count").cast("int").alias("news_count"),
        F.sum("total_occurrences").cast("int").alias("total_occurrences"),
    )
    rank = F.row_number().over(Window.partitionBy("month_start").orderBy(
        F.desc("news_count"), F.desc("total_occurrences"), F.asc("category")
    ))
    return summed.withColumn("rn", rank)


def related_keywords(hits: DataFrame, key: str, top: int = 20) -> DataFrame:
    """Keywords that share articles with one topic, per month, by Jaccard similarity of their article sets.

    Only the articles of the topic are looked into, so no keyword pairs are formed.
    """
    is_topic = (F.col("normalized_keyword") == key) | (F.col("normalized_canonical_keyword") == F.lit(key))
    presence = hits.select("month_start", "raw_noticia_id", "normalized_keyword").distinct()
    topic = hits.filter(is_topic).select("raw_noticia_id").distinct()
    size = hits.filter(is_topic).groupBy("month_start").agg(
        F.count_distinct("raw_noticia_id").alias("topic_count")
    )
    names = hits.filter(is_topic).select("normalized_keyword").distinct()
    counted = presence.join(topic.withColumn("shared", F.lit(1)), "raw_noticia_id", "left").join(
        names, "normalized_keyword", "left_anti"
    ).groupBy("month_start", "normalized_keyword").agg(
        F.count(F.lit(1)).alias("keyword_count"), F.count("shared").alias("shared_count")
    ).filter("shared_count > 0")
    jaccard = F.col("shared_count") / (F.col("keyword_count") + F.col("topic_count") - F.col("shared_count"))
    scored = counted.join(size, "month_start").select(
        "month_start", "normalized_keyword", F.col("shared_count").cast("int").alias("shared_count"),
        F.round(jaccard, 6).alias("jaccard"),
    )
    return _top(scored, top, F.desc("jaccard"), F.desc("shared_count"), F.asc("normalized_keyword"))


def keyword_daily(daily: DataFrame) -> DataFrame:
    """Daily series of a topic with the missing days of its months filled with zero."""
    days = daily.select("month_start").distinct().select("month_start", F.explode(
        F.sequence(F.col("month_start"), F.last_day("month_start"))
    ).alias("activity_date"))
    return days.join(daily, ["month_start", "activity_date"], "left").select(
        "month_start", "activity_date", F.coalesce("news_count", F.lit(0)).alias("news_count")
    )


def keyword_weekly(daily: DataFrame) -> DataFrame:
    """Weekly series (weeks start on Monday) from the daily one."""
    return daily.groupBy(F.to_date(F.date_trunc("week", "activity_date")).alias("week_start")).agg(
        F.sum("news_count").cast("int").alias("news_count")
    )
