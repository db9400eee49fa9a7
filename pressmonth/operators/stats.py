"""Monthly aggregates.  All months are computed in one job: the month is part of every grouping key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.dates import month_start
from ..schemas import EXTRACTORS

SOURCE_TOP = 10
MONTH_TOP = 20


def published(news: DataFrame) -> DataFrame:
    """Articles with a publication date, and their month."""
    return news.filter(F.col("fecha_publicacion").isNotNull()).withColumn(
        "month_start", month_start(F.col("fecha_publicacion"))
    )


def daily_activity(news: DataFrame) -> DataFrame:
    return published(news).groupBy(
        "month_start", F.to_date("fecha_publicacion").alias("activity_date")
    ).agg(F.count(F.lit(1)).cast("int").alias("news_count"))


def _average(total: Column, count: Column) -> Column:
    """Average of exact sums, rounded once (half up, like the stored decimal)."""
    return F.try_divide(total, count).cast("decimal(12,6)").alias("avg_score")


def _counted_once(hits: DataFrame) -> DataFrame:
    """``hits`` with ``first``, true for one of the hits that an article has of a keyword: what is left of a distinct
    count is a sum.  Articles are dealt out before they meet at a keyword; rows keep their order for the next step, and
    the order begins with the keyword, which tells rows apart sooner than their month does.
    """
    own = Window.partitionBy("normalized_keyword", "month_start", "source_media", "raw_noticia_id").orderBy("extractor_source")
    return hits.withColumn("first", (F.row_number().over(own) == 1) & F.col("raw_noticia_id").isNotNull())


def source_keyword_stats(hits: DataFrame) -> DataFrame:
    """Per month, source and keyword: names, distinct articles, occurrences, average score."""
    return _counted_once(hits).groupBy("normalized_keyword", "month_start", "source_media").agg(
        F.coalesce(F.max("canonical_keyword"), F.min("keyword")).alias("keyword"),
        F.max("canonical_keyword").alias("canonical_keyword"),
        F.max("normalized_canonical_keyword").alias("normalized_canonical_keyword"),
        F.max("keyword_type").alias("keyword_type"),
        F.count_if("first").cast("int").alias("news_count"),
        F.sum("occurrences").cast("int").alias("total_occurrences"),
        _average(F.sum("score"), F.count("score")),
    ).select(
        "month_start", "source_media", "normalized_keyword", "keyword", "canonical_keyword",
        "normalized_canonical_keyword", "keyword_type", "news_count", "total_occurrences", "avg_score",
    )


def keyword_source_counts(hits: DataFrame) -> DataFrame:
    """Distinct articles per month, keyword and source."""
    return hits.groupBy("month_start", "normalized_keyword", "source_media").agg(
        F.count_distinct("raw_noticia_id").cast("int").alias("media_news_count")
    )


def monthly_keyword_stats(hits: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Per month and keyword: names, extractors, counts, source breakdown and editorial priority.

    Two levels: first per source (distinct articles are counted there, spread over all sources of a hot
    keyword), then per keyword.  An article has one source, so its distinct counts add up.  A disabled
    dictionary entry still lends its priority.  The known extractors are gathered as bits, not as a set for
    every row; any other makes a row of its own, which the second level adds to its source.
    """
    priorities = dictionary.select(F.col("normalized_keyword").alias("priority_key"), "priority")
    key = F.coalesce("normalized_canonical_keyword", "normalized_keyword")
    bit = F.coalesce(*[F.when(F.col("extractor_source") == e, F.lit(1 << i)) for i, e in enumerate(EXTRACTORS)], F.lit(0))
    other = F.when(~F.col("extractor_source").isin(*EXTRACTORS), F.col("extractor_source"))
    per_source = (
        _counted_once(hits.join(priorities, key == F.col("priority_key"), "left"))
        .groupBy("normalized_keyword", "month_start", "source_media", other.alias("other"))
        .agg(
            F.min("keyword").alias("keyword"),
            F.max("canonical_keyword").alias("canonical_keyword"),
            F.max("normalized_canonical_keyword").alias("normalized_canonical_keyword"),
            F.max("keyword_type").alias("keyword_type"),
            F.bit_or(bit).alias("bits"),
            F.count_if("first").cast("int").alias("news_count"),
            F.sum("occurrences").alias("occurrences"),
            F.sum("score").alias("score_sum"),
            F.count("score").alias("score_count"),
            F.max("priority").alias("priority"),
        )
    )
    per_keyword = per_source.groupBy("normalized_keyword", "month_start").agg(
        F.min("keyword").alias("keyword"),
        F.max("canonical_keyword").alias("canonical_keyword"),
        F.max("normalized_canonical_keyword").alias("normalized_canonical_keyword"),
        F.max("keyword_type").alias("keyword_type"),
        F.bit_or("bits").alias("bits"),
        F.collect_set("other").alias("others"),
        F.sum("news_count").cast("int").alias("news_count"),
        F.sum("occurrences").cast("int").alias("total_occurrences"),
        _average(F.sum("score_sum"), F.sum("score_count")),
        F.collect_list(F.struct("source_media", "news_count")).alias("by_source"),
        F.coalesce(F.max("priority"), F.lit(0)).alias("priority"),
    )
    known = [F.when(F.col("bits").bitwiseAND(1 << i) != 0, F.lit(e)) for i, e in enumerate(EXTRACTORS)]
    # a source has one row, or several where an extractor is not a known one
    summed = F.transform(F.array_distinct(F.col("by_source.source_media")), lambda s: F.struct(
        s.alias("source_media"),
        F.reduce(F.filter("by_source", lambda r: r["source_media"].eqNullSafe(s)), F.lit(0), lambda n, r: n + r["news_count"]).alias("news_count"),
    ))
    each = F.when(F.size("others") == 0, F.col("by_source")).otherwise(summed)
    return per_keyword.withColumn("by_source", each).select(
        "month_start", "keyword", "normalized_keyword", "canonical_keyword", "normalized_canonical_keyword",
        "keyword_type", F.sort_array(F.concat(F.array_compact(F.array(*known)), "others")).alias("extractor_sources"),
        "news_count", "total_occurrences", "avg_score", F.size("by_source").alias("source_media_count"),
        F.map_from_entries(F.filter("by_source", lambda r: r["source_media"].isNotNull())).alias("source_media_stats"),
        "priority",
    )


def _rank(partition: list[str], *order: Column) -> Column:
    return F.row_number().over(Window.partitionBy(*partition).orderBy(*order))


def source_top_keywords(source_keywords: DataFrame, top: int = SOURCE_TOP) -> DataFrame:
    """Best keywords of each source and month; the keyword key breaks remaining ties."""
    rank = _rank(
        ["month_start", "source_media"],
        F.desc("news_count"), F.desc("total_occurrences"), F.asc("keyword"), F.asc("normalized_keyword"),
    )
    return source_keywords.select(
        "month_start", "source_media", "keyword", "normalized_keyword", "news_count", "total_occurrences",
        rank.alias("rn"),
    ).filter(F.col("rn") <= top)


def _ordered_list(*fields: str | Column) -> Column:
    """Array of structs in rank order, the rank itself removed."""
    ranked = F.sort_array(F.collect_list(F.struct("rn", F.struct(*fields).alias("item"))))
    return F.transform(ranked, lambda r: r["item"])


def _or_empty(array: str, item: str) -> Column:
    return F.coalesce(array, F.expr(f"cast(array() as array<struct<{item}>>)")).alias(array)


def source_monthly_stats(news: DataFrame, source_keywords: DataFrame) -> DataFrame:
    """Per month and source: articles, summed keyword counts, distinct keywords and the top-10 list."""
    key = ["month_start", "source_media"]
    articles = published(news).withColumnRenamed("fuente", "source_media").groupBy(*key).agg(
        F.count("id").cast("int").alias("news_count")
    )
    summary = source_keywords.groupBy(*key).agg(
        F.sum("news_count").cast("int").alias("keyword_rows"),
        F.count("normalized_keyword").cast("int").alias("distinct_keywords"),
    )
    top = source_top_keywords(source_keywords).groupBy(*key).agg(
        _ordered_list("keyword", "news_count", "total_occurrences").alias("top_keywords")
    )
    return articles.join(summary, key, "left").join(top, key, "left").select(
        *key, "news_count",
        F.coalesce("keyword_rows", F.lit(0)).alias("keyword_rows"),
        F.coalesce("distinct_keywords", F.lit(0)).alias("distinct_keywords"),
        _or_empty("top_keywords", "keyword:string,news_count:int,total_occurrences:int"),
    )


def top_keywords_month(keyword_stats: DataFrame, top: int = MONTH_TOP) -> DataFrame:
    """Best keywords of each month by priority, articles, occurrences and name."""
    rank = _rank(
        ["month_start"], F.desc("priority"), F.desc("news_count"), F.desc("total_occurrences"),
        F.asc("keyword"), F.asc("normalized_keyword"),
    )
    return keyword_stats.select(
        "month_start", F.coalesce("canonical_keyword", "keyword").alias("keyword"), "normalized_keyword",
        F.col("keyword_type").alias("type"), "news_count", "total_occurrences", "priority", rank.alias("rn"),
    ).filter(F.col("rn") <= top)


def source_ranking(source_stats: DataFrame) -> DataFrame:
    rank = _rank(["month_start"], F.desc("news_count"), F.asc("source_media"))
    return source_stats.select(
        "month_start", "source_media", "news_count", "distinct_keywords", rank.alias("rn")
    )


def monthly_overview(
    news: DataFrame, hits: DataFrame, keyword_stats: DataFrame, source_stats: DataFrame,
    months: DataFrame | None = None,
) -> DataFrame:
    """One row per month: totals, date range, top-20 keywords and the ranked source list.

    ``months`` asks for certain months, which are reported even without a single article.
    """
    totals = published(news).groupBy("month_start").agg(
        F.count(F.lit(1)).cast("int").alias("total_news"),
        F.count_distinct("fuente").cast("int").alias("active_source_count"),
        F.min("fecha_publicacion").alias("first_publication_at"),
        F.max("fecha_publicacion").alias("last_publication_at"),
    )
    covered = hits.groupBy("month_start").agg(
        F.count_distinct("raw_noticia_id").cast("int").alias("news_with_keywords")
    )
    keywords = keyword_stats.groupBy("month_start").agg(F.count(F.lit(1)).cast("int").alias("keyword_count"))
    top = top_keywords_month(keyword_stats).groupBy("month_start").agg(
        _ordered_list("keyword", "type", "news_count", "total_occurrences").alias("top_keywords")
    )
    sources = source_ranking(source_stats).groupBy("month_start").agg(
        _ordered_list("source_media", "news_count", "distinct_keywords").alias("source_stats")
    )
    joined = totals if months is None else months.select("month_start").distinct().join(totals, "month_start", "left")
    for part in (covered, keywords, top, sources):
        joined = joined.join(part, "month_start", "left")
    return joined.select(
        "month_start", F.coalesce("total_news", F.lit(0)).alias("total_news"),
        F.coalesce("news_with_keywords", F.lit(0)).alias("news_with_keywords"),
        F.coalesce("active_source_count", F.lit(0)).alias("active_source_count"),
        F.coalesce("keyword_count", F.lit(0)).alias("keyword_count"),
        _or_empty("top_keywords", "keyword:string,type:string,news_count:int,total_occurrences:int"),
        _or_empty("source_stats", "source_media:string,news_count:int,distinct_keywords:int"),
        "first_publication_at", "last_publication_at",
    )
