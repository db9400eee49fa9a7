"""Read side: the month page and the topic page, as plain DataFrames over the stored tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import dates, web
from ..operators.aliases import with_alias
from .lineage import computed_once

TOP_SOURCES = 8
TOP_NEWS = 30
TOP_FALLBACK = 24
MIN_WEIGHT = 0.12


# --- months -------------------------------------------------------------------------------------------


def month_list(overview: DataFrame) -> DataFrame:
    """Months with articles, newest first, with their label."""
    month = F.col("month_start")
    return overview.filter("total_news > 0").select(
        month, dates.month_key(month).alias("value"), dates.month_label(month).alias("label"), "total_news"
    ).orderBy(F.desc("month_start"))


def select_month(overview: DataFrame, requested: str | None) -> DataFrame:
    """The requested ``YYYY-MM`` if it has articles, else the latest month (one row)."""
    month = F.col("month_start")
    return overview.filter("total_news > 0").agg(
        F.coalesce(F.max(F.when(dates.month_key(month) == F.lit(requested), month)), F.max(month)).alias("month_start")
    )


def peak_day(daily: DataFrame) -> DataFrame:
    """Per month: first day with the highest count, and the number of days with articles."""
    return daily.groupBy("month_start").agg(
        F.max(F.struct(F.col("news_count"), (-F.unix_date("activity_date")).alias("d"), "activity_date")).alias("p"),
        F.count_if(F.col("news_count") > 0).alias("active_days"),
    ).select(
        "month_start", F.col("p.activity_date").alias("peak_date"), F.col("p.news_count").alias("peak_count"),
        "active_days",
    )


# --- month page ---------------------------------------------------------------------------------------


def sources_public(
    source_stats: DataFrame, aliases: DataFrame, month: dt.date | None = None, top: int = TOP_SOURCES,
    strict: bool = False,
) -> DataFrame:
    """Top sources of a month (or of every month) under their public names."""
    rows = source_stats if month is None else source_stats.filter(F.col("month_start") == F.lit(month))
    rank = F.row_number().over(
        Window.partitionBy("month_start").orderBy(F.desc("news_count"), F.asc("source_media"))
    )
    best = rows.select("month_start", "source_media", "news_count", "distinct_keywords", rank.alias("rn"))
    return with_alias(best.filter(F.col("rn") <= top), aliases, strict).select(
        "month_start", "rn", "alias", "news_count", "distinct_keywords"
    )


def keyword_fallback(source_keywords: DataFrame, month: dt.date | None = None, top: int = TOP_FALLBACK) -> DataFrame:
    """Keyword list regrouped from the per-source statistics, for months without a stored list."""
    rows = source_keywords if month is None else source_keywords.filter(F.col("month_start") == F.lit(month))
    label = F.coalesce("canonical_keyword", "keyword")
    grouped = rows.groupBy("month_start", label.alias("keyword"), "canonical_keyword").agg(
        F.sum("news_count").cast("int").alias("weight"),
        F.sum("total_occurrences").cast("int").alias("occurrences"),
    )
    filled = F.nullif(F.col("canonical_keyword"), F.lit(""))
    rank = F.row_number().over(Window.partitionBy("month_start").orderBy(
        F.desc("weight"), F.desc("occurrences"), F.asc("keyword"), F.asc_nulls_first("canonical_keyword")
    ))
    return grouped.withColumn("rn", rank).filter(F.col("rn") <= top).select(
        "month_start", "rn",
        F.coalesce(filled, F.nullif(F.col("keyword"), F.lit("")), F.lit("Tema")).alias("label"),
        "weight", "occurrences",
    )


def weight_ratio(weight: Column, *partition: str) -> Column:
    """Weight as a share of the largest one (at least 1), never below the visible minimum."""
    largest = F.greatest(F.max(weight).over(Window.partitionBy(*partition)), F.lit(1))
    return F.greatest(F.lit(MIN_WEIGHT), F.least(F.lit(1.0), weight / largest))


def home_report(tables: dict[str, DataFrame], month: dt.date, strict: bool = False) -> dict[str, DataFrame]:
    """Everything the month page shows.  The stored keyword list is used unless it is empty."""
    of_month = F.col("month_start") == F.lit(month)
    overview = tables["monthly_overview"].filter(of_month)
    stored = overview.select(
        "month_start", F.posexplode(F.slice("top_keywords", 1, web.MAX_KEYWORDS)).alias("rn", "k")
    ).select(
        "month_start", (F.col("rn") + 1).alias("rn"), F.trim("k.keyword").alias("label"),
        F.col("k.news_count").alias("weight"), F.col("k.total_occurrences").alias("occurrences"),
    ).filter("label != ''")
    fallback = keyword_fallback(tables["source_keyword_stats"], month).join(
        stored.select("month_start").distinct(), "month_start", "left_anti"
    )
    keywords = stored.unionByName(fallback)
    return {
        "months": month_list(tables["monthly_overview"]),
        "overview": overview,
        "daily_activity": tables["daily_activity"].filter(of_month).orderBy("activity_date"),
        "sources": sources_public(tables["source_monthly_stats"], tables["source_aliases"], month, strict=strict)
        .orderBy("rn"),
        "top_keywords": keywords.withColumn("ratio", weight_ratio(F.col("weight"), "month_start")).orderBy("rn"),
        "peak_day": peak_day(tables["daily_activity"].filter(of_month)),
    }


# --- topic resolution ---------------------------------------------------------------------------------


def _matches(key: Column) -> Column:
    return (F.col("normalized_keyword") == key) | (F.col("normalized_canonical_keyword") == key)


def resolve_keyword(keyword_stats: DataFrame, query: str) -> DataFrame:
    """Best exact match of a normalised query in every month; ties fall to the keyword key."""
    rank = F.row_number().over(Window.partitionBy("month_start").orderBy(
        F.desc("news_count"), F.desc("total_occurrences"), F.asc("normalized_keyword")
    ))
    return keyword_stats.filter(_matches(F.lit(query))).withColumn("rn", rank).filter("rn = 1").select(
        "month_start", F.coalesce("canonical_keyword", "keyword").alias("keyword"), "normalized_keyword",
        "news_count",
    )


FEW_TEXTS = 100  # distinct ones that are looked for one by one


def _cut(rows: DataFrame, column: str, others: DataFrame, other: str) -> DataFrame:
    """Rows exploded into the distinct substrings of ``column``, named ``other``, that may occur among the values of
    ``others``: those that do if these are few, else all whose length occurs.  The texts that are looked for are one
    small array, and so is the set of lengths, whatever the rows."""
    texts = others.select(other).distinct().limit(FEW_TEXTS + 1)
    sought = texts.agg(F.collect_set(other).alias("t")).scalar()
    lengths = others.agg(F.sort_array(F.collect_set(F.length(other))).alias("n")).scalar()

    def of_length(n: Column) -> Column:
        last = F.length(column) - n
        starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.substring(F.col(column), i + 1, n))

    found = F.filter("_sought", lambda t: F.contains(F.col(column), t))
    cut = F.array_distinct(F.flatten(F.transform("_lengths", of_length)))
    asked = rows.select("*", sought.alias("_sought"), lengths.alias("_lengths"))
    return asked.withColumn(other, F.explode(F.when(F.size("_sought") <= FEW_TEXTS, found).otherwise(cut))).drop("_sought", "_lengths")


def resolve_batch(keyword_stats: DataFrame, requests: DataFrame, fuzzy: bool = True) -> DataFrame:
    """Resolve many ``(month_start, query)`` requests: exact first, then by substring, then the query itself.

    Containment is an equi-join: one side is cut into its substrings that may occur on the other side, so only true
    matches meet and no pair is tested in vain.  A keyword inside the query is preferred over a query inside the
    keyword, then come the counts and the keyword key.  The requests are staged: their size is known, and the
    keywords need not move to meet them if they are few.
    """
    asked = computed_once(requests.select("month_start", "query").distinct())
    stats = keyword_stats.select(
        "month_start", F.coalesce("canonical_keyword", "keyword").alias("keyword"), "normalized_keyword",
        "normalized_canonical_keyword", "news_count", "total_occurrences",
    )
    names = stats.select("*", F.explode(F.array_distinct(F.array_compact(
        F.array("normalized_keyword", "normalized_canonical_keyword")
    ))).alias("query"))
    found = names.join(asked, ["month_start", "query"]).withColumn("tier", F.lit(0))
    if fuzzy:
        inside_query = _cut(asked, "query", stats, "normalized_keyword").join(
            stats, ["month_start", "normalized_keyword"]
        )
        around_query = _cut(stats, "normalized_keyword", asked, "query").join(asked, ["month_start", "query"])
        found = found.unionByName(inside_query.withColumn("tier", F.lit(1)), allowMissingColumns=True).unionByName(
            around_query.withColumn("tier", F.lit(2)), allowMissingColumns=True
        )
    best = F.row_number().over(Window.partitionBy("month_start", "query").orderBy(
        F.asc("tier"), F.desc("news_count"), F.desc("total_occurrences"), F.asc("normalized_keyword")
    ))
    resolved = found.withColumn("rn", best).filter("rn = 1").select(
        "month_start", "query", "keyword", "normalized_keyword", "news_count", "tier"
    )
    return asked.join(resolved, ["month_start", "query"], "left").select(
        "month_start", "query",
        F.coalesce("keyword", "query").alias("keyword"),
        F.coalesce("normalized_keyword", "query").alias("normalized_keyword"),
        "news_count",
        F.element_at(F.array(F.lit("exact"), F.lit("inside"), F.lit("around"), F.lit("raw")),
                     F.coalesce("tier", F.lit(3)) + 1).alias("match"),
    )


def resolve_keyword_fuzzy(keyword_stats: DataFrame, query: str) -> DataFrame:
    """Best substring match of one normalised query in every month (no join: the query is a constant)."""
    inside = F.contains(F.lit(query), F.col("normalized_keyword"))
    around = F.contains(F.col("normalized_keyword"), F.lit(query))
    rank = F.row_number().over(Window.partitionBy("month_start").orderBy(
        F.when(inside, 0).otherwise(1), F.desc("news_count"), F.desc("total_occurrences"),
        F.asc("normalized_keyword"),
    ))
    return keyword_stats.filter(inside | around).withColumn("rn", rank).filter("rn = 1").select(
        "month_start", F.coalesce("canonical_keyword", "keyword").alias("keyword"), "normalized_keyword",
        "news_count",
    )


# --- topic page ---------------------------------------------------------------------------------------


def topic_rows(hits: DataFrame, news: DataFrame, key: str, month: dt.date | None = None) -> DataFrame:
    """Hits of a topic with their article.  The selective side is filtered before the join."""
    own = hits.filter(_matches(F.lit(key)))
    if month is not None:
        own = own.filter(F.col("month_start") == F.lit(month))
    articles = news.select(
        F.col("id").alias("raw_noticia_id"), "fecha_publicacion",
        *[c for c in ("titulo", "url_original") if c in news.columns],
    )
    return own.select("month_start", "raw_noticia_id", "source_media", "occurrences").join(
        articles, "raw_noticia_id"
    )


def topic_overview(rows: DataFrame) -> DataFrame:
    return rows.groupBy("month_start").agg(
        F.count_distinct("raw_noticia_id").cast("int").alias("news_count"),
        F.coalesce(F.sum("occurrences"), F.lit(0)).cast("int").alias("total_occurrences"),
        F.min("fecha_publicacion").alias("first_publication_at"),
        F.max("fecha_publicacion").alias("last_publication_at"),
    )


def topic_daily(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("fecha_publicacion").isNotNull()).groupBy(
        "month_start", F.to_date("fecha_publicacion").alias("activity_date")
    ).agg(F.count_distinct("raw_noticia_id").cast("int").alias("news_count"))


def topic_sources(
    source_keywords: DataFrame, aliases: DataFrame, key: str, month: dt.date | None = None,
    top: int = TOP_SOURCES, strict: bool = False,
) -> DataFrame:
    """Top sources of a topic per month, with public name and public key."""
    own = source_keywords.filter(_matches(F.lit(key)))
    if month is not None:
        own = own.filter(F.col("month_start") == F.lit(month))
    rank = F.row_number().over(Window.partitionBy("month_start").orderBy(
        F.desc("news_count"), F.desc("total_occurrences"), F.asc("source_media"), F.asc("normalized_keyword")
    ))
    best = own.select("month_start", "source_media", "news_count", "total_occurrences", rank.alias("rn"))
    return with_alias(best.filter(F.col("rn") <= top), aliases, strict).select(
        "month_start", "rn", "source_media", "alias", web.alias_key(F.col("alias"), F.col("rn")).alias("key"),
        "news_count", "total_occurrences",
    )


def _news_order(order: str) -> list[Column]:
    date, mentions, last = F.desc_nulls_last("fecha_publicacion"), F.desc("total_occurrences"), F.desc("id")
    return [date, mentions, last] if order == "recent" else [mentions, date, last]


def topic_news(rows: DataFrame, order: str = "representative", top: int = TOP_NEWS) -> DataFrame:
    """Articles of a topic per month in the chosen order, with the mentions summed over extractors."""
    summed = rows.groupBy("month_start", F.col("raw_noticia_id").alias("id"), "fecha_publicacion").agg(
        F.coalesce(F.sum("occurrences"), F.lit(0)).cast("int").alias("total_occurrences")
    )
    rank = F.row_number().over(Window.partitionBy("month_start").orderBy(*_news_order(order)))
    return summed.withColumn("rn", rank).filter(F.col("rn") <= top)


def with_article(ranked: DataFrame, news: DataFrame) -> DataFrame:
    """Title and validated link for the articles that made the list."""
    texts = news.select("id", F.col("titulo").alias("title"), web.http_url(F.col("url_original")).alias("url"))
    return texts.join(ranked, "id")


def of_source(rows: DataFrame, sources: DataFrame, key: str | None) -> DataFrame:
    """Topic rows of the source with a public key; months where the key is not listed keep all sources."""
    if key in (None, "all"):
        return rows
    chosen = sources.filter(F.col("key") == F.lit(key)).select(
        "month_start", F.col("source_media").alias("chosen")
    )
    # at most one listed source per month: bounded by the calendar
    return rows.join(chosen, "month_start", "left").filter(
        F.col("chosen").isNull() | (F.col("chosen") == F.col("source_media"))
    ).drop("chosen")


def topic_report(
    tables: dict[str, DataFrame], month: dt.date, query: str, order: str = "representative",
    source: str | None = None, strict: bool = False,
) -> dict[str, DataFrame | str]:
    """Everything the topic page shows for one typed query."""
    spark = tables["monthly_keyword_stats"].sparkSession
    from ..functions.text import normalize_query

    typed = spark.createDataFrame([(query,)], "raw string").select(web.decode_keyword(F.col("raw")).alias("q"))
    typed, normalized = typed.select("q", normalize_query(F.col("q"))).first()
    if not normalized:
        raise LookupError("empty topic")
    stats = tables["monthly_keyword_stats"].filter(F.col("month_start") == F.lit(month))
    found = resolve_keyword(stats, normalized).first() or resolve_keyword_fuzzy(stats, normalized).first()
    name, key = (found["keyword"], found["normalized_keyword"]) if found else (typed, normalized)
    # articles are filed under the month of their hits: only that partition is read
    articles = tables["raw_news"].filter(F.col("month_start") == F.lit(month))
    rows = topic_rows(tables["news_keywords"], articles, key, month)
    sources = topic_sources(tables["source_keyword_stats"], tables["source_aliases"], key, month, strict=strict)
    news = with_article(topic_news(of_source(rows, sources, source), order), articles)
    return {
        "keyword": name,
        "normalized_keyword": key,
        "overview": topic_overview(rows),
        "daily_activity": topic_daily(rows).orderBy("activity_date"),
        "sources": sources.drop("source_media").orderBy("rn"),
        "news": news.orderBy("rn"),
    }
