"""Registered queries: every operator applied to the driver's generated tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, text, web
from ..operators import (
    aliases, clusters, entities, hits, ingest, keyphrases, map2d, matching, neighbours, periods, quality, related, semantic,
    stats, trends,
)
from ..operators.upsert import upsert
from ..sources import dictionary as dic
from ..sources.generated import NOW, news, table
from . import pipeline, reports
from .lineage import computed_once, shared_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

MONTH = dt.date(1998, 5, 1)
TOPIC = "thtion"
TYPED = " %54h%74ion"  # the same as typed into an address
SOURCE_KEY = "fuente-2"
# Requests of the batch resolution, asked in every month: exact, contained, containing and unknown ones.
REQUESTS = ("thtion", "attion to", "the eriner thanea of", "hanedbl", "src", "zzz unknown", "and therhean is the")
PAGE = (200, 100)  # rows, offset
CLUSTERS = 3  # in each month
ASKED_EVERY = 50  # of the articles, for their neighbours
HIT_COLUMNS = (
    "raw_noticia_id", "keyword", "normalized_keyword", "canonical_keyword", "normalized_canonical_keyword",
    "keyword_type", "extractor_source", "score", "occurrences",
)


def config() -> dic.KeywordConfig:
    return dic.load_keyword_config(dic.SAMPLE_CONFIG)


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- shared inputs ------------------------------------------------------------------------------------


def _documents(spark, sf):
    columns = ("id", "noticia_hash", "fuente", "titulo", "texto_completo", "fecha_publicacion")
    return hits.to_documents(news(spark, sf, *columns))


def _cleaned(spark, sf):
    """The documents for all extractors: five branches read them, so the texts are cleaned and normalised once."""
    return computed_once(_documents(spark, sf))


def _hits(spark, sf):
    return hits.news_keywords(_cleaned(spark, sf), config())


def _dated(spark, sf):
    return news(spark, sf, "id", "fuente", "fecha_publicacion")


def _dictionary(spark):
    return config().dictionary_df(spark)


def _keyword_stats(spark, sf, found=None):
    return stats.monthly_keyword_stats(_hits(spark, sf) if found is None else found, _dictionary(spark))


def _source_keywords(spark, sf, found=None):
    """Read by a summary and by a ranking in most queries, so computed once."""
    return computed_once(stats.source_keyword_stats(_hits(spark, sf) if found is None else found))


def _source_stats(spark, sf, found=None):
    return stats.source_monthly_stats(_dated(spark, sf), _source_keywords(spark, sf, found))


def _overview(spark, sf):
    """The texts are analysed once; the hits and the keyword statistics feed several branches each."""
    found = computed_once(_hits(spark, sf))
    keywords = computed_once(_keyword_stats(spark, sf, found))
    return stats.monthly_overview(_dated(spark, sf), found, keywords, _source_stats(spark, sf, found))


def _totals(spark, sf):
    return stats.published(_dated(spark, sf)).groupBy("month_start").agg(
        F.count(F.lit(1)).cast("int").alias("total_news")
    )


def _no_aliases(spark):
    return spark.createDataFrame([], "source_name string, alias string")


def _aliases(spark, sf):
    return aliases.source_aliases(
        table(spark, sf, "documents").select(F.col("source").alias("source_media")), _no_aliases(spark)
    )


def _topic(spark, sf, found=None):
    found = _hits(spark, sf) if found is None else found
    return reports.topic_rows(found, news(spark, sf, "id", "fecha_publicacion"), TOPIC)


def _flat(rows, *columns):
    """Scores as doubles of six digits, nested columns left out."""
    return rows.select(*[
        F.round(F.col(c).cast("double"), 6).alias(c) if c in ("score", "avg_score") else F.col(c) for c in columns
    ])


# --- scans and sinks ----------------------------------------------------------------------------------


@query
def scan_valid_news(spark, sf):
    return ingest.valid_news(news(spark, sf, "id", "noticia_hash", "fuente", "url_original", "titulo"))


@query
def news_page(spark, sf):
    rows = news(spark, sf, "id", "noticia_hash", "url_original", "titulo", "fecha_extraccion")
    return ingest.news_page(rows, PAGE[0], PAGE[1]).select("id", "noticia_hash", "fecha_extraccion")


@query
def news_page_after(spark, sf):
    """Keyset page: resumes behind an article that another page ended with."""
    rows = news(spark, sf, "id", "noticia_hash", "url_original", "titulo", "fecha_extraccion")
    return ingest.news_page(rows, PAGE[0], after=(NOW - dt.timedelta(hours=60), 0)).select("id", "fecha_extraccion")


@query
def incremental_news(spark, sf):
    rows = news(spark, sf, "id", "noticia_hash", "url_original", "titulo", "fecha_extraccion", "embedding")
    return ingest.incremental_news(rows, NOW).select("id", "noticia_hash", "fecha_extraccion")


@query
def dictionary_aliases(spark, sf):
    """Aliases of the configuration with the number of articles that mention them."""
    listed = dic.dictionary_aliases(config().entries_df(spark))
    names = sorted({a for e in config().entries for a in e["normalized_aliases"]})
    used = matching.alias_counts(_documents(spark, sf), names).groupBy("normalized_alias").agg(
        F.count_if(F.col("occurrences") > 0).alias("articles")
    )
    return listed.join(used, "normalized_alias", "left").select(
        "position", "alias_position", "canonical", "normalized", "keyword_type", "category", "priority",
        "enabled", "normalized_alias", F.coalesce("articles", F.lit(0)).alias("articles"),
    )


def _batch(spark, sf):
    """Recent articles with a changed title, plus an older copy of each."""
    fresh = news(spark, sf, "id", "noticia_hash", "fuente", "titulo", "fecha_extraccion").filter(
        dates.since(F.col("fecha_extraccion"), NOW, 48)
    ).withColumn("titulo", F.concat(F.lit("Act: "), "titulo"))
    older = fresh.withColumns({
        "titulo": F.lit("old"), "fecha_extraccion": F.expr("fecha_extraccion - interval 1 hour"),
    })
    return fresh.unionByName(older)


@query
def news_upsert(spark, sf):
    old = NOW - dt.timedelta(hours=40)
    stored = news(spark, sf, "id", "upstream_id", "noticia_hash", "fuente", "titulo", "fecha_extraccion", "synced_at")
    stored = stored.filter(F.col("fecha_extraccion") < F.lit(old).cast("timestamp_ntz"))
    return ingest.news_upsert(stored, _batch(spark, sf), NOW)


def _state(spark, sf):
    """Stored period state: every month once, its status chosen by the calendar month."""
    all_months = periods.affected_periods(_dated(spark, sf), "full")
    return all_months.select(
        F.lit("run-0").alias("processing_run_id"), "year", "month", "month_start",
        F.element_at(F.array(*map(F.lit, ("pending", "completed", "consumed", "processing", "failed"))),
                     F.col("month") % 5 + 1).alias("status"),
        F.lit("recent_sync").alias("reason"), "rows_detected",
        F.lit(NOW - dt.timedelta(days=1)).cast("timestamp_ntz").alias("updated_at"),
    )


def _recent(spark, sf):
    return periods.affected_periods(news(spark, sf, "fecha_publicacion", "synced_at"), "synced_at", NOW)


@query
def affected_periods_upsert(spark, sf):
    return periods.upsert_periods(_state(spark, sf), _recent(spark, sf), "recent_sync", "run-1", NOW)


@query
def keyword_hits_upsert(spark, sf):
    """Hits of the titles alone, replaced by the hits of the whole texts of recent articles."""
    articles = news(spark, sf, "id", "noticia_hash", "fuente", "titulo", "texto_completo", "fecha_publicacion", "fecha_extraccion")
    titles = hits.to_documents(articles.withColumn("texto_completo", F.lit("")))
    recent = hits.to_documents(articles.filter(dates.since(F.col("fecha_extraccion"), NOW, 48)))
    key = ("raw_noticia_id", "normalized_keyword", "extractor_source")
    stored, new = (
        _flat(hits.news_keywords(computed_once(d), config()), *HIT_COLUMNS) for d in (titles, recent)
    )
    return upsert(stored, new, key)


def _markers(spark, sf):
    """Extraction markers of the labelled articles; the ones of low quality failed."""
    return table(spark, sf, "labels").select(
        F.col("doc_id").alias("raw_noticia_id"),
        F.when(F.col("quality") == 1, "completed").otherwise("failed").alias("status"),
        F.lit(0).alias("keyword_rows"),
    )


@query
def processed_markers(spark, sf):
    found = _hits(spark, sf).groupBy("raw_noticia_id").agg(F.count(F.lit(1)).cast("int").alias("n"))
    recent = news(spark, sf, "id", "fecha_extraccion").filter(dates.since(F.col("fecha_extraccion"), NOW, 48))
    done = recent.select(F.col("id").alias("raw_noticia_id")).join(found, "raw_noticia_id", "left").select(
        "raw_noticia_id", F.lit("completed").alias("status"), F.coalesce("n", F.lit(0)).alias("keyword_rows")
    )
    return upsert(_markers(spark, sf), done, ("raw_noticia_id",))


@query
def dictionary_sync(spark, sf):
    """Dictionary of supplier names: half maintained by hand, the rest synced with the solvent suppliers."""
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_name").alias("canonical_keyword"), text.normalize_text(F.col("s_name")).alias("normalized_keyword"),
        F.lit("organization").alias("keyword_type"), F.lit(None).cast("string").alias("category"),
        F.lit(0).alias("priority"), F.lit(True).alias("enabled"),
        F.when(F.col("s_nationkey") < 12, "config").otherwise("manual").alias("source"),
        "s_acctbal", "s_nationkey",
    )
    stored = suppliers.filter("s_nationkey != 3").drop("s_acctbal", "s_nationkey")
    current = suppliers.filter("s_acctbal > 3000").withColumns(
        {"priority": F.col("s_nationkey"), "source": F.lit("config")}
    ).drop("s_acctbal", "s_nationkey")
    return dic.sync_dictionary(stored, current)


@query
def reset_month(spark, sf):
    return stats.source_keyword_stats(_hits(spark, sf)).filter(F.col("month_start") != F.lit(MONTH)).groupBy("month_start").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("news_count").alias("news_count")
    )


@query
def prune_omitted(spark, sf):
    """Stored hits (never filtered) without the omitted keywords of one month."""
    stored = hits.merge_hits(hits.extracted_hits(_cleaned(spark, sf), config()))
    return hits.prune_omitted(stored, config().omitted_df(spark), [MONTH]).select(
        "raw_noticia_id", "month_start", "normalized_keyword", "extractor_source", "occurrences"
    )


# --- filters ------------------------------------------------------------------------------------------


@query
def recent_sync_periods(spark, sf):
    return _recent(spark, sf)


@query
def recent_extraction_periods(spark, sf):
    return periods.affected_periods(
        news(spark, sf, "fecha_publicacion", "fecha_extraccion"), "fecha_extraccion", NOW
    )


@query
def month_slice(spark, sf):
    return ingest.month_slice(_dated(spark, sf), MONTH)


@query
def month_sample(spark, sf):
    return ingest.month_sample(_dated(spark, sf), MONTH, 5)


@query
def parse_month(spark, sf):
    """Order months written in several ways, most of them not acceptable."""
    key = F.date_format("o_orderdate", "yyyy-MM")
    written = F.element_at(F.array(
        key, F.concat(F.lit("  "), key, F.lit(" ")), F.replace(key, F.lit("-"), F.lit("/")),
        F.concat(F.substring(key, 1, 5), F.lit("13")), F.lit(""), F.lit(None), F.concat(key, F.lit("-01")),
    ), (F.col("o_orderkey") % 7 + 1).cast("int"))
    return table(spark, sf, "orders").select("o_orderkey", written.alias("written")).select(
        "o_orderkey", dates.parse_month(F.col("written")).alias("month_start")
    )


@query
def months_to_extract(spark, sf):
    return periods.months_to_extract(_state(spark, sf), retry_failed=True)


@query
def months_to_build(spark, sf):
    return periods.months_to_build(_state(spark, sf), include_processing=True)


@query
def distinct_months(spark, sf):
    return periods.distinct_months(_dated(spark, sf))


@query
def month_list(spark, sf):
    return reports.month_list(_totals(spark, sf))


@query
def select_month(spark, sf):
    """Requested month, and the latest one when the request is unknown."""
    known, unknown = (reports.select_month(_totals(spark, sf), m) for m in ("1998-05", "1812-05"))
    return known.select(F.lit("known").alias("request"), "month_start").unionByName(
        unknown.select(F.lit("unknown").alias("request"), "month_start")
    )


@query
def omit_filter(spark, sf):
    found = hits.extracted_hits(_cleaned(spark, sf), config())
    return _flat(hits.filter_omitted(found, config().omitted_df(spark)), *HIT_COLUMNS)


# Addresses to be told apart; the page's number follows.
ADDRESSES = (
    'http://256.1.1.1/',
    'http://0x7f.1/',
    'http://1.2.3.4.5/',
    'http://www.site.example:65535/',
    'http://www.site.example:65536/',
    'http://%77ww.site.example/',
    'http://a%2Fb.example/',
    'http://[::1]/',
    'http://[1::2::3]/',
    'http://user:pw@www.site.example/',
    'http://user@/',
    'http:\\\\www.site.example\\',
    'http://ex ample.example/',
    ' \t http://www.site.example:/',
    'http://www.site.example:8a/',
    'http://1.2.3/',
    'http://09.1/',
    'http://[::ffff:1.2.3.4]/',
    'http://[::1.2.3.256]/',
    'http://exa%zzmple/',
    'http:www.site.example/',
    'http://4294967295/',
    'http://4294967296/',
    'http://a.0x/',
    'http://[1:2:3:4:5:6:7:8]/',
    'http://[1:2:3:4:5:6:7]/',
    'http://[12345::]/',
    'http://a|b.example/',
    'http://ñandú.example/',
    'http://www.site.example./',
    'http://1..2/',
)


@query
def valid_urls(spark, sf):
    """Page links, the links with another scheme, without host or scheme, and addresses with odd hosts and ports."""
    url = F.col("url")
    variants = F.inline(F.array(*[
        F.struct(F.lit(i).alias("variant"), v.alias("value"))
        for i, v in enumerate((
            url, F.upper(url), F.regexp_replace(url, "^https?", "ftp"), F.regexp_replace(url, "^(https?:).*", "$1//"),
            F.regexp_replace(url, "^https?://", ""), F.regexp_replace(url, r"^https?://", "javascript:"), F.lit(""),
            *[F.concat(F.lit(a), F.col("page_id").cast("string")) for a in ADDRESSES],
        ))
    ]))
    return table(spark, sf, "pages").select("page_id", variants).select(
        "page_id", "variant", web.http_url(F.col("value")).alias("url")
    )


# --- joins --------------------------------------------------------------------------------------------


@query
def unprocessed_news(spark, sf):
    return ingest.unprocessed_news(_dated(spark, sf), _markers(spark, sf))


@query
def sources_public(spark, sf):
    return reports.sources_public(_source_stats(spark, sf), _aliases(spark, sf))


@query
def sources_public_strict(spark, sf):
    """Only half of the sources have an alias; the strict mode never shows the other names."""
    known = _aliases(spark, sf).filter("source_name < 'src15'")
    return reports.sources_public(_source_stats(spark, sf), known, strict=True)


@query
def dictionary_hits(spark, sf):
    return _flat(matching.dictionary_hits(_documents(spark, sf), config()), *HIT_COLUMNS)


@query
def dictionary_hits_by_join(spark, sf):
    """The same hits by the strategy for large dictionaries."""
    return _flat(matching.dictionary_hits(_documents(spark, sf), config(), "join"), *HIT_COLUMNS)


@query
def canonicalize_hits(spark, sf):
    documents = _cleaned(spark, sf)
    found = hits.extracted_hits(documents, config())
    return _flat(hits.canonicalize_hits(found, hits.alias_lookup(documents, config())), *HIT_COLUMNS)


# --- aggregations -------------------------------------------------------------------------------------


@query
def affected_periods(spark, sf):
    return periods.affected_periods(_dated(spark, sf), "full")


@query
def daily_activity(spark, sf):
    return stats.daily_activity(_dated(spark, sf))


@query
def source_keyword_stats(spark, sf):
    rows = stats.source_keyword_stats(_hits(spark, sf))
    return _flat(rows, *rows.columns)


@query
def keyword_source_counts(spark, sf):
    return stats.keyword_source_counts(_hits(spark, sf))


@query
def monthly_keyword_stats(spark, sf):
    rows = _keyword_stats(spark, sf).withColumn("extractors", F.array_join("extractor_sources", ","))
    return _flat(rows, *[c for c in rows.columns if c not in ("extractor_sources", "source_media_stats")])


@query
def monthly_keyword_source_map(spark, sf):
    """The source breakdown of the keyword statistics, unfolded."""
    return _keyword_stats(spark, sf).select(
        "month_start", "normalized_keyword", F.explode("source_media_stats").alias("source_media", "news_count")
    )


@query
def source_monthly_stats(spark, sf):
    return _source_stats(spark, sf).drop("top_keywords")


@query
def source_monthly_top(spark, sf):
    """The top lists of the source statistics, unfolded."""
    return _source_stats(spark, sf).select(
        "month_start", "source_media", F.posexplode("top_keywords").alias("place", "k")
    ).select("month_start", "source_media", "place", "k.*")


@query
def monthly_overview(spark, sf):
    return _overview(spark, sf).drop("top_keywords", "source_stats")


@query
def monthly_overview_top(spark, sf):
    return _overview(spark, sf).select("month_start", F.posexplode("top_keywords").alias("place", "k")).select(
        "month_start", "place", "k.*"
    )


@query
def topic_overview(spark, sf):
    return reports.topic_overview(_topic(spark, sf))


@query
def topic_daily(spark, sf):
    return reports.topic_daily(_topic(spark, sf))


@query
def topic_news(spark, sf):
    return reports.topic_news(_topic(spark, sf))


@query
def topic_news_recent(spark, sf):
    return reports.topic_news(_topic(spark, sf), "recent")


@query
def topic_news_by_source(spark, sf):
    found = computed_once(_hits(spark, sf))
    sources = reports.topic_sources(stats.source_keyword_stats(found), _aliases(spark, sf), TOPIC)
    return reports.topic_news(reports.of_source(_topic(spark, sf, found), sources, SOURCE_KEY))


@query
def keyword_fallback(spark, sf):
    return reports.keyword_fallback(stats.source_keyword_stats(_hits(spark, sf)))


@query
def merged_hits(spark, sf):
    """Hits after the merge; without the canonicalisation before it several spellings would not meet."""
    documents = _cleaned(spark, sf)
    found = hits.extracted_hits(documents, config())
    merged = hits.merge_hits(hits.canonicalize_hits(found, hits.alias_lookup(documents, config())))
    return _flat(merged, *HIT_COLUMNS)


@query
def peak_day(spark, sf):
    return reports.peak_day(stats.daily_activity(_dated(spark, sf)))


@query
def run_summary(spark, sf):
    return periods.run_summary(_recent(spark, sf))


# --- windows and rankings -----------------------------------------------------------------------------


@query
def source_top_keywords(spark, sf):
    return stats.source_top_keywords(stats.source_keyword_stats(_hits(spark, sf)))


@query
def top_keywords_month(spark, sf):
    return stats.top_keywords_month(_keyword_stats(spark, sf))


@query
def source_ranking(spark, sf):
    return stats.source_ranking(_source_stats(spark, sf))


@query
def source_aliases(spark, sf):
    """Sources of the French articles are named first; the others come later and follow on."""
    rows = table(spark, sf, "documents").select(F.col("source").alias("source_media"), "lang")
    first = aliases.source_aliases(rows.filter("lang = 'fr' and source_media > 'src3'"), _no_aliases(spark))
    return aliases.source_aliases(rows, first)


@query
def keyword_weights(spark, sf):
    top = stats.top_keywords_month(_keyword_stats(spark, sf))
    return top.select(
        "month_start", "normalized_keyword",
        F.round(reports.weight_ratio(F.col("news_count"), "month_start"), 6).alias("ratio"),
    )


@query
def topic_sources(spark, sf):
    return reports.topic_sources(stats.source_keyword_stats(_hits(spark, sf)), _aliases(spark, sf), TOPIC)


@query
def resolve_keyword(spark, sf):
    return reports.resolve_keyword(_keyword_stats(spark, sf), TOPIC)


@query
def resolve_keyword_fuzzy(spark, sf):
    return reports.resolve_keyword_fuzzy(_keyword_stats(spark, sf), REQUESTS[2])


@query
def resolve_keyword_batch(spark, sf):
    """Several typed topics in every month: exact, else by substring, else the text itself."""
    rows = computed_once(_keyword_stats(spark, sf))
    asked = rows.select("month_start").distinct().select(
        "month_start", F.explode(F.array(*map(F.lit, REQUESTS))).alias("query")
    )
    return reports.resolve_batch(rows, asked)


@query
def all_hits(spark, sf):
    return _flat(hits.extracted_hits(_cleaned(spark, sf), config()), *HIT_COLUMNS)


# --- scalar functions ---------------------------------------------------------------------------------


@query
def clean_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(text.clean_text(F.col("text"))).alias("cleaned"))


@query
def normalize_text(spark, sf):
    normalized = text.normalize_text(F.col("text"))
    return table(spark, sf, "documents").select("doc_id", F.length(normalized).alias("chars"), F.md5(normalized).alias("normalized"))


@query
def normalize_query(spark, sf):
    """Search-box normalisation of the dialogue turns."""
    return table(spark, sf, "conversations").select(
        "conv_id", "turn", F.md5(text.normalize_query(F.col("text"))).alias("normalized")
    )


@query
def build_document(spark, sf):
    return _documents(spark, sf).select(
        "raw_noticia_id", F.length("document").alias("chars"), F.md5("document").alias("document")
    )


@query
def alias_counts(spark, sf):
    names = sorted({a for e in config().entries for a in e["normalized_aliases"]})
    return matching.alias_counts(_documents(spark, sf), names)


@query
def alias_keys(spark, sf):
    """Public keys of the sources; a source without an alias is known by its place."""
    rows = table(spark, sf, "documents").select(F.col("source").alias("source_media")).distinct()
    named = rows.join(
        _aliases(spark, sf).filter("source_name < 'src15'"), F.col("source_media") == F.col("source_name"), "left"
    )
    place = F.regexp_extract("source_media", "([0-9]+)$", 1).cast("int")
    return named.select("source_media", web.alias_key(F.col("alias"), place + 1).alias("key"))


@query
def decode_keyword(spark, sf):
    """First lines of the articles as path segments, and a malformed copy of each."""
    title = F.substring_index("text", "\n", 1)
    encoded = F.replace(F.url_encode(title), F.lit("+"), F.lit("%20"))
    return table(spark, sf, "documents").select(
        "doc_id",
        F.md5(web.decode_keyword(encoded)).alias("decoded"),
        web.decode_keyword(F.concat(F.lit(" %zz+"), F.col("doc_id").cast("string"))).alias("malformed"),
    )


@query
def read_top_keywords(spark, sf):
    """Stored keyword lists read back from their JSON text."""
    stored = _overview(spark, sf).select("month_start", F.to_json("top_keywords").alias("stored"))
    return stored.select("month_start", F.posexplode(web.read_top_keywords(F.col("stored"))).alias("place", "k")).select(
        "month_start", "place", "k.*"
    )


@query
def month_labels(spark, sf):
    return periods.distinct_months(_dated(spark, sf)).select(
        "month_start", dates.month_label(F.col("month_start")).alias("label")
    )


# --- extractors ---------------------------------------------------------------------------------------


@query
def entity_hits(spark, sf):
    return _flat(entities.entity_hits(_documents(spark, sf)), *HIT_COLUMNS)


def _tokens(spark, sf):
    return keyphrases.tokens(keyphrases.by_article(_documents(spark, sf)))


@query
def keyphrase_terms(spark, sf):
    """Term statistics behind the keyphrases."""
    counts = ("tf", "tf_cased", "left_terms", "right_terms", "sentences", "median_sentence")
    return keyphrases.article_terms(_tokens(spark, sf)).select("raw_noticia_id", F.inline("terms")).select(
        "raw_noticia_id", "term", *counts, F.round("term_score", 6).alias("term_score")
    )


@query
def keyphrase_candidates(spark, sf):
    return keyphrases.keyphrase_candidates(keyphrases.article_candidates(_tokens(spark, sf))).select(
        "raw_noticia_id", "phrase_key", "phrase", "phrase_score", "tf"
    )


@query
def keyphrase_hits(spark, sf):
    rows = keyphrases.keyphrase_hits(_documents(spark, sf))
    return rows.select("raw_noticia_id", "keyword", "normalized_keyword", F.round("score", 6).alias("score"), "occurrences")


@query
def news_keywords(spark, sf):
    """Keyword rows of all three extractors."""
    rows = _hits(spark, sf)
    return rows.select(
        "raw_noticia_id", "noticia_hash", "month_start", "keyword", "normalized_keyword", "canonical_keyword",
        "normalized_canonical_keyword", "keyword_type", "extractor_source", F.col("score").cast("double").alias("score"),
        "occurrences", "source_media",
    )


# --- incremental --------------------------------------------------------------------------------------


@query
def affected_month_rebuild(spark, sf):
    """Daily activity of the affected months, recomputed from the articles of those months only."""
    rows = stats.published(_dated(spark, sf))
    return stats.daily_activity(periods.semi_join_months(rows, _recent(spark, sf)))


@query
def reopen_consumed(spark, sf):
    before = _state(spark, sf)
    after = periods.upsert_periods(before, _recent(spark, sf), "recent_sync", "run-1", NOW)
    return periods.reopened(before, after)


@query
def mark_consumed(spark, sf):
    months = [dt.date(year, month, 1) for year in (1996, 1997, 1998) for month in range(1, 13)]
    return periods.mark_consumed(_state(spark, sf), months, NOW)


# --- data quality -------------------------------------------------------------------------------------


@query
def duplicate_keys(spark, sf):
    """Articles that a source published more than once under the same first line."""
    rows = news(spark, sf, "fuente", "titulo").withColumn("title_key", F.md5("titulo"))
    return quality.duplicate_keys(rows, ("fuente", "title_key"))


@query
def orphans(spark, sf):
    """Vectors and orders that belong to no article."""
    parents = table(spark, sf, "documents")
    vectors = quality.orphans(table(spark, sf, "embeddings"), "vec_id", parents, "doc_id")
    orders = quality.orphans(table(spark, sf, "orders"), "o_orderkey", parents, "doc_id")
    return vectors.select(F.lit("embeddings").alias("child"), F.col("vec_id").alias("reference")).unionByName(
        orders.select(F.lit("orders").alias("child"), F.col("o_orderkey").alias("reference"))
    )


@query
def domain_violations(spark, sf):
    """Event types and order statuses held against the coded domains."""
    states = _state(spark, sf).select("status", "month")
    events = table(spark, sf, "events").select(F.col("event_type").alias("status"), F.month("ts").alias("month"))
    runs = table(spark, sf, "orders").select(
        F.lower("o_orderstatus").alias("status"), F.lit("full").alias("run_type")
    )
    sources = table(spark, sf, "documents").select(F.col("lang").alias("extractor_source"))
    return quality.domain_violations({
        "affected_periods": states.unionByName(events), "processing_runs": runs, "news_keywords": sources,
    })


@query
def constraint_report(spark, sf):
    """The declared constraints held against tables made of vectors, orders and nations, which break many of them."""
    status = F.element_at(F.array(*map(F.lit, ("completed", "failed", "unknown"))), F.col("label") % 3 + 1)
    orders = table(spark, sf, "orders")
    return quality.constraint_report({
        "raw_news": news(spark, sf, "id", "noticia_hash", "titulo", "url_original", "fuente").withColumn(
            "titulo", F.when(F.col("id") % 7 > 0, F.col("titulo"))),
        "news_keyword_processing": table(spark, sf, "embeddings").select(
            (F.col("vec_id") * 3).alias("raw_noticia_id"), status.alias("status"),
            F.concat(F.lit("run-"), F.col("label").cast("string")).alias("updated_from_run_id")),
        "affected_periods": orders.select(
            F.concat(F.lit("run-"), (F.col("o_custkey") % 6).cast("string")).alias("processing_run_id"),
            (F.month("o_orderdate") + (F.col("o_orderkey") % 2).cast("int")).alias("month"), F.trunc("o_orderdate", "MM").alias("month_start"),
            F.when(F.col("o_orderstatus") == "F", "failed").when(F.col("o_orderstatus") == "O", "open").alias("status"),
            F.col("o_orderpriority").alias("reason")),
        "processing_runs": table(spark, sf, "nation").select(
            F.concat(F.lit("run-"), F.col("n_regionkey").cast("string")).alias("run_id"), F.lit("running").alias("status"),
            F.when(F.col("n_nationkey") % 2 == 0, "full").otherwise("weekly").alias("run_type")),
    })


# --- trends -------------------------------------------------------------------------------------------


@query
def month_over_month(spark, sf):
    return trends.month_over_month(computed_once(_keyword_stats(spark, sf)))


@query
def emerging_topics(spark, sf):
    return trends.emerging_topics(trends.month_over_month(computed_once(_keyword_stats(spark, sf))))


@query
def falling_topics(spark, sf):
    return trends.falling_topics(trends.month_over_month(computed_once(_keyword_stats(spark, sf))))


@query
def source_topic_heatmap(spark, sf):
    return trends.source_topic_heatmap(stats.source_keyword_stats(_hits(spark, sf)), ["thtion", "attion", "the the"])


@query
def dominant_categories(spark, sf):
    return trends.dominant_categories(_keyword_stats(spark, sf), _dictionary(spark))


@query
def related_keywords(spark, sf):
    return trends.related_keywords(computed_once(_hits(spark, sf)), TOPIC)


@query
def keyword_daily(spark, sf):
    return trends.keyword_daily(computed_once(reports.topic_daily(_topic(spark, sf))))


@query
def keyword_weekly(spark, sf):
    return trends.keyword_weekly(reports.topic_daily(_topic(spark, sf)))


@query
def nearest_articles(spark, sf):
    return semantic.nearest_articles(news(spark, sf, "id", "embedding"), 7)


def _clusters(spark, sf):
    rows = news(spark, sf, "id", "fecha_publicacion", "embedding")
    return clusters.clustered(stats.published(rows).select("id", "month_start", "embedding"), CLUSTERS)


@query
def monthly_clusters(spark, sf):
    return clusters.monthly_clusters(_clusters(spark, sf))


@query
def cluster_representatives(spark, sf):
    return clusters.cluster_representatives(_clusters(spark, sf))


@query
def map_2d(spark, sf):
    return map2d.map_2d(news(spark, sf, "id", "embedding"))


def _index(spark, sf):
    """The index of all articles, and every fiftieth article with an embedding as the ones asked about."""
    index = computed_once(neighbours.hyperplane_index(news(spark, sf, "id", "embedding")))
    return index, index.filter(F.col("id") % ASKED_EVERY == 0)


@query
def nearest_many(spark, sf):
    return neighbours.nearest_many(*_index(spark, sf))


@query
def nearest_recall(spark, sf):
    """What the index finds of the neighbours by full comparison."""
    return neighbours.recall(*_index(spark, sf))


@query
def related_classes(spark, sf):
    """Keywords of a month that occur in exactly the same articles."""
    return related.keyword_classes(related.presence(_hits(spark, sf)))


@query
def related_links(spark, sf):
    """Every two classes of a month that share enough articles."""
    present = computed_once(related.presence(_hits(spark, sf)))
    return related.keyword_links(present, computed_once(related.keyword_classes(present)))


# --- stored tables and pages --------------------------------------------------------------------------

_STORES: dict[str, pipeline.TableStore] = {}


def _built_store(spark, sf):
    """All jobs run over all articles, once a session: sync, detection, extraction, build."""
    root = f"{shared_folder(spark)}/store-{sf.strip('/').replace('/', '-')}"
    if root not in _STORES or not _STORES[root].exists():
        store = pipeline.open_store(spark, root)
        pipeline.run_sync(store, news(spark, sf, *ingest.SOURCE_COLUMNS), NOW, full=True)
        pipeline.run_detect(store, NOW, full=True)
        pipeline.run_extract(store, config(), NOW, full=True)
        pipeline.run_build(store, NOW, full=True)
        _STORES[root] = store
    return _STORES[root]


def _section(rows, name, place, label, value):
    return rows.select(
        F.lit(name).alias("section"), place.cast("int").alias("place"), label.cast("string").alias("label"),
        value.cast("bigint").alias("value"),
    )


@query
def stored_keywords(spark, sf):
    """Keyword rows as the extraction job has stored them."""
    return _built_store(spark, sf).read("news_keywords").select(
        "raw_noticia_id", "month_start", "normalized_keyword", "extractor_source", F.col("score").cast("double").alias("score"),
        "occurrences", "source_media",
    )


@query
def month_page(spark, sf):
    """What the month page shows, from the stored tables."""
    page = reports.home_report(_built_store(spark, sf).all(), MONTH)
    zero = F.lit(0)
    return (
        _section(page["overview"], "articles", zero, F.lit("total"), F.col("total_news"))
        .unionByName(_section(page["overview"], "articles", zero, F.lit("with keywords"), F.col("news_with_keywords")))
        .unionByName(_section(page["daily_activity"], "day", zero, F.col("activity_date"), F.col("news_count")))
        .unionByName(_section(page["sources"], "source", F.col("rn"), F.col("alias"), F.col("news_count")))
        .unionByName(_section(page["top_keywords"], "keyword", F.col("rn"), F.col("label"), F.col("weight")))
    )


@query
def topic_page(spark, sf):
    """What the page of a typed topic shows, from the stored tables."""
    page = reports.topic_report(_built_store(spark, sf).all(), MONTH, TYPED, order="recent")
    zero = F.lit(0)
    return (
        _section(page["overview"], "articles", zero, F.lit(page["normalized_keyword"]), F.col("news_count"))
        .unionByName(_section(page["daily_activity"], "day", zero, F.col("activity_date"), F.col("news_count")))
        .unionByName(_section(page["sources"], "source", F.col("rn"), F.col("alias"), F.col("news_count")))
        .unionByName(_section(page["news"], "news", F.col("rn"), F.col("id"), F.col("total_occurrences")))
    )


@query
def stream_daily_activity(spark, sf):
    """Daily counts that a stream has kept: the articles arrive in four files, one in each batch."""
    from ..streaming import ingest as streaming

    root = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    articles = news(spark, sf, *ingest.SOURCE_COLUMNS).withColumn("texto_completo", F.lit(None).cast("string"))
    articles.repartition(4).write.parquet(f"{root}/arrivals")
    store = pipeline.open_store(spark, f"{root}/tables")
    streaming.daily_table(store, streaming.news_stream(spark, f"{root}/arrivals", 1), f"{root}/progress").awaitTermination()
    return store.read("daily_activity")
