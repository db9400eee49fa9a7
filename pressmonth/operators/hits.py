"""Operators on keyword hits: canonicalise, merge, omit, prune, assemble."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import month_start
from ..functions.text import cleaned_document, normalized_document
from ..sources.dictionary import KeywordConfig, lookup
from .entities import entity_hits
from .keyphrases import keyphrase_hits
from .matching import ARTICLE, HIT, dictionary_hits

ALL_EXTRACTORS = ("dictionary", "entities", "keyphrases")


def to_documents(news: DataFrame, max_text_chars: int | None = None) -> DataFrame:
    """Published articles as ``document`` and ``normalized_document``, with their month and source."""
    article = news.filter(F.col("fecha_publicacion").isNotNull()).select(
        F.col("id").alias("raw_noticia_id"),
        "noticia_hash",
        month_start(F.col("fecha_publicacion")).alias("month_start"),
        F.col("fuente").alias("source_media"),
        cleaned_document(F.col("titulo"), F.col("texto_completo"), max_text_chars).alias("document"),
    )
    return article.withColumn("normalized_document", normalized_document(F.col("document")))


def alias_lookup(documents: DataFrame, config: KeywordConfig) -> DataFrame:
    """Alias map as a DataFrame: one row per enabled alias, the later entry winning duplicates."""
    rows = [
        (alias, e["canonical"], e["normalized"], e["keyword_type"]) for alias, e in config.alias_map().items()
    ]
    return lookup(
        documents.sparkSession, rows, "alias string, to_canonical string, to_normalized string, to_type string"
    )


def canonicalize_hits(hits: DataFrame, lookup: DataFrame) -> DataFrame:
    """Automatic hits whose normalised keyword is a known alias take over the entry's name, key and type.

    Dictionary hits are canonical by construction and pass through.
    """
    automatic = F.col("extractor_source") != "dictionary"
    joined = hits.join(lookup, (F.col("normalized_keyword") == F.col("alias")) & automatic, "left")
    known = F.col("alias").isNotNull()
    replaced = {
        "keyword": "to_canonical", "normalized_keyword": "to_normalized", "canonical_keyword": "to_canonical",
        "normalized_canonical_keyword": "to_normalized", "keyword_type": "to_type",
    }
    return joined.select(*[
        F.when(known, F.col(replaced[c])).otherwise(F.col(c)).alias(c) if c in replaced else F.col(c)
        for c in hits.columns
    ])


def _first_filled(name: str) -> Column:
    filled = F.when(F.coalesce(F.col(name), F.lit("")) != "", F.struct("hit_order", F.col(name).alias("v")))
    return F.min(filled)["v"].alias(name)


def merge_hits(hits: DataFrame) -> DataFrame:
    """One hit per article, keyword and extractor.

    First spelling, first non-empty canonical form and type (by ``hit_order``), best score, summed occurrences.
    The keyword follows the article's id in the order of the keys: the article's other columns tell nothing apart.
    """
    return hits.groupBy(ARTICLE[0], "normalized_keyword", "extractor_source", *ARTICLE[1:]).agg(
        F.min(F.struct("hit_order", "keyword"))["keyword"].alias("keyword"),
        _first_filled("canonical_keyword"),
        _first_filled("normalized_canonical_keyword"),
        _first_filled("keyword_type"),
        F.max("score").alias("score"),
        F.sum("occurrences").cast("int").alias("occurrences"),
        F.min("hit_order").alias("hit_order"),
    ).select(*ARTICLE, *HIT)


def filter_omitted(hits: DataFrame, omitted: DataFrame) -> DataFrame:
    """Drop hits whose normalised keyword is on the omit list, whichever extractor found them."""
    return hits.join(omitted, "normalized_keyword", "left_anti").select(*hits.columns)


def prune_omitted(stored: DataFrame, omitted: DataFrame, months: list) -> DataFrame:
    """Stored hits without the omitted keywords of the given months; other months are left alone."""
    banned = omitted.select(F.col("normalized_keyword").alias("banned"))
    hit = (F.col("normalized_keyword") == F.col("banned")) & F.col("month_start").isin(*months)
    return stored.join(banned, hit, "left_anti")


def extracted_hits(
    documents: DataFrame,
    config: KeywordConfig,
    extractors: tuple[str, ...] = ALL_EXTRACTORS,
    load_annotator: Callable | None = None,
    max_keyphrases: int = 12,
) -> DataFrame:
    """Bag union of the extractors' hits; ``hit_order`` keeps the order within each of them.

    All of them are dealt out by article, so that what is done for each article next need not move them again.
    """
    makers = {
        "dictionary": lambda: dictionary_hits(documents, config).repartition(ARTICLE[0]),
        "entities": lambda: entity_hits(documents, load_annotator),
        "keyphrases": lambda: keyphrase_hits(documents, max_keyphrases),
    }
    return reduce(DataFrame.unionByName, [makers[name]() for name in extractors])


def news_keywords(
    documents: DataFrame,
    config: KeywordConfig,
    extractors: tuple[str, ...] = ALL_EXTRACTORS,
    load_annotator: Callable | None = None,
    max_keyphrases: int = 12,
) -> DataFrame:
    """All keyword rows of the articles: extract, canonicalise, merge, omit."""
    spark = documents.sparkSession
    raw = extracted_hits(documents, config, extractors, load_annotator, max_keyphrases)
    merged = merge_hits(canonicalize_hits(raw, alias_lookup(documents, config)))
    kept = filter_omitted(merged, config.omitted_df(spark)) if config.omitted else merged
    return kept.select(
        "raw_noticia_id", "noticia_hash", "month_start", "keyword", "normalized_keyword", "canonical_keyword",
        "normalized_canonical_keyword", "keyword_type", "extractor_source",
        F.col("score").cast("decimal(12,6)").alias("score"), "occurrences", "source_media",
    )
