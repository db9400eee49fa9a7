"""Rows that need not move or be sorted to be counted: plan shapes, and equal results of the forms that replaced them."""

import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from pressmonth.operators import entities, hits, ingest, stats
from pressmonth.plans import pipeline
from pressmonth.schemas import EXTRACTORS, TABLES
from test_hits import documents

NOW = dt.datetime(2024, 5, 1, 12)
MONTHS = [dt.date(2024, 3, 1), dt.date(2024, 4, 1), None]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hits_are_merged_where_their_article_is(spark, config):
    text = plan(hits.news_keywords(documents(spark, "Ana fue a El Remanso"), config))
    assert "Exchange hashpartitioning" not in text.split("Union")[0]


def test_articles_without_mentions_have_no_hit(spark):
    docs = documents(spark, "nada aquí", "", "Ana fue. Ana no.").withColumn("document", F.nullif("document", F.lit("")))
    listed = entities.entity_hits(docs)
    assert [(r.raw_noticia_id, r.keyword, r.occurrences) for r in listed.collect()] == [(2, "Ana", 2)]
    assert plan(entities.entity_hits(docs)).count("ArrowEvalPython") == 1


def test_tables_without_rows_are_known_to_be_empty(spark, tmp_path):
    store = pipeline.open_store(spark, str(tmp_path / "store"))
    for name, ddl in TABLES.items():
        empty = store.read(name)
        assert empty.schema == spark.createDataFrame([], ddl).schema and empty.count() == 0
    news = spark.range(9).select("id", F.lit(dt.date(2024, 3, 1)).alias("month_start"))
    text = plan(ingest.unprocessed_news(news, store.read("news_keyword_processing"), by_month=True))
    assert "Exchange" not in text and "Join" not in text


def test_a_prepared_batch_is_not_prepared_again(spark, tmp_path):
    store = pipeline.open_store(spark, str(tmp_path / "store"))
    batch = spark.createDataFrame([], TABLES["raw_news"])
    assert "Window" not in plan(ingest.news_upsert(store.read("raw_news"), batch, NOW, is_prepared=True))


def keyword_rows(seed, extractors):
    """Articles of equal number in several months and sources, repeated rows, and nulls wherever they may stand."""
    rng = random.Random(seed)
    maybe = lambda value: None if rng.random() < 0.2 else value
    return [(
        maybe(rng.randrange(8)), rng.choice(MONTHS), rng.choice(["Luz", "luz", "LUZ"]), maybe(rng.choice(["luz", "sol"])),
        maybe(rng.choice("AB")), maybe(rng.choice(["luz", "mar"])), maybe(rng.choice(["misc", "topic"])),
        maybe(rng.choice(extractors)), maybe(rng.choice([0.5, 1.25])), rng.randrange(5), maybe(rng.choice("rst")),
    ) for _ in range(400)]


@pytest.mark.parametrize("extractors", [EXTRACTORS, (*EXTRACTORS, "own"), ("own", "other", "third")])
def test_keyword_statistics_equal_brute_force(spark, config, extractors):
    rows = keyword_rows(len(extractors), extractors)
    found = spark.createDataFrame(rows, (
        "raw_noticia_id bigint, month_start date, keyword string, normalized_keyword string, canonical_keyword string, "
        "normalized_canonical_keyword string, keyword_type string, extractor_source string, score double, "
        "occurrences int, source_media string")).withColumn("score", F.col("score").cast("decimal(12,6)"))
    monthly, per_source = {}, {}
    for r in rows:
        monthly.setdefault((r[1], r[3]), []).append(r)
        per_source.setdefault((r[1], r[10], r[3]), []).append(r)
    articles = lambda group: len({r[0] for r in group} - {None})
    top = lambda group, i, f=max: f((r[i] for r in group if r[i] is not None), default=None)

    def average(group):
        known = [r[8] for r in group if r[8] is not None]
        return (sum(map(Decimal, known)) / len(known)).quantize(Decimal("0.000001"), ROUND_HALF_UP) if known else None

    def figures(group):
        return top(group, 4), top(group, 5), top(group, 6), sum(r[9] for r in group), average(group)

    read = lambda r: (r.canonical_keyword, r.normalized_canonical_keyword, r.keyword_type, r.total_occurrences, r.avg_score)
    got = {(r.month_start, r.source_media, r.normalized_keyword): (r.keyword, r.news_count, *read(r)) for r in stats.source_keyword_stats(found).collect()}
    assert got == {k: (top(g, 4) or top(g, 2, min), articles(g), *figures(g)) for k, g in per_source.items()}
    result = stats.monthly_keyword_stats(found, config.dictionary_df(spark))
    got = {(r.month_start, r.normalized_keyword): (
        r.keyword, r.news_count, *read(r), r.extractor_sources, r.source_media_count, r.source_media_stats) for r in result.collect()}
    want = {}
    for key, g in monthly.items():
        sources = {s: articles([r for r in g if r[10] == s]) for s in {r[10] for r in g}}
        named = {s: n for s, n in sources.items() if s is not None}
        want[key] = (top(g, 2, min), sum(sources.values()), *figures(g), sorted({r[7] for r in g} - {None}), len(sources), named)
    assert got == want
    assert "collect_set(extractor_source" not in plan(result)
