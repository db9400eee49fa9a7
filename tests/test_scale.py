"""Behaviour that only matters at scale: skew, exact results beyond sizes, and plan shapes."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from pressmonth.operators import aliases, ingest, upsert
from pressmonth.plans import catalog, ranking, reports

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("size", [0, 1, 5, 900])
def test_numbering_is_consecutive_in_key_order(spark, size):
    rng = random.Random(size)
    names = list({"src" + "".join(rng.choice("abñ9") for _ in range(8)) for _ in range(size)})
    rows = spark.createDataFrame([(n,) for n in names], "name string")
    got = {r["name"]: r["number"] for r in ranking.number_by(rows, "name").collect()}
    assert got == {n: i for i, n in enumerate(sorted(names, key=lambda s: s.encode()), 1)}


def test_new_sources_continue_after_the_highest_number(spark):
    stored = spark.createDataFrame([("b", "Fuente 7"), ("x", "Otro")], "source_name string, alias string")
    seen = spark.createDataFrame([("c",), ("a",), ("b",), (None,), ("a",)], "source_media string")
    rows = {r.source_name: r.alias for r in aliases.source_aliases(seen, stored).collect()}
    assert rows == {"b": "Fuente 7", "x": "Otro", "a": "Fuente 8", "c": "Fuente 9"}
    assert aliases.source_aliases(seen.limit(0), stored).count() == 2


def test_strict_names_never_leak(spark):
    rows = spark.createDataFrame([("a",), ("b",)], "source_media string")
    known = spark.createDataFrame([("a", "Fuente 1")], "source_name string, alias string")
    named = lambda strict: {r.source_media: r.alias for r in aliases.with_alias(rows, known, strict).collect()}
    assert named(False) == {"a": "Fuente 1", "b": "b"} and named(True) == {"a": "Fuente 1", "b": None}


def test_copies_are_cut_before_the_shuffle(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("noticia_hash"),
        "id", F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz").alias("fecha_extraccion"),
        F.lit("s").alias("fuente"),
    )
    unique = ingest.prepare_batch(rows, dt.datetime(2024, 1, 2))
    assert unique.filter("noticia_hash = 'hot'").first()["id"] == 2997 and unique.count() == 2001
    text = plan(upsert.latest_per_key(rows, ("noticia_hash",), F.desc("id")))
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_batch_resolution_equals_brute_force(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abc ") for _ in range(rng.randrange(1, 6)))
    month = dt.date(2024, 1, 1)
    names = sorted({word() for _ in range(60)})
    stats = [(month, n, n, None if i % 3 else "z" + n, rng.randrange(3), rng.randrange(3)) for i, n in enumerate(names)]
    queries = sorted({word() for _ in range(60)} | {"zzz", names[0], "z" + names[3]})
    table = spark.createDataFrame([(m, k, n, None, c, a, b) for m, k, n, c, a, b in stats],
        "month_start date, keyword string, normalized_keyword string, canonical_keyword string, "
        "normalized_canonical_keyword string, news_count int, total_occurrences int")
    asked = spark.createDataFrame([(month, q) for q in queries], "month_start date, query string")
    got = {r.query: (r.normalized_keyword, r.match) for r in reports.resolve_batch(table, asked).collect()}

    def best(query):
        found = []
        for _, _, n, canonical, articles, mentions in stats:
            tier = 0 if query in (n, canonical) else 1 if n in query else 2 if query in n else None
            if tier is not None:
                found.append((tier, -articles, -mentions, n.encode(), n))
        if not found:
            return query, "raw"
        return min(found)[4], ("exact", "inside", "around")[min(found)[0]]

    assert got == {q: best(q) for q in queries}


@pytest.mark.parametrize("name", ["daily_activity", "dictionary_hits", "entity_hits", "merged_hits",
                                  "dictionary_hits_by_join", "resolve_keyword", "topic_news", "news_keywords"])
def test_no_product_joins(spark, name):
    text = plan(catalog.QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(ingest.month_slice(spark.read.parquet(f"{SF}/orders.parquet").select(
        F.col("o_orderdate").alias("fecha_publicacion"), F.col("o_orderkey").alias("id")), catalog.MONTH))
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThan(o_orderdate" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in text
    daily = plan(catalog.QUERIES["daily_activity"](spark, SF))
    assert "text" not in daily.split("ReadSchema")[1]


def test_rankings_are_limited_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan(catalog.QUERIES["source_top_keywords"](spark, SF))


def test_keyset_pages_cover_everything_once(spark):
    start = dt.datetime(2024, 1, 1)
    rows = spark.range(25).select(
        "id", F.lit("h").alias("noticia_hash"), F.lit("u").alias("url_original"), F.lit("t").alias("titulo"),
        (F.lit(start) + F.make_dt_interval(hours=(F.col("id") / 4).cast("int"))).cast("timestamp_ntz").alias("fecha_extraccion"),
    )
    seen, after = [], None
    while page := ingest.news_page(rows, 7, after=after).collect():
        seen += [r.id for r in page]
        after = (page[-1].fecha_extraccion, page[-1].id)
    assert seen == list(range(25))


def test_upstream_vectors_may_arrive_as_text(spark):
    from pressmonth.sources.upstream import shaped

    rows = spark.range(2).select(
        F.col("id").cast("int"), *[F.lit("x").alias(c) for c in ("noticia_hash", "fuente", "url_original", "titulo",
                                                                 "texto_completo", "url_imagen")],
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("fecha_publicacion"),
        F.lit(None).cast("timestamp").alias("fecha_extraccion"),
        F.when(F.col("id") == 0, "[0.5,1]").alias("embedding"),
    )
    assert [r.embedding for r in shaped(rows).orderBy("id").collect()] == [[0.5, 1.0], None]


@pytest.mark.parametrize("text", ["Abc " * 40000, "-".join(["abc"] * 40000), "a. " * 40000])
def test_extreme_texts_are_matched_without_recursion(spark, text):
    from test_hits import documents

    from pressmonth.operators import entities, keyphrases

    docs = documents(spark, text)
    assert entities.entity_hits(docs).count() <= 1
    assert keyphrases.keyphrase_hits(docs).count() <= 12
