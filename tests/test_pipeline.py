import datetime as dt

import pytest
from conftest import BODY_1, NOW, article
from pyspark.sql import functions as F

from pressmonth.operators import periods, quality, stats
from pressmonth.plans import pipeline, reports
from pressmonth.schemas import KEYS, TABLES
from pressmonth.sources.dictionary import KeywordConfig

MARCH = dt.date(2024, 3, 1)
FAST = ("dictionary", "entities")


@pytest.fixture
def store(spark, tmp_path):
    return pipeline.open_store(spark, str(tmp_path / "tables"))


def content(store, name):
    rows = store.read(name)
    if name == "affected_periods":
        rows = rows.drop("updated_at", "processing_run_id")
    return sorted(map(str, rows.collect()))


def statuses(store):
    return {(r.month_start, r.reason): r.status for r in store.read("affected_periods").collect()}


def test_stages_move_a_month_to_consumed(store, upstream, two_articles, config):
    assert pipeline.run_sync(store, upstream(*two_articles), NOW) == 2
    assert pipeline.run_detect(store, NOW) == 1
    assert statuses(store) == {(MARCH, "recent_sync"): "pending"}
    assert pipeline.run_extract(store, config, NOW) > 0
    assert statuses(store) == {(MARCH, "recent_sync"): "completed"}
    found = store.read("news_keywords").filter("canonical_keyword = 'Bahía Larga'")
    assert found.count() >= 1
    assert pipeline.run_build(store, NOW) == 1
    assert statuses(store) == {(MARCH, "recent_sync"): "consumed"}
    counts = {t: store.read(t).count() for t in ("monthly_overview", "daily_activity", "source_monthly_stats")}
    assert counts == {"monthly_overview": 1, "daily_activity": 2, "source_monthly_stats": 2}
    assert {(r.source_name, r.alias) for r in store.read("source_aliases").collect()} == {
        ("Fuente A", "Fuente 1"), ("Fuente B", "Fuente 2")}

    # a later run without new articles changes nothing
    later = NOW + dt.timedelta(days=10)
    before = {t: content(store, t) for t in TABLES if t != "processing_runs"}
    assert pipeline.run_incremental(store, upstream(*two_articles), config, later) == {
        "synced": 0, "periods": 0, "keyword_rows": 0, "built": 0}
    assert {t: content(store, t) for t in before} == before
    assert {r.status for r in store.read("processing_runs").collect()} == {"completed"}

    # every declared key is unique, every reference resolves, every code is known
    for name, key in KEYS.items():
        assert quality.duplicate_keys(store.read(name), key).count() == 0, name
    assert quality.orphans(store.read("news_keywords"), "raw_noticia_id", store.read("raw_news"), "id").count() == 0
    assert quality.domain_violations(store.all()).count() == 0
    checked = quality.constraint_report(store.all()).collect()
    assert {r.table_name for r in checked} == set(store.all()) and not [r for r in checked if r.violations]

    # the read side
    assert reports.select_month(store.read("monthly_overview"), "1999-01").first()[0] == MARCH
    home = reports.home_report(store.all(), MARCH)
    assert home["top_keywords"].first()["label"] == "Bahía Larga"
    assert [r.alias for r in home["sources"].collect()] == ["Fuente 1", "Fuente 2"]
    topic = reports.topic_report(store.all(), MARCH, "falla%20general")
    assert topic["keyword"] == "Corte de luz" or topic["normalized_keyword"]
    topic = reports.topic_report(store.all(), MARCH, "Corte De Luz", order="recent", source="fuente-1")
    assert topic["keyword"] == "Corte de luz"
    assert [r.id for r in topic["news"].collect()] == [1]
    assert topic["overview"].first()["news_count"] == 2
    with pytest.raises(LookupError):
        reports.topic_report(store.all(), MARCH, " %20 ")


def test_late_articles_reopen_and_match_a_full_rebuild(store, upstream, two_articles, config, spark, tmp_path):
    pipeline.run_incremental(store, upstream(*two_articles), config, NOW, extractors=FAST)
    later = NOW + dt.timedelta(days=40)
    late = (
        article(3, "Fuente C", "Nuevo corte de luz", BODY_1, dt.datetime(2024, 3, 2), later),
        # the title and the month of a known article change
        article(2, "Fuente B", "El Remanso: otra nota", "", dt.datetime(2024, 4, 20, 12), later),
    )
    done = pipeline.run_incremental(store, upstream(*late), config, later, extractors=FAST, skip_existing=False)
    assert done["synced"] == 2 and done["periods"] == 2 and done["built"] == 2
    assert {r.source_name: r.alias for r in store.read("source_aliases").collect()} == {
        "Fuente A": "Fuente 1", "Fuente B": "Fuente 2", "Fuente C": "Fuente 3"}
    assert sorted(map(tuple, store.read("raw_news").select("id", "month_start").collect())) == [
        (1, MARCH), (2, dt.date(2024, 4, 1)), (3, MARCH)]

    other = pipeline.open_store(spark, str(tmp_path / "other"))
    pipeline.run_sync(other, upstream(two_articles[0], *late), later, full=True)
    pipeline.run_extract(other, config, later, full=True, extractors=FAST)
    assert pipeline.run_build(other, later, full=True) == 2
    assert other.read("affected_periods").count() == 0  # a full build leaves the state alone
    for name in ("news_keywords", "monthly_keyword_stats", "daily_activity", "source_keyword_stats",
                 "source_monthly_stats", "monthly_overview"):
        assert content(store, name) == content(other, name), name


def test_moving_the_only_article_of_a_month_empties_it(store, upstream, config):
    first = article(1, "A", "Corte de luz", "", dt.datetime(2024, 1, 5))
    pipeline.run_incremental(store, upstream(first), config, NOW, extractors=FAST)
    later = NOW + dt.timedelta(days=40)
    moved = article(1, "A", "Corte de luz", "", dt.datetime(2024, 2, 5), later)
    pipeline.run_incremental(store, upstream(moved), config, later, extractors=FAST, skip_existing=False)
    assert [r.month_start for r in store.read("raw_news").collect()] == [dt.date(2024, 2, 1)]
    assert {r.month_start for r in store.read("news_keywords").collect()} == {dt.date(2024, 2, 1)}


@pytest.mark.parametrize("skip_existing", [True, False])
def test_a_moved_article_is_counted_in_its_new_month_only(store, upstream, config, skip_existing):
    only = ("dictionary",)
    stays = article(1, "A", "Corte de luz", "", dt.datetime(2024, 3, 5))
    moves = article(2, "B", "Corte de luz", "", dt.datetime(2024, 3, 6))
    pipeline.run_incremental(store, upstream(stays, moves), config, NOW, extractors=only)
    later = NOW + dt.timedelta(days=40)
    moved = article(2, "B", "Corte de luz", "", dt.datetime(2024, 4, 6), later)
    done = pipeline.run_incremental(store, upstream(moved), config, later, extractors=only, skip_existing=skip_existing)
    assert (done["synced"], done["built"]) == (1, 2)
    assert set(statuses(store).values()) == {"consumed"}
    april = dt.date(2024, 4, 1)
    pairs = lambda name, *columns: sorted(map(tuple, store.read(name).select(*columns).collect()))
    assert pairs("news_keywords", "month_start", "raw_noticia_id") == [(MARCH, 1), (april, 2)]
    assert pairs("news_keyword_processing", "month_start", "raw_noticia_id") == [(MARCH, 1), (april, 2)]
    for name in ("monthly_keyword_stats", "daily_activity"):
        assert pairs(name, "month_start", "news_count") == [(MARCH, 1), (april, 1)], name
    for name in ("source_keyword_stats", "source_monthly_stats"):
        assert pairs(name, "month_start", "source_media", "news_count") == [(MARCH, "A", 1), (april, "B", 1)], name
    assert pairs("monthly_overview", "month_start", "total_news", "news_with_keywords") == [(MARCH, 1, 1), (april, 1, 1)]


def test_sync_filters_and_deduplicates(store, upstream):
    old = NOW - dt.timedelta(hours=60)
    rows = upstream(
        article(1, "A", "uno", "", dt.datetime(2024, 3, 1), NOW, "h1"),
        article(2, "A", "uno, corregido", "", dt.datetime(2024, 3, 1), NOW, "h1"),
        article(3, "A", "viejo", "", dt.datetime(2024, 3, 1), old, "h3"),
        article(4, "A", "sin vector", "", dt.datetime(2024, 3, 1), NOW, "h4", embedded=False),
        article(5, None, "sin fuente", "", dt.datetime(2024, 3, 1), NOW, "h5"),
        article(6, "A", None, "", dt.datetime(2024, 3, 1), NOW, "h6"),
        article(7, "A", "sin fecha", "", None, NOW, "h7"),
    )
    assert pipeline.run_sync(store, rows, NOW) == 2
    assert sorted(r.titulo for r in store.read("raw_news").collect()) == ["sin fecha", "uno, corregido"]
    # re-sync under a new upstream number keeps the surrogate id
    pipeline.run_sync(store, upstream(article(9, "A", "nuevo", "", dt.datetime(2024, 3, 1), NOW, "h1")), NOW)
    row = store.read("raw_news").filter("noticia_hash = 'h1'").first()
    assert (row.id, row.upstream_id, row.titulo) == (2, 9, "nuevo")


def test_resume_skips_processed_articles_even_without_keywords(store, upstream, config):
    pipeline.run_sync(store, upstream(article(1, "A", "nada", "", dt.datetime(2024, 3, 1))), NOW)
    pipeline.run_extract(store, config, NOW, period=MARCH, extractors=("dictionary",))
    marker = store.read("news_keyword_processing").first()
    assert (marker.status, marker.keyword_rows) == ("completed", 0)
    dry = pipeline.run_extract(store, config, NOW, period=MARCH, dry_run=True, extractors=FAST)
    assert dry.count() == 0  # nothing left to do
    dry = pipeline.run_extract(store, config, NOW, period=MARCH, dry_run=True, skip_existing=False, extractors=FAST,
                               limit_news=1)
    assert store.read("news_keywords").count() == 0 and dry.columns


def test_newly_omitted_keywords_are_pruned(store, upstream, two_articles, config):
    pipeline.run_sync(store, upstream(*two_articles), NOW)
    pipeline.run_extract(store, config, NOW, period=MARCH, extractors=FAST)
    stricter = KeywordConfig(config.entries, config.omitted | {"el remanso"})
    assert store.read("news_keywords").filter("normalized_keyword = 'el remanso'").count() > 0
    pipeline.run_extract(store, stricter, NOW, period=MARCH, extractors=FAST)
    assert store.read("news_keywords").filter("normalized_keyword = 'el remanso'").count() == 0
    assert store.read("monthly_keyword_stats").filter("normalized_keyword = 'el remanso'").count() == 0


def test_failed_run_is_recorded(store, upstream, two_articles):
    with pytest.raises(Exception):
        pipeline.run_sync(store, upstream(*two_articles).withColumn("id", F.expr("raise_error('broken')")), NOW)
    run = store.read("processing_runs").first()
    assert run.status == "failed" and "broken" in run.notes


def test_parameters_are_checked(store, config, upstream, two_articles):
    for call in (
        lambda: pipeline.run_sync(store, upstream(*two_articles), NOW, lookback_hours=0),
        lambda: pipeline.run_detect(store, NOW, lookback_hours=-1),
        lambda: pipeline.run_extract(store, config, NOW, limit_news=3),
        lambda: pipeline.run_extract(store, config, NOW, period=MARCH, max_keyphrases=0),
    ):
        with pytest.raises(ValueError):
            call()


def test_state_machine(spark, store):
    state = spark.createDataFrame(
        [("r", 2024, m, dt.date(2024, m, 1), s, "recent_sync", 1, NOW) for m, s in
         enumerate(("pending", "processing", "completed", "consumed", "failed", "skipped"), 1)],
        TABLES["affected_periods"],
    )
    month = lambda m: dt.date(2024, m, 1)
    names = lambda rows: [r.month_start.month for r in rows.collect()]
    assert names(periods.months_to_extract(state)) == [1, 2]
    assert names(periods.months_to_extract(state, retry_failed=True)) == [1, 2, 5]
    assert names(periods.months_to_build(state)) == [3]
    assert names(periods.months_to_build(state, include_processing=True)) == [2, 3]
    after = periods.mark_consumed(state, [month(m) for m in (1, 2, 3)], NOW)
    assert [r.status for r in after.orderBy("month").collect()] == [
        "pending", "consumed", "consumed", "consumed", "failed", "skipped"]
    detected = spark.createDataFrame([(month(4), 2024, 4, 7), (month(9), 2024, 9, 1)],
                                     "month_start date, year int, month int, rows_detected bigint")
    redone = periods.upsert_periods(after, detected, "recent_sync", "r2", NOW)
    by_month = {r.month: r for r in redone.collect()}
    assert (by_month[4].status, by_month[4].rows_detected, by_month[9].status, len(by_month)) == ("pending", 7, "pending", 7)
    assert names(periods.reopened(after, redone)) == [4]


def test_totals_agree_between_tables(store, upstream, two_articles, config):
    pipeline.run_incremental(store, upstream(*two_articles), config, NOW, extractors=FAST)
    total = store.read("monthly_overview").first()["total_news"]
    assert total == store.read("daily_activity").agg(F.sum("news_count")).first()[0]
    assert total == store.read("source_monthly_stats").agg(F.sum("news_count")).first()[0]
    row = store.read("monthly_keyword_stats").filter("normalized_keyword = 'corte de luz'").first()
    assert row.source_media_stats == {"Fuente A": 1, "Fuente B": 1} and row.priority == 8
    assert stats.daily_activity(store.read("raw_news")).count() == 2


def test_a_requested_month_without_articles_is_reported_empty(store, upstream, two_articles):
    pipeline.run_sync(store, upstream(*two_articles), NOW)
    assert pipeline.run_build(store, NOW, period=dt.date(2020, 2, 1)) == 1
    row = store.read("monthly_overview").first()
    assert (row.month_start, row.total_news, row.top_keywords) == (dt.date(2020, 2, 1), 0, [])
    assert reports.month_list(store.read("monthly_overview")).count() == 0


def test_writes_measure_themselves(store, spark):
    rows = spark.range(7).select(F.col("id"), F.when(F.col("id") < 3, F.col("id")).alias("some"))
    figures = {"written": F.count(F.lit(1)), "some": F.count("some"), "total": F.sum("id")}
    staged, seen = store.stage_measured("run", "seven", rows, **figures)
    assert seen == {"written": 7, "some": 3, "total": 21} and staged.count() == 7
    for nothing in (rows.filter("id > 9"), spark.createDataFrame([], rows.schema)):
        assert store.stage_measured("run", f"none{nothing.schema}"[:4], nothing, **figures)[1] == {"written": 0, "some": 0, "total": 0}
