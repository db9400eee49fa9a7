"""The four jobs of the pipeline, and their chain.

Each job handles all selected months at once.  Lists of months are the only thing that reaches the driver.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import month_start
from ..operators import hits as hit_ops
from ..operators import ingest, periods, stats
from ..operators.aliases import source_aliases
from ..operators.upsert import upsert
from ..schemas import TABLES
from ..sources.dictionary import KeywordConfig, config_aliases, sync_aliases, sync_dictionary
from ..sources.tables import TableStore

Month = dt.date | None


def in_months(months: list[Month]) -> Column:
    known = [m for m in months if m is not None]
    chosen = F.col("month_start").isin(*known) if known else F.lit(False)
    return chosen | F.col("month_start").isNull() if None in months else chosen


def month_values(rows: DataFrame) -> list[Month]:
    """Distinct months of a DataFrame; bounded by the calendar."""
    return sorted((r[0] for r in rows.select("month_start").distinct().collect()), key=str)


@dataclass
class Run:
    run_id: str
    rows_detected: int = 0


@contextmanager
def processing_run(
    store: TableStore, stage: str, now: dt.datetime, full: bool, hours: int | None = None, notes: str | None = None
) -> Iterator[Run]:
    """Ledger entry of a job: running, then completed or failed. Staged results go when the job ends."""
    run = Run(f"{stage}-{now:%Y%m%dT%H%M%S%f}")

    def record(status: str, finished: bool, note: str | None) -> None:
        row = (
            run.run_id, stage, "full" if full else "incremental", status, now, now if finished else None,
            None if full else hours, run.rows_detected, note,
        )
        entry = store.spark.createDataFrame([row], TABLES["processing_runs"])
        store.replace("processing_runs", upsert(store.read("processing_runs"), entry, ("run_id",)))

    record("running", False, notes)
    try:
        yield run
    except Exception as error:
        record("failed", True, str(error))
        raise
    finally:
        store.drop_stage(run.run_id)
    record("completed", True, notes)


def _positive(name: str, value: int | None) -> None:
    if value is not None and value <= 0:
        raise ValueError(f"{name} must be greater than 0")


def run_sync(
    store: TableStore, upstream: DataFrame, now: dt.datetime, full: bool = False, lookback_hours: int = 48
) -> int:
    """Copy new or changed upstream articles; returns how many rows were upserted.

    Months that an article leaves because its date changed become pending: nothing in them tells a later detection.
    """
    _positive("lookback_hours", None if full else lookback_hours)
    with processing_run(store, "sync", now, full, lookback_hours) as run:
        columns = upstream.select(*ingest.SOURCE_COLUMNS)
        batch = ingest.valid_news(columns) if full else ingest.incremental_news(columns, now, lookback_hours)
        prepared = ingest.prepare_batch(batch, now).withColumn("month_start", month_start(F.col("fecha_publicacion")))
        staged, seen = store.stage_measured(run.run_id, "batch", prepared, written=F.count(F.lit(1)))
        run.rows_detected = seen["written"]
        if run.rows_detected:
            stored = store.read("raw_news")
            to = staged.select("noticia_hash", F.col("month_start").alias("new_month"))
            known = stored.select("noticia_hash", "month_start").join(to, "noticia_hash")
            left, gone = store.stage_measured(run.run_id, "left", known.filter(
                ~F.col("month_start").eqNullSafe(F.col("new_month"))
            ).groupBy("month_start").agg(F.count(F.lit(1)).alias("rows_detected")), dated=F.count("month_start"))
            months = sorted({*month_values(staged), *month_values(left)}, key=str)
            # before the articles move, so that a run that dies in between is made up for by the next one
            if gone["dated"]:
                _reopen(store, left.filter("month_start IS NOT NULL"), run.run_id, now)
            rows = ingest.news_upsert(stored.filter(in_months(months)), staged, now, is_prepared=True)
            store.replace_months("raw_news", rows, months)
    return run.rows_detected


def _reopen(store: TableStore, months: DataFrame, run_id: str, now: dt.datetime) -> None:
    """Mark months as pending that a sync took articles from."""
    found = months.select(
        "month_start", F.year("month_start").alias("year"), F.month("month_start").alias("month"), "rows_detected"
    )
    store.replace("affected_periods", periods.upsert_periods(
        store.read("affected_periods"), found, periods.REASONS["synced_at"], run_id, now
    ))


def run_detect(
    store: TableStore, now: dt.datetime, full: bool = False, lookback_hours: int = 48,
    from_extraction_date: bool = False,
) -> int:
    """Mark the months touched recently as pending; returns how many."""
    _positive("lookback_hours", None if full else lookback_hours)
    mode = "full" if full else ("fecha_extraccion" if from_extraction_date else "synced_at")
    with processing_run(store, "detect", now, full, lookback_hours, f"detect affected periods by {mode}") as run:
        found, total = store.stage_measured(
            run.run_id, "periods", periods.affected_periods(store.read("raw_news"), mode, now, lookback_hours),
            periods=F.count(F.lit(1)), rows_detected=F.sum("rows_detected"),
        )
        run.rows_detected = total["rows_detected"]
        if total["periods"]:
            state = periods.upsert_periods(
                store.read("affected_periods"), found, periods.REASONS[mode], run.run_id, now
            )
            store.replace("affected_periods", state)
    return total["periods"]


def sync_config(store: TableStore, config: KeywordConfig) -> None:
    """Bring the stored dictionary and aliases in line with the configuration."""
    spark = store.spark
    store.replace("keyword_dictionary", sync_dictionary(store.read("keyword_dictionary"), config.dictionary_df(spark)))
    aliases = config_aliases(config.entries_df(spark))
    store.replace("keyword_aliases", sync_aliases(store.read("keyword_aliases"), aliases, store.read("keyword_dictionary")))


def _mark(store: TableStore, months: list[dt.date], status: str, now: dt.datetime) -> None:
    store.replace("affected_periods", periods.mark_periods(
        store.read("affected_periods"), months, status, now, ("pending", "processing", "failed")
    ))


def run_extract(
    store: TableStore, config: KeywordConfig, now: dt.datetime, full: bool = False, period: dt.date | None = None,
    retry_failed: bool = False, skip_existing: bool = True, reset_period: bool = False,
    limit_news: int | None = None, dry_run: bool = False, max_text_chars: int | None = None,
    max_keyphrases: int = 12, extractors: tuple[str, ...] = hit_ops.ALL_EXTRACTORS,
    load_annotator: Callable | None = None,
) -> int | DataFrame:
    """Extract keywords of the selected months and refresh their keyword statistics.

    Returns the number of keyword rows, or with ``dry_run`` the rows themselves, unsaved.
    """
    _positive("limit_news", limit_news)
    _positive("max_keyphrases", max_keyphrases)
    if limit_news is not None and period is None:
        raise ValueError("limit_news needs a period")

    def chosen_months() -> list[dt.date]:
        if period:
            return [period]
        if full:
            return month_values(periods.distinct_months(store.read("raw_news")))
        return month_values(periods.months_to_extract(store.read("affected_periods"), retry_failed))

    def documents_of(news: DataFrame) -> DataFrame:
        return hit_ops.to_documents(news, max_text_chars)

    def hits_of(documents: DataFrame) -> DataFrame:
        return hit_ops.news_keywords(documents, config, extractors, load_annotator, max_keyphrases)

    def selected(months: list[dt.date]) -> DataFrame:
        news = store.read("raw_news").filter(in_months(months))
        if skip_existing and not reset_period:
            # a marker left under another month is of an article whose date has changed since
            markers = store.read("news_keyword_processing").filter(in_months(months))
            news = ingest.unprocessed_news(news, markers, by_month=True)
        return ingest.month_sample(news, period, limit_news) if limit_news else news

    if dry_run:
        return hits_of(documents_of(selected(chosen_months())))

    with processing_run(store, "extract", now, full, notes="extract keywords") as run:
        sync_config(store, config)
        months = chosen_months()
        if not months:
            return 0
        by_state = not (full or period)
        if by_state:
            _mark(store, months, "processing", now)
        news = selected(months)
        documents = store.stage(run.run_id, "documents", documents_of(news))  # all extractors read the cleaned texts
        hits, found = store.stage_measured(run.run_id, "hits", hits_of(documents), written=F.count(F.lit(1)))
        store.drop_stage(run.run_id, "documents")  # the largest of them, ahead of the tables' writes
        per_article = hits.groupBy(F.col("raw_noticia_id").alias("id")).agg(F.count(F.lit(1)).alias("n"))
        markers, marked = store.stage_measured(run.run_id, "markers", news.select("id", "month_start").join(per_article, "id", "left").select(
            F.col("id").alias("raw_noticia_id"), "month_start", F.lit("completed").alias("status"),
            F.coalesce("n", F.lit(0)).cast("int").alias("keyword_rows"),
            F.lit(run.run_id).alias("updated_from_run_id"), F.lit(now).cast("timestamp_ntz").alias("processed_at"),
        ), written=F.count(F.lit(1)))
        run.rows_detected = marked["written"]
        touched = set(months)
        for table, fresh in (("news_keywords", hits), ("news_keyword_processing", markers)):
            touched.update(_replace_articles(store, table, fresh, markers, months, reset_period, config))
        rebuilt = sorted(touched, key=str)
        kept = store.read("news_keywords").filter(in_months(rebuilt))
        store.replace_months(
            "monthly_keyword_stats", stats.monthly_keyword_stats(kept, store.read("keyword_dictionary")), rebuilt
        )
        if by_state:
            _mark(store, months, "completed", now)
        return found["written"]


def _replace_articles(
    store: TableStore, table: str, fresh: DataFrame, done: DataFrame, months: list[dt.date], reset: bool,
    config: KeywordConfig,
) -> list[Month]:
    """Replace everything a table holds about the processed articles, wherever it was filed before.

    Returns the months rewritten.
    """
    stored = store.read(table)
    ids = done.select("raw_noticia_id")
    elsewhere = month_values(stored.filter(~in_months(months)).join(ids, "raw_noticia_id", "left_semi"))
    old = stored.filter(in_months([*months, *elsewhere])).join(ids, "raw_noticia_id", "left_anti")
    if reset:
        old = old.filter(~in_months(months))
    rows = old.unionByName(fresh.select(*old.columns))
    if table == "news_keywords" and config.omitted:
        rows = hit_ops.prune_omitted(rows, config.omitted_df(store.spark), months)
    store.replace_months(table, rows, [*months, *elsewhere])
    return [*months, *elsewhere]


def build_months(store: TableStore, months: list[dt.date]) -> None:
    """Rebuild the aggregate tables of the months."""
    news = store.read("raw_news").filter(in_months(months))
    hits = store.read("news_keywords").filter(in_months(months))

    def current(name: str) -> DataFrame:
        return store.read(name).filter(in_months(months))

    store.replace_months("daily_activity", stats.daily_activity(news), months)
    store.replace_months("source_keyword_stats", stats.source_keyword_stats(hits), months)
    store.replace_months(
        "source_monthly_stats", stats.source_monthly_stats(news, current("source_keyword_stats")), months
    )
    asked = store.spark.createDataFrame([(m,) for m in months], "month_start date")
    store.replace_months("monthly_overview", stats.monthly_overview(
        news, hits, current("monthly_keyword_stats"), current("source_monthly_stats"), asked
    ), months)


def run_build(
    store: TableStore, now: dt.datetime, full: bool = False, period: dt.date | None = None,
    include_processing: bool = False,
) -> int:
    """Build the aggregates of the selected months and name their sources; returns how many months.

    The months become consumed, except in a full build, which leaves the state alone.
    """
    with processing_run(store, "build", now, full, notes="build monthly aggregates") as run:
        if period:
            months = [period]
        elif full:
            months = month_values(periods.distinct_months(store.read("raw_news")))
        else:
            months = month_values(periods.months_to_build(store.read("affected_periods"), include_processing))
        if months:
            build_months(store, months)
            if not full:
                store.replace("affected_periods", periods.mark_consumed(store.read("affected_periods"), months, now))
            seen = store.read("source_monthly_stats").filter(in_months(months))
            store.replace("source_aliases", source_aliases(seen, store.read("source_aliases"), now))
        run.rows_detected = len(months)
    return run.rows_detected


def run_incremental(
    store: TableStore, upstream: DataFrame, config: KeywordConfig, now: dt.datetime, lookback_hours: int = 48,
    **extract_options,
) -> dict[str, int]:
    """Sync, detect, extract, build. A failing step stops the chain."""
    return {
        "synced": run_sync(store, upstream, now, lookback_hours=lookback_hours),
        "periods": run_detect(store, now, lookback_hours=lookback_hours),
        "keyword_rows": run_extract(store, config, now, **extract_options),
        "built": run_build(store, now),
    }


def open_store(spark: SparkSession, root: str) -> TableStore:
    return TableStore(spark, root)
