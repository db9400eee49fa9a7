"""Affected months: detection, state machine and selection.

The state table has one row per month and reason, so it is bounded by the calendar, not by the data.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import month_start, since

REASONS = {"full": "full_refresh", "synced_at": "recent_sync", "fecha_extraccion": "recent_extraction"}


def affected_periods(
    news: DataFrame, mode: str = "synced_at", now: dt.datetime | None = None, hours: int = 48
) -> DataFrame:
    """Months touched by recently synced or extracted articles (or all months) with their row counts."""
    rows = news.filter(F.col("fecha_publicacion").isNotNull())
    if mode != "full":
        rows = rows.filter(since(F.col(mode), now, hours))
    published = F.col("fecha_publicacion")
    return rows.groupBy(
        month_start(published).alias("month_start"), F.year(published).alias("year"),
        F.month(published).alias("month"),
    ).agg(F.count(F.lit(1)).alias("rows_detected"))


def upsert_periods(
    stored: DataFrame, detected: DataFrame, reason: str, run_id: str, now: dt.datetime
) -> DataFrame:
    """State after a detection: every detected month becomes pending again, whatever it was before."""
    new = detected.select("month_start", F.lit(reason).alias("reason"), "year", "month", "rows_detected")
    s, d = stored.alias("s"), new.alias("d")
    joined = s.join(
        d, (F.col("s.month_start") == F.col("d.month_start")) & (F.col("s.reason") == F.col("d.reason")),
        "full_outer",
    )
    hit = F.col("d.month_start").isNotNull()
    fresh = {
        "processing_run_id": F.lit(run_id), "status": F.lit("pending"),
        "updated_at": F.lit(now).cast("timestamp_ntz"),
    }
    return joined.select(*[
        F.when(hit, fresh.get(c, F.col(f"d.{c}") if c in new.columns else None)).otherwise(F.col(f"s.{c}")).alias(c)
        for c in stored.columns
    ])


def mark_periods(
    state: DataFrame, months: list[dt.date], status: str, now: dt.datetime, only: tuple[str, ...] | None = None
) -> DataFrame:
    """Move the given months to ``status``; ``only`` restricts the statuses they may come from."""
    chosen = F.col("month_start").isin(*months) if months else F.lit(False)
    if only:
        chosen = chosen & F.col("status").isin(*only)
    return state.withColumns({
        "status": F.when(chosen, F.lit(status)).otherwise(F.col("status")),
        "updated_at": F.when(chosen, F.lit(now).cast("timestamp_ntz")).otherwise(F.col("updated_at")),
    })


def mark_consumed(state: DataFrame, months: list[dt.date], now: dt.datetime) -> DataFrame:
    """Months whose aggregates were built: completed or processing becomes consumed."""
    return mark_periods(state, months, "consumed", now, ("completed", "processing"))


def select_months(state: DataFrame, *statuses: str) -> DataFrame:
    return state.filter(F.col("status").isin(*statuses)).select("month_start").distinct().orderBy("month_start")


def months_to_extract(state: DataFrame, retry_failed: bool = False) -> DataFrame:
    return select_months(state, "pending", "processing", *(["failed"] if retry_failed else []))


def months_to_build(state: DataFrame, include_processing: bool = False) -> DataFrame:
    return select_months(state, "completed", *(["processing"] if include_processing else []))


def distinct_months(news: DataFrame) -> DataFrame:
    """Every month with a published article."""
    return news.filter(F.col("fecha_publicacion").isNotNull()).select(
        month_start(F.col("fecha_publicacion")).alias("month_start")
    ).distinct().orderBy("month_start")


def reopened(before: DataFrame, after: DataFrame) -> DataFrame:
    """Months that a detection moved from consumed back to pending."""
    old = before.filter("status = 'consumed'").select("month_start", "reason")
    return after.filter("status = 'pending'").join(old, ["month_start", "reason"], "left_semi")


def run_summary(periods: DataFrame) -> DataFrame:
    return periods.agg(
        F.count(F.lit(1)).alias("periods"), F.coalesce(F.sum("rows_detected"), F.lit(0)).alias("rows_detected")
    )


def semi_join_months(rows: DataFrame, months: DataFrame) -> DataFrame:
    """Rows of the given months.  The month list is bounded by the calendar."""
    return rows.join(months.select("month_start").distinct(), "month_start", "left_semi")
