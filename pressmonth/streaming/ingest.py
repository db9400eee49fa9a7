"""Article stream: idempotent micro-batches into the raw table, with the touched months marked pending."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.dates import month_start
from ..operators.upsert import upsert
from ..plans.pipeline import in_months, month_values, run_detect, run_sync
from ..schemas import UPSTREAM
from ..sources.tables import TableStore


def news_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Upstream articles that arrive as Parquet files."""
    reader = spark.readStream.schema(UPSTREAM)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def ingest_stream(
    store: TableStore, stream: DataFrame, checkpoint: str, clock: Callable[[], dt.datetime],
    lookback_hours: int = 48,
) -> StreamingQuery:
    """Process what has arrived and stop.

    Late articles are never dropped (there is no watermark): they reopen their month.  A replayed
    micro-batch upserts the same rows again, so the outcome does not change.  Articles without an embedding
    are left out, as in an incremental batch.
    """

    def on_batch(batch: DataFrame, _: int) -> None:
        now = clock()
        run_sync(store, batch.filter("embedding IS NOT NULL"), now, full=True)
        run_detect(store, now, lookback_hours=lookback_hours)

    return (
        stream.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def daily_counts(stream: DataFrame, timestamp: str = "fecha_publicacion") -> DataFrame:
    """Articles per day over a stream (for ``update`` or ``complete`` output); state is one row per day."""
    return stream.filter(F.col(timestamp).isNotNull()).groupBy(
        F.window(F.col(timestamp), "1 day").alias("day")
    ).agg(F.count(F.lit(1)).alias("news_count")).select(
        F.to_date("day.start").alias("activity_date"), "news_count"
    )


def daily_table(store: TableStore, stream: DataFrame, checkpoint: str) -> StreamingQuery:
    """Keep ``daily_activity`` up to date from a stream of articles: each batch rewrites the months of its changed days.

    The counts come in update mode, so a batch brings the new totals of the days it touched.  A replayed batch brings
    the same totals again and changes nothing.
    """

    def on_batch(batch: DataFrame, number: int) -> None:
        run = f"daily-{number}"
        fresh = store.stage(run, "days", batch.withColumn("month_start", month_start(F.col("activity_date"))))
        months = month_values(fresh)
        if months:
            stored = store.read("daily_activity").filter(in_months(months))
            store.replace_months("daily_activity", upsert(stored, fresh, ("month_start", "activity_date")), months)
        store.drop_stage(run)

    return (
        daily_counts(stream).writeStream.outputMode("update").foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
