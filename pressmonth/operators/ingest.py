"""Upstream scan, incremental filter and the article upsert."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import in_month, month_start, since
from .upsert import latest_per_key, upsert

SOURCE_COLUMNS = (
    "id", "noticia_hash", "fuente", "url_original", "titulo", "texto_completo", "url_imagen",
    "fecha_publicacion", "fecha_extraccion", "embedding",
)


def valid_news(upstream: DataFrame, columns: tuple[str, ...] | None = None) -> DataFrame:
    """Articles with hash, link and title."""
    complete = (
        F.col("noticia_hash").isNotNull() & F.col("url_original").isNotNull() & F.col("titulo").isNotNull()
    )
    return upstream.filter(complete).select(*(columns or upstream.columns))


def incremental_news(upstream: DataFrame, now: dt.datetime, hours: int = 48) -> DataFrame:
    """Valid articles indexed in the last ``hours`` that already have an embedding."""
    return valid_news(upstream.filter(
        since(F.col("fecha_extraccion"), now, hours) & F.col("embedding").isNotNull()
    ))


def news_page(
    upstream: DataFrame, limit: int, offset: int = 0, after: tuple[dt.datetime, int] | None = None
) -> DataFrame:
    """One page in extraction order.  ``after`` (the last time and id seen) resumes without re-sorting what
    was already read; the pipeline itself reads everything in one parallel scan and never pages."""
    rows = valid_news(upstream)
    if after is not None:
        moment = F.lit(after[0]).cast("timestamp_ntz")
        rows = rows.filter(
            (F.col("fecha_extraccion") > moment)
            | ((F.col("fecha_extraccion") == moment) & (F.col("id") > after[1]))
        )
    return rows.orderBy(F.asc_nulls_last("fecha_extraccion"), "id").offset(offset).limit(limit)


def _newest_first() -> list[Column]:
    return [F.desc_nulls_last("fecha_extraccion"), F.desc("id")]


def prepare_batch(batch: DataFrame, now: dt.datetime) -> DataFrame:
    """Batch as stored rows: newest copy per hash, null sources left out, stamped with the sync time."""
    unique = latest_per_key(batch.filter(F.col("fuente").isNotNull()), ("noticia_hash",), *_newest_first())
    return unique.withColumns({
        "upstream_id": F.col("id"),
        "synced_at": F.lit(now).cast("timestamp_ntz"),
    })


def rejected_batch(batch: DataFrame) -> DataFrame:
    """Rows that :func:`prepare_batch` leaves out because their source is unknown."""
    return batch.filter(F.col("fuente").isNull())


def news_upsert(stored: DataFrame, batch: DataFrame, now: dt.datetime, is_prepared: bool = False) -> DataFrame:
    """Stored articles after the batch.  An article that was stored before keeps its surrogate id.

    What :func:`prepare_batch` has returned (``is_prepared``) is not prepared a second time, which would move all texts.
    """
    prepared = batch if is_prepared else prepare_batch(batch, now)
    known = stored.select("noticia_hash", F.col("id").alias("known_id"))
    numbered = prepared.join(known, "noticia_hash", "left").withColumn("id", F.coalesce("known_id", "id"))
    if "month_start" in stored.columns:
        numbered = numbered.withColumn("month_start", month_start(F.col("fecha_publicacion")))
    return upsert(stored, numbered, ("noticia_hash",))


def month_slice(news: DataFrame, month: dt.date) -> DataFrame:
    return news.filter(in_month(F.col("fecha_publicacion"), month))


def month_sample(news: DataFrame, month: dt.date, limit: int) -> DataFrame:
    """First articles of a month in publication order (smoke runs)."""
    return month_slice(news, month).orderBy("fecha_publicacion", "id").limit(limit)


def unprocessed_news(news: DataFrame, markers: DataFrame, by_month: bool = False) -> DataFrame:
    """Articles without a completed extraction marker; ``by_month`` asks for one filed under the article's month."""
    done = markers.filter(F.col("status") == "completed").withColumnRenamed("raw_noticia_id", "id")
    key = ["id", "month_start"] if by_month else ["id"]
    return news.join(done.select(*key), key, "left_anti")
