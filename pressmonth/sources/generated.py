"""The driver's generated tables seen as a news archive.

Articles are the documents; publication and extraction times come from the order and event that share the
document's number, embeddings from the vector with that number.  Only the carriers that the requested
columns need are joined.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.lineage import spread
from ..schemas import NEWS_COLUMNS

# A clock inside the generated event stream: 48 hours back selects a proper part of the articles.
NOW = dt.datetime(2024, 1, 4)
SYNC_DELAY_HOURS = 6

FROM_TEXT = ("titulo", "texto_completo")
FROM_ORDERS = ("fecha_publicacion",)
FROM_EVENTS = ("fecha_extraccion", "synced_at")
FROM_EMBEDDINGS = ("embedding",)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def news(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """News rows with the given columns (all of them by default)."""
    wanted = columns or tuple(NEWS_COLUMNS)
    articles = table(spark, sf_dir, "documents")
    if set(wanted) & set(FROM_TEXT):
        articles = spread(articles)
    if set(wanted) & set(FROM_ORDERS):
        orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
        articles = articles.join(orders, F.col("doc_id") == F.col("o_orderkey"), "left")
    if set(wanted) & set(FROM_EVENTS):
        events = table(spark, sf_dir, "events").select("event_id", "ts")
        articles = articles.join(events, F.col("doc_id") == F.col("event_id"), "left")
    if set(wanted) & set(FROM_EMBEDDINGS):
        vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
        articles = articles.join(vectors, F.col("doc_id") == F.col("vec_id"), "left")
    expressions = {
        "id": F.col("doc_id"),
        "upstream_id": F.col("doc_id"),
        "noticia_hash": F.md5(F.col("doc_id").cast("string")),
        "fuente": F.col("source"),
        "url_original": F.concat(F.lit("https://"), "source", F.lit(".example/"), F.col("doc_id").cast("string")),
        "titulo": F.substring_index("text", "\n", 1),
        "texto_completo": F.col("text"),
        "url_imagen": F.lit(None).cast("string"),
        "fecha_publicacion": F.col("o_orderdate"),
        "fecha_extraccion": F.col("ts"),
        "embedding": F.col("embedding"),
        "synced_at": F.expr(f"ts + interval {SYNC_DELAY_HOURS} hours"),
    }
    return articles.select(*[expressions[c].alias(c) for c in wanted])
