"""Articles closest to one article by the cosine of their embeddings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity of two arrays of equal length, in double precision."""
    def dot(x: Column, y: Column) -> Column:
        products = F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double"))
        return F.aggregate(products, F.lit(0.0), lambda acc, v: acc + v)

    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def nearest_articles(news: DataFrame, article_id: int, top: int = 10) -> DataFrame:
    """Articles closest to one article.  A single pass over the vectors; tasks keep their best rows only."""
    target = news.filter(F.col("id") == article_id).agg(F.any_value("embedding")).scalar()
    others = news.filter(F.col("embedding").isNotNull() & (F.col("id") != article_id)).select(
        "id", "embedding", target.alias("target")
    ).filter(F.col("target").isNotNull())
    return others.select("id", F.round(cosine(F.col("embedding"), F.col("target")), 6).alias("similarity")).orderBy(
        F.desc("similarity"), "id"
    ).limit(top)
