"""Related keywords of every month: all pairs of keywords whose articles overlap enough, without forming all pairs.

Keywords found in exactly the same articles of a month form a class (one grouped sum of hashes tells them), and the
least of them stands for it: copies are not expanded into pairs.  Between classes a prefix filter finds the candidates.
Articles are ordered by their number of keywords; two sets with Jaccard similarity t share one of the first
n - ceil(t n) + 1 articles of each in that order, so only these prefixes meet, on articles with few keywords first.
Prefixes are taken by whole steps of that order, from counts, so a keyword in very many articles is never sorted or
collected in one task.  Candidates whose sizes alone rule them out go, and so do those that share too few articles of
their prefixes: of two sets, all that the one with the shorter reach shares beyond its prefix are its other articles.
For the rest, which are little more than the similar ones, the shared articles are counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..plans.lineage import computed_once

PERCENT = 50
_SEED = 7  # of the second of two independent hashes


def presence(hits: DataFrame) -> DataFrame:
    """Which keyword occurs in which article of a month, once."""
    return hits.select("month_start", F.col("raw_noticia_id").alias("article"), F.col("normalized_keyword").alias("keyword")).distinct()


def keyword_classes(present: DataFrame) -> DataFrame:
    """(month_start, keyword, articles, class): ``class`` is the least keyword of the month with the same articles."""
    prints = [F.sum(h.cast("decimal(38,0)")) for h in (F.xxhash64("article"), F.xxhash64("article", F.lit(_SEED)))]
    sets = present.groupBy("month_start", "keyword").agg(
        F.count(F.lit(1)).alias("articles"), prints[0].alias("print_a"), prints[1].alias("print_b")
    )
    same = ["month_start", "articles", "print_a", "print_b"]
    return sets.join(sets.groupBy(*same).agg(F.min("keyword").alias("class")), same).select(
        "month_start", "keyword", "articles", "class"
    )


def prefixes(present: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The articles of each keyword that a similar one must share one of, with the keyword's number of ``articles``,
    the number ``beyond`` the prefix, and its ``reach``: the prefix has all articles with at most so many keywords."""
    crowds = present.groupBy("month_start", "article").agg(F.count(F.lit(1)).alias("crowd"))
    placed = present.join(crowds, ["month_start", "article"])
    steps = placed.groupBy("month_start", "keyword", "crowd").agg(F.count(F.lit(1)).alias("n"))
    # one row for each size of article: few, however many articles there are
    own = Window.partitionBy("month_start", "keyword")
    ahead = F.coalesce(F.sum("n").over(own.orderBy("crowd").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    total = F.sum("n").over(own)
    wanted = total - F.ceil(total * percent / 100) + 1
    inside = steps.select(
        "month_start", "keyword", "crowd", "n", total.alias("articles"), (ahead < wanted).alias("inside")
    ).filter("inside").select(
        "month_start", "keyword", "crowd", "articles", (F.col("articles") - F.sum("n").over(own)).alias("beyond"),
        F.max("crowd").over(own).alias("reach"),
    )
    return placed.join(inside, ["month_start", "keyword", "crowd"]).select(
        "month_start", "keyword", "article", "articles", "beyond", "reach"
    )


def _similar(shared: Column, a: Column, b: Column, percent: int) -> Column:
    return 100 * shared >= percent * (a + b - shared)


def candidate_links(first: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Pairs of keywords, by their :func:`prefixes`, that may be similar by their sizes and by what the prefixes share."""
    a, b = first.alias("a"), first.alias("b")
    pairs = a.join(b, (F.col("a.month_start") == F.col("b.month_start")) & (F.col("a.article") == F.col("b.article"))
                   & (F.col("a.keyword") < F.col("b.keyword")))
    least, most = F.least("a.articles", "b.articles"), F.greatest("a.articles", "b.articles")
    # what two sets may share besides the articles that both prefixes have
    beyond = F.when(F.col("a.reach") < F.col("b.reach"), F.col("a.beyond")).when(
        F.col("a.reach") > F.col("b.reach"), F.col("b.beyond")).otherwise(F.least("a.beyond", "b.beyond"))
    met = pairs.filter(100 * least >= percent * most).select(
        "a.month_start", F.col("a.keyword").alias("keyword"), F.col("b.keyword").alias("related"),
        F.col("a.articles").alias("n_keyword"), F.col("b.articles").alias("n_related"), beyond.alias("beyond"),
    ).groupBy("month_start", "keyword", "related", "n_keyword", "n_related").agg(
        (F.count(F.lit(1)) + F.max("beyond")).alias("most")
    )
    return met.filter(_similar(F.col("most"), F.col("n_keyword"), F.col("n_related"), percent)).drop("most")


def keyword_links(present: DataFrame, classes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(month_start, keyword, related, shared, jaccard): every two classes similar enough, the lesser name first."""
    leaders = classes.filter(F.col("keyword") == F.col("class")).select("month_start", "keyword")
    chosen = computed_once(present.join(leaders, ["month_start", "keyword"], "left_semi"))
    first = computed_once(prefixes(chosen, percent))
    candidates = candidate_links(first, percent)
    others = chosen.select("month_start", F.col("keyword").alias("related"), "article")
    counted = candidates.join(chosen, ["month_start", "keyword"]).join(others, ["month_start", "related", "article"]).groupBy(
        *candidates.columns
    ).agg(F.count(F.lit(1)).alias("shared"))
    return counted.filter(_similar(F.col("shared"), F.col("n_keyword"), F.col("n_related"), percent)).select(
        "month_start", "keyword", "related", "shared",
        F.round(F.col("shared") / (F.col("n_keyword") + F.col("n_related") - F.col("shared")), 6).alias("jaccard"),
    )
