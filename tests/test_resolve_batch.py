"""Topics of many requests: the two ways to look for texts within others, and keywords that stay where they are."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pressmonth.plans import reports


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def topics(spark, rows, months=1):
    table = spark.createDataFrame([(f"w{i} abc", f"w{i} abc", None, None, i % 7, i) for i in range(rows)], (
        "keyword string, normalized_keyword string, canonical_keyword string, normalized_canonical_keyword string, "
        "news_count int, total_occurrences int"))
    return table.withColumn("month_start", F.explode(F.array(*map(F.lit, [dt.date(2024, m, 1) for m in range(1, months + 1)]))))


@pytest.mark.parametrize("few", [0, 3, 100])
def test_few_and_many_requests_are_resolved_alike(spark, monkeypatch, few):
    monkeypatch.setattr(reports, "FEW_TEXTS", few)
    queries = ["w1 abc", "abc", "7 a", "a w13 abc b", "", "zzz", "w2"]
    asked = spark.createDataFrame([(dt.date(2024, m, 1), q) for m in (1, 2, 3) for q in queries], "month_start date, query string")
    got = {(r.month_start.month, r.query): (r.normalized_keyword, r.match) for r in reports.resolve_batch(topics(spark, 40, 2), asked).collect()}
    want = {"w1 abc": ("w1 abc", "exact"), "abc": ("w34 abc", "around"), "7 a": ("w27 abc", "around"), "": ("w34 abc", "around"),
            "a w13 abc b": ("w13 abc", "inside"), "zzz": ("zzz", "raw"), "w2": ("w27 abc", "around")}
    assert got == {(m, q): want[q] if m < 3 else (q, "raw") for m in (1, 2, 3) for q in queries}


def test_keywords_do_not_move_to_meet_a_few_requests(spark, tmp_path):
    topics(spark, 20).write.parquet(str(tmp_path / "stats"))
    table = spark.read.parquet(str(tmp_path / "stats"))
    asked = table.select("month_start").distinct().select("month_start", F.explode(F.array(F.lit("abc"), F.lit("w3"))).alias("query"))
    text = plan(reports.resolve_batch(table, asked))
    assert text.count("SortMergeJoin") == 1 and "Cartesian" not in text  # the answers meet the requests
