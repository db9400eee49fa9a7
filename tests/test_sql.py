"""A cross-section of the registered queries against their SQL (tools/check.py compares all of them)."""

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", ["news_upsert", "monthly_overview", "source_aliases", "topic_news_by_source",
                                  "news_keywords", "affected_periods_upsert", "normalize_text", "valid_urls",
                                  "map_2d", "constraint_report", "nearest_recall"])
def test_query_equals_sql(spark, con, name):
    frame = entry.queries()[name](spark, SF)
    result = con.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(frame.columns)
    got = frame.select(*columns).collect()
    key = lambda row: [(v is None, str(v)) for v in row]
    rounded = lambda rows: sorted([tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows], key=key)
    assert rounded(got) == rounded(result.fetchall())


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
