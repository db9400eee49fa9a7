import datetime as dt

from conftest import NOW, article

from pressmonth.plans import pipeline
from pressmonth.streaming import ingest as stream


def test_stream_equals_batch_and_keeps_late_articles(spark, upstream, tmp_path):
    source = str(tmp_path / "in")
    store = pipeline.open_store(spark, str(tmp_path / "tables"))

    def arrive(*articles):
        upstream(*articles).coalesce(1).write.mode("append").parquet(source)
        query = stream.ingest_stream(store, stream.news_stream(spark, source), str(tmp_path / "progress"), lambda: NOW)
        assert query.awaitTermination(120) and query.exception() is None

    arrive(article(1, "A", "uno", "", dt.datetime(2024, 3, 1)), article(2, "A", "dos", "", dt.datetime(2024, 4, 1)),
           article(4, "A", "sin vector", "", dt.datetime(2024, 5, 1), embedded=False))
    # years late, and a new version of a known article
    arrive(article(3, "B", "tarde", "", dt.datetime(2019, 1, 1)),
           article(2, "A", "dos, corregido", "", dt.datetime(2024, 4, 1), NOW + dt.timedelta(minutes=1)))
    assert {r.id: r.titulo for r in store.read("raw_news").collect()} == {1: "uno", 2: "dos, corregido", 3: "tarde"}
    assert {(r.month_start, r.status) for r in store.read("affected_periods").collect()} == {
        (dt.date(2019, 1, 1), "pending"), (dt.date(2024, 3, 1), "pending"), (dt.date(2024, 4, 1), "pending")}


def test_daily_counts(spark, upstream, tmp_path):
    source = str(tmp_path / "in")
    upstream(*[article(i, "A", "t", "", dt.datetime(2024, 3, 1 + i % 2, 5)) for i in range(5)],
             article(9, "A", "t", "", None)).write.parquet(source)
    counts = stream.daily_counts(stream.news_stream(spark, source))
    query = counts.writeStream.outputMode("complete").format("memory").queryName("daily").trigger(availableNow=True).start()
    assert query.awaitTermination(120)
    assert {(r.activity_date.day, r.news_count) for r in spark.table("daily").collect()} == {(1, 3), (2, 2)}


def test_a_stream_keeps_the_daily_table(spark, upstream, tmp_path):
    source, store = str(tmp_path / "in"), pipeline.open_store(spark, str(tmp_path / "tables"))
    for day in (1, 2, 1):
        upstream(*[article(i, "A", "t", "", dt.datetime(2024, 3, day, 5)) for i in range(day + 1)],
                 article(9, "A", "t", "", None), article(10, "A", "t", "", dt.datetime(2023, 1, 5))).coalesce(1).write.mode("append").parquet(source)
        query = stream.daily_table(store, stream.news_stream(spark, source, 1), str(tmp_path / "progress"))
        assert query.awaitTermination(120) and query.exception() is None
    assert {(r.activity_date, r.news_count) for r in store.read("daily_activity").collect()} == {
        (dt.date(2024, 3, 1), 4), (dt.date(2024, 3, 2), 3), (dt.date(2023, 1, 5), 3)}
