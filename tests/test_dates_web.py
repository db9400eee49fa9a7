import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from pressmonth.functions import dates, web


def test_month_strings(spark):
    assert dates.month_from_string("  2024-03  ") == dt.date(2024, 3, 1)
    for bad in ("2024/03", "2024-13", "", None, "2024-3", "2024-00"):
        with pytest.raises(ValueError):
            dates.month_from_string(bad)
    values = ["  2024-03  ", "2024/03", "2024-13", "", None]
    rows = spark.createDataFrame([(v,) for v in values], "v string").select(dates.parse_month(F.col("v")))
    assert [r[0] for r in rows.collect()] == [dt.date(2024, 3, 1), None, None, None, None]


def test_month_bounds():
    assert dates.month_bounds(dt.date(2024, 12, 5)) == (dt.date(2024, 12, 1), dt.date(2025, 1, 1))
    assert dates.month_bounds(dt.date(2024, 2, 1)) == (dt.date(2024, 2, 1), dt.date(2024, 3, 1))


def column(spark, function, values, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(function(F.col("v"))).collect()]


def test_only_http_links_pass(spark):
    good = ["http://a.example", "HTTPS://a.example/x?y#z", "https://u:p@h.example:80/a b", "http://[::1]/x"]
    bad = ["ftp://a.example", "javascript:alert(1)", "", None, "a.example", "http://", "http://a b.example", "http://x:y/"]
    assert column(spark, web.http_url, good + bad) == good + [None] * len(bad)


def test_hosts_are_judged_like_a_browser(spark):
    good = ["http://127.1", "http://0300.0250.1", "http://0x", "http://1.2.3.4.", "http://[1::]", "http://[::]:0", "http://a:00080/",
            "http://h%C3%A9.example", "http:/\\a.example", "http:a", "ht\ntp://a.example", "http://a_b-c.example/?@:", "http://u@v@h/"]
    bad = ["http://1.2.3.999999", "http://1.256.1.1", "http://a.b.08", "http://1.2..3", "http://[::g]", "http://[1:2:3:4:5:6:7:8:9]",
           "http://[1::2:3:4:5:6:7:8]", "http://[::1.2.3]", "http://[::01.2.3.4]", "http://[", "http://[::1", "http://[::1]x/",
           "http://a:99999", "http://a:-1", "http://%00", "http://a%", "http://%FF", "https:", "http://99999999999999999999", "http://."]
    got = column(spark, web.http_url, good + bad)
    assert got[: len(good)] == good and [b for b, g in zip(bad, got[len(good):]) if g is not None] in ([], ["http://."])


def test_decoding_tolerates_malformed_input(spark):
    given = ["corte%20de%20luz", "%zz a ", "a+b", "%C3%B1", "%FF", " x "]
    assert column(spark, web.decode_keyword, given) == ["corte de luz", "%zz a", "a+b", "ñ", "%FF", "x"]


def test_alias_key(spark):
    rows = spark.createDataFrame([("Fuente 7", 1), ("Real name", 2), (None, 3)], "a string, p int")
    keys = [r[0] for r in rows.select(web.alias_key(F.col("a"), F.col("p"))).collect()]
    assert keys == ["fuente-7", "fuente-2", "fuente-3"]


def test_stored_keyword_lists_are_read_tolerantly(spark):
    stored = json.dumps([
        "texto", {"keyword": " Uno ", "news_count": 3, "total_occurrences": 9}, {"label": "Dos", "weight": "x"},
        {"term": "Tres", "count": 2, "occurrences": 4}, {"keyword": "  "}, 5, None, {"name": "Cuatro"},
    ])
    many = json.dumps([{"keyword": f"k{i}"} for i in range(40)])
    out = column(spark, web.read_top_keywords, [stored, many, "{}", "not json", None])
    assert [tuple(k) for k in out[0]] == [
        ("texto", 1.0, None), ("Uno", 3.0, 9.0), ("Dos", 0.0, None), ("Tres", 2.0, 4.0), ("Cuatro", 1.0, None),
    ]
    assert len(out[1]) == 24 and out[2:] == [[], [], []]


def test_month_label(spark):
    assert column(spark, dates.month_label, [dt.date(2024, 3, 1)], "date") == ["marzo de 2024"]
