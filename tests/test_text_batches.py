"""Whole texts cleaned, searched and counted over Arrow batches: equal to the column forms, and what no longer moves."""

import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pressmonth.functions import text
from pressmonth.operators import entities, hits, matching
from pressmonth.operators import keyphrases as kp
from pressmonth.plans import catalog
from test_hits import documents

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def random_texts(seed, n=400):
    rng = random.Random(seed)
    pool = list("abcXYZ  .,-_'’\t\n\r\x1c\x85\xa0 　áÉñÑßŒﬁ½²№ςΣİ한글дЖ́​") + ["the", "Río ", "--", "  "]
    return [None, "", *["".join(rng.choice(pool) for _ in range(rng.randrange(80))) for _ in range(n)]]


@pytest.mark.parametrize("max_chars", [None, 10])
def test_documents_equal_the_column_forms(spark, max_chars):
    rows = spark.createDataFrame(list(zip(random_texts(1), random_texts(2))), "t string, b string")
    both = rows.select(
        text.cleaned_document(F.col("t"), F.col("b"), max_chars).alias("got"),
        text.build_document(F.col("t"), F.col("b"), max_chars).alias("want"),
        text.normalized_document(F.col("b")).alias("got_n"), text.normalize_text(F.col("b")).alias("want_n"),
    ).collect()
    assert [r.got for r in both] == [r.want for r in both]
    assert [r.got_n for r in both] == [r.want_n for r in both]


def test_words_are_counted_as_by_the_pattern():
    rng = random.Random(3)
    for _ in range(4000):
        body = "".join(rng.choice("ab -_ñ") for _ in range(rng.randrange(30)))
        words = "".join(rng.choice("ab -_ñ") for _ in range(rng.randrange(1, 4)))
        assert matching.count_words(body, words) == len(re.findall(rf"{re.escape(words)}(?<!\w{re.escape(words)})(?!\w)", body))


def test_word_classes_equal_those_of_single_words():
    rng = random.Random(4)
    pool = list("abzABZ09_-'ñÑßΣς²Ⅷé")
    words = sorted({"".join(rng.choice(pool) for _ in range(rng.randrange(1, 6))) for _ in range(5000)} | {*kp.STOPWORDS, ".", "«"})
    is_a, lowered = kp._word_classes(pa.array(["x", *words, "y"])[1:-1], frozenset(kp.STOPWORDS))
    assert lowered.to_pylist() == [w.lower() for w in words]
    for i, word in enumerate(words):
        bits = kp._word_class(word)
        want = [bool(bits >> k & 1) for k in range(5)]
        want[4] |= word.lower() in kp.STOPWORDS
        assert [bool(is_a[name][i]) for name in ("word", "acronym", "upper", "number", "stop")] == want


def test_rows_of_one_article_are_counted_together(spark):
    docs = documents(spark, "Ana María vio a Ana. ANA fue.")
    rows = {r.normalized_keyword: r for r in entities.entity_hits(docs.unionByName(docs)).collect()}
    assert (rows["ana"].keyword, rows["ana"].occurrences, rows["ana"].hit_order) == ("Ana", 4, 1)


def test_phrases_are_counted_where_they_are_chosen(spark):
    """No text meets its phrases in a join."""
    assert "regexp_count" not in plan(kp.keyphrase_hits(documents(spark, "")))


def test_texts_are_read_once_by_each_step(spark):
    """The column forms run their patterns over a text again for every place that names it."""
    made = hits.to_documents(spark.createDataFrame(
        [], "id bigint, noticia_hash string, fecha_publicacion timestamp_ntz, fuente string, titulo string, texto_completo string"))
    assert "regexp_replace" not in plan(made)
    assert "regexp_count" not in plan(matching.dictionary_hits(documents(spark, ""), catalog.config()))


def test_only_distinct_mentions_become_rows(spark):
    text_ = plan(catalog.QUERIES["entity_hits"](spark, SF))
    assert "posexplode" not in text_


def test_texts_are_decoded_some_at_a_time():
    values = [None, "", "ñ", "abc"] * 300
    read = text.strings(pa.array(["x", *values])[1:])
    assert iter(read) is read and list(read) == [v or "" for v in values]
