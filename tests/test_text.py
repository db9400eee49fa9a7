import random
import re
import unicodedata

from pyspark.sql import functions as F

from pressmonth.functions import text


def apply(spark, function, values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in rows.orderBy("i").select(function(F.col("v"))).collect()]


def expected_normal(value):
    folded = unicodedata.normalize("NFKD", (value or "").casefold())
    kept = "".join(c for c in folded if not unicodedata.combining(c))
    return " ".join("".join(c if c.isalnum() or c in "_-" else " " for c in kept).split())


def expected_query(value):
    kept = re.sub("[̀-ͯ]", "", unicodedata.normalize("NFD", value.lower()))
    return " ".join("".join(c if c.isalpha() or c.isnumeric() or c == "-" else " " for c in kept).split())


def test_normalize_cases(spark):
    cases = {
        "Bahía Larga": "bahia larga", "  ¡Hola,   Mundo!  ": "hola mundo", "niño": "nino",
        "bien-estar": "bien-estar", "": "", "¿Cómo estás?": "como estas", "Straße_1 ½ ﬁn №5 한글": expected_normal("Straße_1 ½ ﬁn №5 한글"),
        "ΟΔΟΣ Ϲ": expected_normal("ΟΔΟΣ Ϲ"),
    }
    assert apply(spark, text.normalize_text, list(cases)) == list(cases.values())
    assert apply(spark, text.normalize_text, [None]) == [""]


def test_normalizers_match_unicode_on_random_text(spark):
    rng = random.Random(5)
    pool = [c for c in map(chr, range(0x20, 0x2FFF)) if unicodedata.category(c) not in ("Cn", "Co", "Cs")]
    pool += [chr(rng.randrange(0xAC00, 0xD7A4)) for _ in range(200)] + [chr(c) for c in range(0xFB00, 0xFB07)]
    pool += list("áéíóúñüÁÉß ") * 40
    java_known = set(
        r[0] for r in spark.createDataFrame([(c,) for c in set(pool)], "c string").filter(~F.col("c").rlike(r"\p{Cn}")).collect()
    )
    pool = [c for c in pool if c in java_known]
    values = ["".join(rng.choice(pool) for _ in range(rng.randrange(60))) for _ in range(1500)]
    assert apply(spark, text.normalize_text, values) == [expected_normal(v) for v in values]
    assert apply(spark, text.normalize_query, values) == [expected_query(v) for v in values]


def test_two_normalizers_differ_where_they_should(spark):
    assert apply(spark, text.normalize_text, ["a_b ß"]) == ["a_b ss"]
    assert apply(spark, text.normalize_query, ["a_b ß"]) == ["a b ß"]


def test_clean_keeps_case_and_punctuation(spark):
    values = ["  El   Remanso  ", "", None, "  ¡Hola,\t\n Mundo!  ", "a\x1cb c\x85"]
    assert apply(spark, text.clean_text, values) == ["El Remanso", "", "", "¡Hola, Mundo!", "a b c"]


def test_document_joins_title_and_whole_body(spark):
    body = "palabra " * 1000
    rows = spark.createDataFrame([(" Un  título ", body), (None, None)], "t string, b string")
    whole, empty = (r[0] for r in rows.select(text.build_document(F.col("t"), F.col("b"))).collect())
    assert whole == "Un título. " + body.strip()
    assert empty == "."
    capped = rows.select(text.build_document(F.col("t"), F.col("b"), 10)).first()[0]
    assert capped == "Un título. palabra pa"


def test_alias_count(spark):
    cases = [
        ("corte de luz y recorte de luz", "corte de luz", 1), ("corte de luz corte de luz", "corte de luz", 2),
        ("bien-estar y bien estar", "bien estar", 1), ("bien-estar y bien estar", "estar", 2),
        ("the the the", "the the", 1), ("", "x", 0),
    ]
    rows = spark.createDataFrame(cases, "d string, a string, n int")
    assert [r[0] for r in rows.select(text.count_alias(F.col("d"), F.col("a"))).collect()] == [c[2] for c in cases]


def test_driver_twin_agrees(spark):
    values = ["Río  Hondo", "¡Ver más!", "Ünïcode-Ñandú_x", "½ taza"]
    assert apply(spark, text.normalize_text, values) == [text.fold_label(v) for v in values]
