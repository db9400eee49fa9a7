import random
import re

import pytest
from pyspark.sql import functions as F

from pressmonth.functions.text import fold_label, normalize_text
from pressmonth.operators import entities, hits, matching
from pressmonth.sources import dictionary as dic

DDL = (
    "raw_noticia_id bigint, noticia_hash string, month_start date, source_media string, keyword string, "
    "normalized_keyword string, canonical_keyword string, normalized_canonical_keyword string, keyword_type string, "
    "extractor_source string, score double, occurrences int, hit_order int"
)


def hit(order, name, canonical=None, kind="misc", source="spacy", score=1.0, n=1, article=1):
    return (
        article, "h", None, "s", name, fold_label(name), canonical, fold_label(canonical) if canonical else None,
        kind, source, score, n, order,
    )


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), DDL)


def documents(spark, *texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "raw_noticia_id bigint, document string")
    return rows.select(
        "raw_noticia_id", F.lit("h").alias("noticia_hash"), F.lit(None).cast("date").alias("month_start"),
        F.lit("s").alias("source_media"), "document", normalize_text(F.col("document")).alias("normalized_document"),
    )


def test_config_defaults_and_order(config):
    names = [e["canonical"] for e in config.entries]
    assert names == ["Bahía Larga", "El Remanso", "Corte de luz", "Marta Ibáñez", "Tema cerrado"]
    ibanez = config.entries[3]
    assert ibanez["normalized_aliases"] == ["marta ibanez", "ibanez", "jueza marta ibanez"]
    assert (ibanez["keyword_type"], ibanez["priority"], ibanez["enabled"]) == ("topic", 0, True)
    assert config.omitted == {"tapa impresa", "ultima hora"}
    assert "tema cerrado" not in config.alias_map()


def test_missing_config_raises(tmp_path):
    with pytest.raises(FileNotFoundError):
        dic.load_keyword_config(tmp_path / "none.yml")


def test_overlapping_aliases_add_up(spark, config):
    found = matching.dictionary_hits(documents(spark, "La jueza Marta Ibáñez habló"), config).collect()
    assert [(r.keyword, r.occurrences, r.score) for r in found] == [("Marta Ibáñez", 3, 1.0)]


def brute_force(texts, config):
    out = {}
    for i, t in enumerate(texts):
        for e in config.entries:
            n = sum(
                len(re.findall(rf"(?<!\w){re.escape(a)}(?!\w)", fold_label(t))) for a in e["normalized_aliases"]
            )
            if e["enabled"] and n:
                out[i, e["normalized"]] = n
    return out


def test_both_matching_strategies_equal_brute_force(spark, tmp_path):
    path = tmp_path / "k.yml"
    path.write_text("""
entries:
  - {canonical: "a a", aliases: ["a a", "a b a", "b-a"]}
  - {canonical: "-x", aliases: ["-x", "x-"]}
  - {canonical: "c", aliases: ["c", "c c", "ñ"]}
  - {canonical: "off", enabled: false}
""", encoding="utf-8")
    config = dic.load_keyword_config(path)
    rng = random.Random(3)
    texts = ["".join(rng.choice(["a", "b", "c", "x", "ñ", "off", " ", " ", "-", "--", "xa"]) for _ in range(rng.randrange(30)))
             for _ in range(300)]
    want = brute_force(texts, config)
    for strategy in ("inline", "join"):
        rows = matching.dictionary_hits(documents(spark, *texts), config, strategy).collect()
        assert {(r.raw_noticia_id, r.normalized_keyword): r.occurrences for r in rows} == want, strategy


def test_merge_rules(spark):
    merged = hits.merge_hits(frame(
        spark,
        hit(0, "Corte De Luz", score=1.5, n=2), hit(1, "corte de luz", score=1.2, n=3),
        hit(0, "cero", score=0.0), hit(1, "cero", score=None),
        hit(0, "nada", score=None), hit(1, "nada", score=None),
        hit(0, "sde", canonical=None), hit(1, "sde", canonical="Bahía Larga"),
        hit(0, "otro", source="yake"), hit(0, "otro"),
    ))
    by_key = {(r.normalized_keyword, r.extractor_source): r for r in merged.collect()}
    paro = by_key["corte de luz", "spacy"]
    assert (paro.keyword, paro.score, paro.occurrences) == ("Corte De Luz", 1.5, 5)
    assert by_key["cero", "spacy"].score == 0.0
    assert by_key["nada", "spacy"].score is None
    assert by_key["sde", "spacy"].canonical_keyword == "Bahía Larga"
    assert ("otro", "yake") in by_key and ("otro", "spacy") in by_key


def test_canonicalise_takes_over_the_entry(spark, config):
    docs = documents(spark, "")
    found = frame(spark, hit(0, "barrio El Remanso"), hit(1, "desconocido"), hit(2, "Tema cerrado"))
    rows = {r.hit_order: r for r in hits.canonicalize_hits(found, hits.alias_lookup(docs, config)).collect()}
    assert (rows[0].keyword, rows[0].normalized_keyword, rows[0].keyword_type, rows[0].extractor_source) == (
        "El Remanso", "el remanso", "place", "spacy")
    assert rows[1].keyword == "desconocido" and rows[2].canonical_keyword is None


def test_omit_drops_every_extractor(spark, config):
    found = frame(spark, hit(0, "Tapa impresa"), hit(1, "Tapa impresa", source="dictionary"), hit(2, "corte de luz"))
    kept = hits.filter_omitted(found, config.omitted_df(spark)).collect()
    assert [r.keyword for r in kept] == ["corte de luz"]


def test_entities_count_spellings_together(spark):
    docs = documents(spark, "Ana María fue. Vio a ANA MARÍA y a Juan; iPhone no, Yo.")
    rows = {r.normalized_keyword: r for r in entities.entity_hits(docs).collect()}
    assert (rows["ana maria"].keyword, rows["ana maria"].occurrences, rows["ana maria"].keyword_type) == ("Ana María", 2, "misc")
    assert "phone" not in rows and "yo" not in rows and "juan" in rows


def load_fake_annotator():
    return lambda texts: [
        [("Test Organization", "ORG"), ("test  organization", "LOC"), ("No", "PER"), ("Ayer", "DATE")] if t else []
        for t in texts
    ]


def test_custom_annotator(spark):
    rows = entities.entity_hits(documents(spark, "algo", ""), load_fake_annotator).collect()
    assert [(r.raw_noticia_id, r.keyword, r.keyword_type, r.occurrences) for r in rows] == [
        (0, "Test Organization", "loc", 2)]


def test_dictionary_sync_disables_but_never_deletes(spark, config):
    stored = spark.createDataFrame(
        [("Viejo", "viejo", "topic", None, 1, True, "config"), ("Manual", "manual", "topic", None, 1, True, "manual"),
         ("El remanso!", "el remanso", "topic", None, 0, False, "manual")],
        "canonical_keyword string, normalized_keyword string, keyword_type string, category string, priority int, enabled boolean, source string",
    )
    rows = {r.normalized_keyword: r for r in dic.sync_dictionary(stored, config.dictionary_df(spark)).collect()}
    assert rows["viejo"].enabled is False and rows["manual"].enabled is True
    assert (rows["el remanso"].canonical_keyword, rows["el remanso"].priority, rows["el remanso"].source) == ("El Remanso", 9, "manual")
    assert rows["tema cerrado"].enabled is False and len(rows) == 7


def test_alias_sync(spark, config):
    dictionary = config.dictionary_df(spark).unionByName(spark.createDataFrame(
        [("M", "m", "topic", None, 0, True, "manual")], config.dictionary_df(spark).schema))
    stored = spark.createDataFrame(
        [("el remanso", "vieja banda", "vieja banda", True), ("m", "eme", "eme", True), ("x", "ibanez", "ibanez", True)],
        "normalized_keyword string, alias string, normalized_alias string, enabled boolean")
    rows = {r.normalized_alias: r for r in dic.sync_aliases(stored, dic.config_aliases(config.entries_df(spark)), dictionary).collect()}
    assert rows["vieja banda"].enabled is False and rows["eme"].enabled is True
    assert (rows["ibanez"].normalized_keyword, rows["ibanez"].enabled) == ("marta ibanez", True)
    assert rows["tema cerrado"].enabled is False
