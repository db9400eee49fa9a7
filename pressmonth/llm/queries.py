"""The registered queries of this subpackage: thin digests of the operators' results, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressmonth.llm import (
    ball_codes, bpe, fingerprints, hard_negatives, html_templates, neardup, packing, pii, quality_pu, quality_rules, repeats,
    sharding, toxicity,
)
from pressmonth.llm.oracles import ORACLES  # noqa: F401
from pressmonth.llm.staging import fold, staged, table

PREDICT = 0.3


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=False)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    shuffled = sharding.shuffle_into_shards(table(spark, sf_dir, "documents"))
    return shuffled.select(
        "doc_id", "size", F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"), F.lit("key").alias("law"),
        "shard", "slot", "grown_shard",
    )


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_templates.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = fingerprints.with_following(docs.withColumn("sketch", fingerprints.sketch(F.col("text"))), ["text", "sketch"])
    n = F.length("text")
    cut = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - cut), F.substring("next_text", F.lit(1), cut))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "sketch", "next_sketch")
    rows = rows.withColumn("edited_sketch", fingerprints.sketch(F.col("edited")))
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprints.digest(F.col("sketch")).alias("fingerprint"), fingerprints.digest(F.col("edited_sketch")).alias("edited_fingerprint"),
        fingerprints.resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        fingerprints.resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = fold(F.col("doc_id"), 4) == 2
    labels = table(spark, sf_dir, "labels").where(~held_out)
    scored = toxicity.score_toxicity(table(spark, sf_dir, "documents").select("doc_id", "text"), labels, carry=["doc_id"])
    return scored.select(
        "doc_id", held_out.alias("held_out"), F.col("toxicity").alias("score"),
        (F.col("toxicity") >= PREDICT).cast("int").alias("predicted"), "evidence",
    )


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = fold(F.col("doc_id"), 5) == 0
    labels = table(spark, sf_dir, "labels").where(~held_out)
    scored = quality_pu.score_quality(table(spark, sf_dir, "documents").select("doc_id", "text"), labels)
    return scored.select(
        "doc_id", held_out.alias("held_out"), F.col("quality_score").alias("score"),
        (F.col("quality_score") >= PREDICT).cast("int").alias("predicted"),
    )


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"), carry=["doc_id"])
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode_digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("bigint") + 1) % 10).otherwise(F.col("label").cast("bigint"))
    rows = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return hard_negatives.hard_negatives(rows, F.col("id") % 100 == 0)


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = ball_codes.compress(table(spark, sf_dir, "embeddings"))
    rows = ball_codes.label_errors(staged(coded.select("id", "label", "code", "error")))
    return rows.select(
        F.col("id").alias("vec_id"), F.lower(F.hex("code")).alias("code"), "error", "label_error",
        F.lit(ball_codes.codebooks_digest(books)).alias("codebooks_sha256"),
    )


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_packing, op2_quality_rules, op3_sharding, op4_html_extraction, op5_fingerprints, op6_toxicity,
    op7_quality_classifier, op8_pii, op9_near_duplicates, op10_byte_bpe, op11_hard_negatives,
    op12_vector_codes, op13_substring_dedup,
)}
