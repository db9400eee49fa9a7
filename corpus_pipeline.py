"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept.  The first four return the columns
of ``documents``; the last returns packed pieces.  Classifiers are fitted on labelled rows that are still among the
stage's documents.  Rows with a null text pass the classifiers like empty ones; an empty table stays empty.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressmonth.llm import neardup, packing, pii, quality_pu, toxicity
from pressmonth.llm.staging import shared_folder, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the positive-unlabelled classifier rejects go."""
    scored = quality_pu.score_quality(docs.select(*COLUMNS), table(spark, sf_dir, "labels"))
    return scored.where(F.col("quality_score") >= quality_pu.KEEP).select(*COLUMNS)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose nearest labelled examples speak for toxicity go."""
    scored = toxicity.score_toxicity(docs.select(*COLUMNS), table(spark, sf_dir, "labels"))
    return scored.where(F.col("toxicity") < toxicity.REJECT).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the least id.

    Rows of equal id and text count as one; rows that share an id but not the text are documents of their own.
    """
    docs = docs.select(*COLUMNS)
    repeated = docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")
    if repeated.isEmpty():
        copies = neardup.near_duplicates(docs.select("doc_id", "text")).where(~F.col("kept")).select("doc_id")
        return docs.join(copies, "doc_id", "left_anti").select(*COLUMNS)
    # names in the order of the ids (moved above zero), with the text's digest where an id has several
    name = F.lpad((F.col("doc_id").cast("decimal(20,0)") + F.lit(str(1 << 63)).cast("decimal(20,0)")).cast("decimal(20,0)").cast("string"), 20, "0")
    single = docs.join(repeated, "doc_id", "left_anti").withColumn("__name", name)
    several = (
        docs.join(repeated, "doc_id").groupBy("doc_id", "text").agg(F.min(F.struct("lang", "source", "n_chars")).alias("rest"))
        .select("doc_id", "text", "rest.*").withColumn("__name", F.concat(name, F.lit(":"), F.coalesce(F.md5(F.col("text").cast("binary")), F.lit(""))))
    )
    named = single.unionByName(several)
    copies = neardup.near_duplicates(named.select("__name", "text"), "__name").where(~F.col("kept")).select("__name")
    return named.join(copies, "__name", "left_anti").select(*COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Identifiers are replaced by their kind; the length follows the new text."""
    found = pii.find_pii(docs.select(*COLUMNS))
    return found.select(
        "doc_id", F.col("redacted").alias("text"), "lang", "source", F.length("redacted").cast("long").alias("n_chars")
    )


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in windows of 2048 ids."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", quality), ("toxicity", toxic), ("near_duplicates", near_duplicates), ("personal_data", personal_data),
    ("packing", packed),
]

# Trained classifiers and the sketch have no SQL counterpart; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
