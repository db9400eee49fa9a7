"""Readers of the upstream article table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ingest import SOURCE_COLUMNS
from ..schemas import UPSTREAM


def from_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(UPSTREAM).parquet(path)


def from_jdbc(
    spark: SparkSession, url: str, table: str, first_id: int, last_id: int, partitions: int, **options: str
) -> DataFrame:
    """Partitioned read by article id; filters on the result (time window, completeness) are pushed down.

    A vector column arrives as text such as ``[0.1,0.2]`` and is parsed into an array.
    """
    rows = spark.read.format("jdbc").options(
        url=url, dbtable=table, partitionColumn="id", lowerBound=first_id, upperBound=last_id,
        numPartitions=partitions, **options,
    ).load().select(*SOURCE_COLUMNS)
    return shaped(rows)


def shaped(rows: DataFrame) -> DataFrame:
    """Upstream rows in the declared types."""
    target = rows.sparkSession.createDataFrame([], UPSTREAM).schema
    kinds = dict(rows.dtypes)
    return rows.select(*[
        (F.from_json(f.name, f.dataType) if kinds[f.name] == "string" and f.name == "embedding"
         else F.col(f.name).cast(f.dataType)).alias(f.name)
        for f in target
    ])
