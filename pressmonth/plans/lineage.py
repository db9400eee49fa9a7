"""Results that several branches of a plan read: computed once and kept where a lost executor cannot take them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Where all executors can write: what ``spark.checkpoint.dir`` names, else a folder in the warehouse, which a
    cluster shares as well.  Every application has its own, so that :func:`drop_staged` takes only what is its own."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    base = named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_staged"
    return f"{base.rstrip('/')}/pressmonth-{spark.sparkContext.applicationId}"


def computed_once(rows: DataFrame) -> DataFrame:
    """``rows`` written as Parquet in the shared folder and read back."""
    spark = rows.sparkSession
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def drop_staged(spark: SparkSession) -> None:
    """Delete everything that :func:`computed_once` has written in this application; its results can no longer be read."""
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def spread(rows: DataFrame) -> DataFrame:
    """``rows`` over all cores if the scan has fewer splits than that (a small file); a large scan is left as is."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows
