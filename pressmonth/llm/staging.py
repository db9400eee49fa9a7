"""Results that later jobs read again, kept where a lost executor cannot take them."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the session: what ``spark.checkpoint.dir`` names, or one in the warehouse where it is unset."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(
            spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_staged"
        )
    return context.getCheckpointDir()


def staged(rows: DataFrame) -> DataFrame:
    """``rows`` written once as Parquet in the shared folder and read back."""
    spark = rows.sparkSession
    path = f"{shared_folder(spark)}/stage-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def discard(rows: DataFrame) -> None:
    """Delete the files of a :func:`staged` DataFrame that nothing reads any more."""
    jvm = rows.sparkSession.sparkContext._jvm
    for name in {file.rsplit("/", 1)[0] for file in rows.inputFiles()}:
        folder = jvm.org.apache.hadoop.fs.Path(name)
        folder.getFileSystem(rows.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def widened(schema: StructType, **types: str) -> StructType:
    """A copy of ``schema`` with further fields, their types in DDL."""
    return StructType([*schema.fields, *(StructField(name, DataType.fromDDL(ddl)) for name, ddl in types.items())])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text modulo ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds
