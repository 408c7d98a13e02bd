"""Session helpers of the operators: bounded Arrow batches, shared folder, cut lineage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstream.session import ship_package, warehouse_root

#: Rows and bytes per Arrow batch at most, so that batches of whole texts stay small.
BATCH_ROWS = 256
BATCH_BYTES = 16 << 20


def session(df: DataFrame) -> SparkSession:
    """The session of a DataFrame, with Arrow batches bounded for whole texts and
    the package on its executors."""
    spark = df.sparkSession
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def shared(spark: SparkSession, name: str) -> str:
    """A new path for a table in the folder that all executors share."""
    return f"{warehouse_root(spark)}/llm/{name}-{uuid.uuid4().hex}"


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str, partition_by: str | None = None, release: bool = False) -> DataFrame:
    """``df`` written to the shared folder and read again: the lineage ends there,
    so a lost executor costs a re-read and never a recomputation. ``release``
    frees the shuffle files of the write when it ends, not when the driver's
    garbage is collected."""
    spark = df.sparkSession
    path = shared(spark, name)
    writer = df.write.option("compression", "zstd")
    before = spark.conf.get(CLEANUP, "false")
    if release:
        spark.conf.set(CLEANUP, "true")
    try:
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def digest(column):
    """Lower-case hex SHA-256 of a string column's UTF-8 bytes."""
    return F.sha2(column.cast("binary"), 256)
