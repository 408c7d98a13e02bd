"""Files of raw bytes written by Spark's own text writer.

Executors reach the shared folder only through Spark, whatever file system it
is on, and Spark has no writer for raw bytes. Its text writer puts each row's
bytes as they are and a separator after each row; so a format whose pieces all
end in the same byte can be written row by row, with that byte as separator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_pieces(df: DataFrame, column: str, path: str, last: bytes, partition_by: str | None = None) -> None:
    """Write each row's bytes followed by ``last``, in row order, one file per
    partition (and value of ``partition_by``)."""
    names = [partition_by] if partition_by else []
    writer = (df.select(*names, F.col(column).cast("string").alias("value")).write
              .option("lineSep", last.decode("latin-1")).option("encoding", "ISO-8859-1").option("compression", "none"))
    (writer.partitionBy(partition_by) if partition_by else writer).text(path)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, content) of every file below ``path``."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path)
            .select("path", "length", "content"))
