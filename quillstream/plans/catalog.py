"""Tables by name in Spark's catalog (SNK5, SRC5, SRC7, SRC9).

``attach`` makes a table known in a database, so that any session of the
application, or any with the same metastore, reads it by name in SQL text:

* ``<name>``: the rows of all commits;
* ``<name>_files``: everything stored, with day and part key;
* ``<name>_snapshots``: the commit log.

All three are definitions over the table's folders; nothing is copied, and
nothing that is there already is altered. Day filters on the view prune folders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import COMMITS_SCHEMA, Table


def _columns(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def attach(table: Table, database: str) -> None:
    """Create the database and the table's three names in it if they are absent."""
    spark, name = table.spark, f"`{database}`.`{table.name}"
    table.create_if_absent()
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name}_files` ({_columns(table.schema)}, `{table.day_col}` date, part_key string) "
              f"USING parquet PARTITIONED BY (`{table.day_col}`, part_key) LOCATION '{table.data_path}'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name}_snapshots` ({_columns(COMMITS_SCHEMA)}) USING json LOCATION '{table.commits_path}'")
    rows = ", ".join(f"f.`{c}`" for c in [*table.schema.fieldNames(), table.day_col])
    spark.sql(f"CREATE VIEW IF NOT EXISTS {name}` AS SELECT {rows} FROM {name}_files` f LEFT SEMI JOIN {name}_snapshots` s ON f.part_key = s.part_key")
    refresh(table, database)


def refresh(table: Table, database: str) -> None:
    """Let the catalog see folders and commits made since."""
    spark, name = table.spark, f"`{database}`.`{table.name}"
    spark.sql(f"MSCK REPAIR TABLE {name}_files`")
    spark.sql(f"REFRESH TABLE {name}_snapshots`")


def table_names(spark: SparkSession, database: str) -> DataFrame:
    """Tables of a database by their plain names (SRC9)."""
    return spark.sql(f"SHOW VIEWS IN `{database}`").filter(F.col("namespace") == database).select(F.col("viewName").alias("tableName"))
