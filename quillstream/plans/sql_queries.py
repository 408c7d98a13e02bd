"""Registered queries that run as SQL text over tables in the catalog.

Each attaches a table built from ``events`` to a database of its own and runs a
statement on it by name; ``{db}`` is that database.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame

from ..schema import UPSERT_TABLE
from .catalog import attach, table_names
from .ingest_queries import upsert_input
from .queries import register
from .table_queries import build_table, upsert_rows
from .tables import Table

STATEMENTS = {
    "sql_total_rows": "SELECT COUNT(*) AS total_rows FROM {db}.telemetry",
    "sql_latest_10": """
SELECT device_id, unix_millis(ts) AS ts_ms, temperature_c, humidity_pct, firmware_version
FROM {db}.telemetry ORDER BY ts DESC, device_id, temperature_c, pressure_hpa, vibration_g LIMIT 10""",
    "sql_device_stats": """
SELECT device_id, COUNT(*) AS readings, ROUND(AVG(temperature_c), 2) AS avg_temp,
       ROUND(MIN(temperature_c), 2) AS min_temp, ROUND(MAX(temperature_c), 2) AS max_temp
FROM {db}.telemetry GROUP BY device_id ORDER BY device_id""",
    "sql_latest_snapshots": """
SELECT commit_id, committed_at_ms, operation FROM {db}.telemetry_snapshots ORDER BY committed_at_ms DESC, commit_id DESC LIMIT 5""",
    # any ten rows: how many there are and how many of them are rows of the table
    "sql_sample_10": """
WITH sample AS (SELECT * FROM {db}.telemetry LIMIT 10)
SELECT COUNT(*) AS sampled, COUNT_IF(known) AS known
FROM (SELECT s.device_id, s.ts, ANY_VALUE(t.device_id) IS NOT NULL AS known FROM sample s LEFT JOIN {db}.telemetry t
      ON t.device_id = s.device_id AND t.ts = s.ts AND t.temperature_c = s.temperature_c AND t.pressure_hpa = s.pressure_hpa
      GROUP BY s.device_id, s.ts, s.temperature_c, s.pressure_hpa)""",
    "sql_rows_per_day": """
SELECT CAST(ts_day AS STRING) AS day, COUNT(*) AS readings FROM {db}.telemetry WHERE ts_day >= DATE '2024-01-01' GROUP BY ts_day""",
}


def _database(spark, *tables: Table) -> str:
    database = f"iot_{uuid.uuid4().hex[:12]}"
    for table in tables:
        attach(table, database)
    return database


def _statement(name: str):
    def query(spark, sf_dir) -> DataFrame:
        return spark.sql(STATEMENTS[name].format(db=_database(spark, build_table(spark, sf_dir, name.replace("_", "-")))))
    query.__name__, query.__doc__ = f"q_{name}", f"SQL text over the catalog: {' '.join(STATEMENTS[name].split())}"
    return query


for _name in STATEMENTS:
    register(_name)(_statement(_name))


@register("catalog_tables")
def q_catalog_tables(spark, sf_dir):
    """Tables that the catalog lists, each counted by name (SRC9, SNK5)."""
    telemetry = build_table(spark, sf_dir, "catalog")
    changes = Table(spark, "telemetry_upsert", UPSERT_TABLE, "ts", root=telemetry.root).create_if_absent()
    changes.commit_batch(upsert_rows(upsert_input(spark, sf_dir)), "upsert", 0)
    database = _database(spark, telemetry, changes)
    names = [r["tableName"] for r in table_names(spark, database).collect()]  # a row per table
    return reduce(DataFrame.unionByName, [
        spark.sql(f"SELECT '{n}' AS table_name, COUNT(*) AS records, COUNT(DISTINCT device_id) AS devices FROM `{database}`.`{n}`") for n in names])
