"""Telemetry view over the driver's ``events`` table.

The fixture tables carry no sensor log, so every query derives its readings
from ``events`` with a fixed rule (time compressed 60x so one-minute windows
hold several readings). The rule is written once here for Spark and once in
``DUCKDB_VIEW`` for the SQL oracle; both must stay in step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# --- Fixed values of the fixture rule ---------------------------------------
EPOCH_2024_MS = 1704067200000   # 2024-01-01T00:00:00Z
TIME_COMPRESSION = 60           # 60x compressed time
LOG_PARTITIONS = 3              # source partitions of the log
TRIGGER_MS = 30000              # micro-batch / commit interval
COMMIT_MS = 3600000             # arrival time per commit in the table fixtures
CORRECTIONS = 100               # records of the log that the corrections re-emit
# ----------------------------------------------------------------------------

# Spark SQL expressions over ``events`` columns (event_id, ts, user_id, value, props).
_VIEW_EXPRS = [
    "event_id AS seq",
    f"CAST(user_id % {LOG_PARTITIONS} AS INT) AS partition",
    "event_id AS offset",
    "CASE WHEN event_id % 97 = 0 THEN '' "
    "ELSE concat('site-', CAST(user_id % 3 AS STRING), '-dev-', CAST(user_id % 9 AS STRING)) END AS device_id",
    "concat('site-', CAST(user_id % 3 AS STRING)) AS site_id",
    f"{EPOCH_2024_MS} + (unix_millis(CAST(ts AS TIMESTAMP)) - {EPOCH_2024_MS}) div {TIME_COMPRESSION} AS ts_ms",
    "value AS temperature_c",
    "CAST(get_json_object(props, '$.k') AS DOUBLE) AS humidity_pct",
    "CAST(1000 + event_id % 103 AS DOUBLE) AS pressure_hpa",
    "CAST(event_id % 50 AS DOUBLE) / 10 AS vibration_g",
    "CASE WHEN event_id % 4 = 0 THEN NULL ELSE concat('1.', CAST(event_id % 3 AS STRING)) END AS firmware_version",
]

# Same rule in DuckDB SQL (used as a CTE by the oracle queries).
DUCKDB_VIEW = f"""
tv AS (
  SELECT event_id AS seq,
         CAST(user_id % {LOG_PARTITIONS} AS INTEGER) AS "partition",
         event_id AS "offset",
         CASE WHEN event_id % 97 = 0 THEN ''
              ELSE 'site-' || CAST(user_id % 3 AS VARCHAR) || '-dev-' || CAST(user_id % 9 AS VARCHAR) END AS device_id,
         'site-' || CAST(user_id % 3 AS VARCHAR) AS site_id,
         {EPOCH_2024_MS} + (epoch_us(ts) // 1000 - {EPOCH_2024_MS}) // {TIME_COMPRESSION} AS ts_ms,
         value AS temperature_c,
         CAST(json_extract(props, '$.k') AS DOUBLE) AS humidity_pct,
         CAST(1000 + event_id % 103 AS DOUBLE) AS pressure_hpa,
         CAST(event_id % 50 AS DOUBLE) / 10 AS vibration_g,
         CASE WHEN event_id % 4 = 0 THEN NULL ELSE '1.' || CAST(event_id % 3 AS VARCHAR) END AS firmware_version,
         CASE WHEN event_id % 11 = 0 THEN {EPOCH_2024_MS} + (epoch_us(ts) // 1000 - {EPOCH_2024_MS}) // {TIME_COMPRESSION}
                                          + (event_id % 13) * 20000
              ELSE {EPOCH_2024_MS} + (epoch_us(ts) // 1000 - {EPOCH_2024_MS}) // {TIME_COMPRESSION} END AS arrival_ms
  FROM events
)"""


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def telemetry_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings derived from ``events``: one row per event, flat reading columns.

    Also carries the log coordinates (``partition``, ``offset``) and the
    arrival time ``arrival_ms`` (a share of readings arrives late, by rule).
    """
    v = read_events(spark, sf_dir).selectExpr(*_VIEW_EXPRS)
    return v.selectExpr(
        "*",
        "CASE WHEN seq % 11 = 0 THEN ts_ms + (seq % 13) * 20000 ELSE ts_ms END AS arrival_ms",
    )


def batch_of(arrival_ms_col: str = "arrival_ms", trigger_ms: int = TRIGGER_MS) -> str:
    """SQL expression: micro-batch id of a row from its arrival time."""
    return f"{arrival_ms_col} div {trigger_ms}"
