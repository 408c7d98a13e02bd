"""Fixed, code-declared schemas of the telemetry data model."""

from __future__ import annotations

from pyspark.sql import types as T

# Reading message fields, wire order (field numbers 1..8).
READING_FIELDS = [
    ("device_id", T.StringType()),
    ("site_id", T.StringType()),
    ("ts", T.LongType()),               # epoch millis on the wire
    ("temperature_c", T.DoubleType()),
    ("humidity_pct", T.DoubleType()),
    ("pressure_hpa", T.DoubleType()),
    ("vibration_g", T.DoubleType()),
    ("firmware_version", T.StringType()),
]
READING = T.StructType([T.StructField(n, t, True) for n, t in READING_FIELDS])
MEASURES = ["temperature_c", "humidity_pct", "pressure_hpa", "vibration_g"]

# Kafka-shaped log row: every stream starts from this shape.
LOG_ROW = T.StructType([
    T.StructField("key", T.BinaryType(), True),
    T.StructField("value", T.BinaryType(), True),
    T.StructField("topic", T.StringType(), True),
    T.StructField("partition", T.IntegerType(), True),
    T.StructField("offset", T.LongType(), True),
    T.StructField("timestamp", T.TimestampType(), True),
])

# telemetry / telemetry_upsert table row (ts as timestamp, firmware nullable).
TELEMETRY_TABLE = T.StructType([
    T.StructField("device_id", T.StringType(), False),
    T.StructField("site_id", T.StringType(), False),
    T.StructField("ts", T.TimestampType(), False),
    T.StructField("temperature_c", T.DoubleType(), False),
    T.StructField("humidity_pct", T.DoubleType(), False),
    T.StructField("pressure_hpa", T.DoubleType(), False),
    T.StructField("vibration_g", T.DoubleType(), False),
    T.StructField("firmware_version", T.StringType(), True),
])

# Change log of the upsert job: table rows with their place in the log.
UPSERT_TABLE = T.StructType([*TELEMETRY_TABLE.fields, T.StructField("_partition", T.IntegerType()), T.StructField("_offset", T.LongType())])

# telemetry_1m_agg table row.
AGG_TABLE = T.StructType([
    T.StructField("device_id", T.StringType(), False),
    T.StructField("window_start", T.TimestampType(), False),
    T.StructField("window_end", T.TimestampType(), False),
    T.StructField("reading_count", T.LongType(), False),
    T.StructField("avg_temperature_c", T.DoubleType(), False),
    T.StructField("min_temperature_c", T.DoubleType(), False),
    T.StructField("max_temperature_c", T.DoubleType(), False),
    T.StructField("avg_humidity_pct", T.DoubleType(), False),
    T.StructField("avg_pressure_hpa", T.DoubleType(), False),
])

# Parsed view of the three envelope shapes.
DLQ_PARSED = T.StructType([
    T.StructField("stage", T.StringType(), True),
    T.StructField("reason", T.StringType(), True),
    T.StructField("payload_len", T.LongType(), True),
    T.StructField("device_id", T.StringType(), True),
    T.StructField("event_ts", T.LongType(), True),
])

def day_partition_field(schema: T.StructType, source_col: str) -> str:
    """Name of the derived day-partition column for ``source_col``.

    Unknown columns are an error, like the reference's partition-spec helper.
    """
    if source_col not in schema.fieldNames():
        raise ValueError(f"cannot partition by unknown column: {source_col}")
    return f"{source_col}_day"
