"""Window job on Spark's own windowed aggregation (W5, A1, A2; SURVEY 3.2).

``withWatermark`` and ``groupBy(window)`` in append mode, state in RocksDB: partial
aggregates before the shuffle and after it, no Python. Compared with the stateful
processor it is lenient by one micro-batch: rows are dropped only when their
window had ended under the watermark of the batch before, and what is dropped is
counted in the progress report (``numRowsDroppedByWatermark``), not kept.

Rejected and undecodable records move the watermark too. A filter on them would
be pushed in front of it, so they are counted out inside the aggregates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.tables import Table
from ..schema import AGG_TABLE
from .jobs import WATERMARK_DELAY, _start, classified_stream


def native_window_stream(log: DataFrame, window: str = "1 minute", delay: str = WATERMARK_DELAY) -> DataFrame:
    """Rows of the aggregate table as windows close."""
    d = classified_stream(log).withColumn("event_time", F.timestamp_millis("event_ms")).withWatermark("event_time", delay)
    good = F.col("stage").isNull()
    of = lambda c: F.when(good, F.col(c))
    agg = d.groupBy(F.window("event_time", window).alias("w"), "device_id").agg(
        F.count_if(good).alias("reading_count"), F.avg(of("temperature_c")).alias("avg_temperature_c"), F.min(of("temperature_c")).alias("min_temperature_c"),
        F.max(of("temperature_c")).alias("max_temperature_c"), F.avg(of("humidity_pct")).alias("avg_humidity_pct"),
        F.avg(of("pressure_hpa")).alias("avg_pressure_hpa"))
    rows = agg.filter("reading_count > 0").withColumns({"window_start": F.col("w.start"), "window_end": F.col("w.end")})
    return rows.select(*AGG_TABLE.fieldNames())


def start_native_window_job(log: DataFrame, table: Table, checkpoint: str, trigger: dict | None = None, name: str = "telemetry_1m_native"):
    """Log -> decode -> gate -> windows -> table, each micro-batch one commit."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        table.commit_batch(batch, writer=name, batch_id=batch_id)

    return _start(native_window_stream(log), sink, checkpoint, trigger, name)
