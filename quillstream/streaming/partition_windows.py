"""Window job under a watermark per log partition with idleness.

Spark's watermark is the largest event time over all log partitions, so a slow
partition's readings are late as soon as a fast one has moved on. This job keeps
a watermark per log partition and takes the smallest over the active ones, the
rule of ``operators.watermarks``. Each micro-batch is a fold over what the one
before left in the shared state folder:

* ``marks/<batch>.json``: the watermark in force, and for each log partition the
  largest event time and the last arrival so far (one small entry per partition).
  It is written before anything else and never changed, so a repeated batch takes
  the same decision although the clock has moved on;
* ``open/batch_id=<batch>``: partial statistics of the windows still open, a row
  per device and window.

Windows whose end the watermark has reached go to the table, late and rejected
readings to the dead letters; all outputs are keyed by the batch, so a repeated
batch replaces its own. State of batches before the last one is removed.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import envelope
from ..operators.watermarks import IDLE_MS
from ..operators.windows import WATERMARK_DELAY_MS, WINDOW_MS
from ..plans.tables import CommitConflict, Table, create_file, path_exists, read_file, remove
from ..schema import AGG_TABLE
from .jobs import _start, classified_stream, write_dead_letters

OPEN = ("device_id string, window_start_ms long, n long, t_sum double, t_min double, t_max double, h_sum double, p_sum double")
#: (batch) -> start of the micro-batch in epoch ms
Clock = Callable[[DataFrame], int]


def wall_clock(batch: DataFrame) -> int:
    return int(time.time() * 1000)


def watermark_in_force(before: dict, now: int, partitions: Sequence[int], delay_ms: int, idle_ms: int) -> int | None:
    """Watermark of a batch that starts at ``now``, from the state after the batch before."""
    held = before["watermark"]
    own = []
    for p in partitions:
        event, arrival = before["partitions"].get(str(p), (None, before["start"]))
        if now - arrival > idle_ms:
            continue
        if event is None:
            return held
        own.append(event - delay_ms)
    return max([min(own), *([] if held is None else [held])]) if own else held


class PartitionWindows:
    """The fold of one job; ``sink`` is its ``foreachBatch`` function."""

    def __init__(self, table: Table, dlq_path: str, state: str, name: str, partitions: Sequence[int], clock: Clock = wall_clock,
                 window_ms: int = WINDOW_MS, delay_ms: int = WATERMARK_DELAY_MS, idle_ms: int = IDLE_MS):
        self.table, self.dlq_path, self.state, self.name = table, dlq_path, state.rstrip("/"), name
        self.partitions, self.clock = list(partitions), clock
        self.window_ms, self.delay_ms, self.idle_ms = window_ms, delay_ms, idle_ms

    def _marks_path(self, batch_id: int) -> str:
        return f"{self.state}/marks/{batch_id:012d}.json"

    def _marks(self, spark: SparkSession, batch: DataFrame, batch_id: int) -> dict:
        """State after this batch, with the watermark in force for it; decided once."""
        path = self._marks_path(batch_id)
        if path_exists(spark, path):
            return json.loads(read_file(spark, path))
        now = self.clock(batch)
        before = {"start": now, "watermark": None, "partitions": {}}
        if batch_id and path_exists(spark, self._marks_path(batch_id - 1)):
            before = json.loads(read_file(spark, self._marks_path(batch_id - 1)))
        after = dict(before["partitions"])
        seen = batch.groupBy("partition").agg(F.max("event_ms").alias("event"), F.max(F.unix_millis("timestamp")).alias("arrival"))
        for row in seen.collect():  # a row per log partition
            event, arrival = after.get(str(row["partition"]), (row["event"], row["arrival"]))
            after[str(row["partition"])] = (max(event, row["event"]), max(arrival, row["arrival"]))
        marks = {"start": before["start"], "watermark": watermark_in_force(before, now, self.partitions, self.delay_ms, self.idle_ms), "partitions": after}
        try:
            create_file(spark, path, json.dumps(marks))
        except CommitConflict:  # another attempt at this batch decided first
            return json.loads(read_file(spark, path))
        return marks

    def _partials(self, on_time: DataFrame) -> DataFrame:
        return on_time.groupBy("device_id", (F.col("window_end_ms") - self.window_ms).alias("window_start_ms")).agg(
            F.count(F.lit(1)).alias("n"), F.sum("temperature_c").alias("t_sum"), F.min("temperature_c").alias("t_min"),
            F.max("temperature_c").alias("t_max"), F.sum("humidity_pct").alias("h_sum"), F.sum("pressure_hpa").alias("p_sum"))

    def _merged(self, spark: SparkSession, partials: DataFrame, batch_id: int) -> DataFrame:
        held = f"{self.state}/open/batch_id={batch_id - 1}"
        if not path_exists(spark, held):
            return partials
        both = spark.read.schema(OPEN).parquet(held).unionByName(partials)
        return both.groupBy("device_id", "window_start_ms").agg(
            F.sum("n").alias("n"), F.sum("t_sum").alias("t_sum"), F.min("t_min").alias("t_min"), F.max("t_max").alias("t_max"),
            F.sum("h_sum").alias("h_sum"), F.sum("p_sum").alias("p_sum"))

    def sink(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            watermark = self._marks(spark, batch, batch_id)["watermark"]
            end = F.col("event_ms") - F.pmod(F.col("event_ms"), F.lit(self.window_ms)) + F.lit(self.window_ms)
            rows = batch.withColumn("window_end_ms", end)
            fired = F.lit(False) if watermark is None else F.col("window_end_ms") <= F.lit(watermark)
            late = F.col("stage").isNull() & fired
            dlq = rows.filter(F.col("stage").isNotNull() | late).select(
                F.when(late, envelope.late_event("device_id", "event_ms"))
                 .otherwise(envelope.envelope_for_stage("stage", "reject_reason", "device_id", payload_len="payload_len")).alias("value"))
            windows = self._merged(spark, self._partials(rows.filter(F.col("stage").isNull() & ~fired)), batch_id)
            due = F.lit(False) if watermark is None else F.col("window_start_ms") + self.window_ms <= F.lit(watermark)
            write_dead_letters(dlq, self.dlq_path, self.name, batch_id)
            marked = windows.withColumn("due", due).persist()
            try:
                marked.filter(~F.col("due")).drop("due").write.mode("overwrite").parquet(f"{self.state}/open/batch_id={batch_id}")
                self.table.commit_batch(self._rows(marked.filter("due")), writer=self.name, batch_id=batch_id)
            finally:
                marked.unpersist()
            for path in (f"{self.state}/open/batch_id={batch_id - 2}", self._marks_path(batch_id - 2)):
                remove(spark, path)
        finally:
            batch.unpersist()

    def _rows(self, windows: DataFrame) -> DataFrame:
        return windows.select(
            "device_id", F.timestamp_millis("window_start_ms").alias("window_start"),
            F.timestamp_millis(F.col("window_start_ms") + self.window_ms).alias("window_end"), F.col("n").alias("reading_count"),
            (F.col("t_sum") / F.col("n")).alias("avg_temperature_c"), F.col("t_min").alias("min_temperature_c"), F.col("t_max").alias("max_temperature_c"),
            (F.col("h_sum") / F.col("n")).alias("avg_humidity_pct"), (F.col("p_sum") / F.col("n")).alias("avg_pressure_hpa")).select(*AGG_TABLE.fieldNames())


def start_partition_window_job(log: DataFrame, table: Table, dlq_path: str, checkpoint: str, partitions: Sequence[int],
                               trigger: dict | None = None, name: str = "telemetry_1m_by_partition", **options):
    """Log -> decode -> gate -> windows under the watermark of active log partitions -> table + dead letters."""
    fold = PartitionWindows(table, dlq_path, f"{checkpoint}-state", name, partitions, **options)
    return _start(classified_stream(log), fold.sink, checkpoint, trigger, name)
