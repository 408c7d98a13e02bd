"""The three streaming jobs (W1-W11, SNK1-SNK3): append, upsert, windowed.

All start from a log-shaped stream (``sources.log.read_log_stream``), decode and
classify every record (no filter in front of the watermark), observe the
router's quality counters (A6, MET7) and write in ``foreachBatch``: the table
commit is keyed by ``(writer, batch_id)`` and the dead letters go to
``<dlq>/writer=<name>/batch_id=<n>`` with partition overwrite, so a replayed
micro-batch replaces its own output (exactly-once effect for both) and jobs can
share one dead-letter sink. A job that starts from a new checkpoint counts its
batches from zero again and so needs a new name. Restarting with the same
checkpoint location resumes from the saved offsets (W9); state lives in the
RocksDB state store (W11).
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import envelope
from ..functions.quality import to_table_row
from ..operators import route
from ..operators.upsert import latest_by_key
from ..plans.merged import merge_batch
from ..plans.tables import Table
from ..schema import AGG_TABLE, READING_FIELDS, TELEMETRY_TABLE, UPSERT_TABLE
from ..sources.log import decode_and_classify
from .late_windows import OUTPUT, LateAwareWindows

WATERMARK_DELAY = "5 seconds"
TRIGGER = "30 seconds"
READING_NAMES = [n for n, _ in READING_FIELDS]


def write_dead_letters(dlq: DataFrame, dlq_path: str, writer: str, batch_id: int) -> None:
    """Idempotent dead-letter write for one micro-batch of one job (SNK3)."""
    (dlq.withColumn("writer", F.lit(writer)).withColumn("batch_id", F.lit(batch_id).cast("long"))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("writer", "batch_id").parquet(dlq_path))


def read_dead_letters(spark: SparkSession, dlq_path: str) -> DataFrame:
    return spark.read.schema("value string, writer string, batch_id long").parquet(dlq_path)


def dead_letter_places(spark: SparkSession, dlq_path: str) -> DataFrame:
    """(partition, offset) of the dead letters of jobs that keep the log coordinates."""
    places = spark.read.schema("_partition int, _offset long, writer string, batch_id long").parquet(dlq_path)
    return places.select(F.col("_partition").alias("partition"), F.col("_offset").alias("offset")).filter("offset IS NOT NULL")


def classified_stream(log: DataFrame) -> DataFrame:
    """Decoded and classified records with the router's counters observed as ``quality``."""
    return decode_and_classify(log).observe("quality", *route.counter_exprs())


@contextmanager
def state_partitions(spark: SparkSession) -> Iterator[None]:
    """Streams that start in here shuffle, and keep their state, in as many partitions as the
    cluster has cores, or in fewer if the session has fewer: streams do not merge small
    partitions, and each one costs every micro-batch a task and a state commit. A stream
    takes the session's settings when it starts; one that is restarted keeps its number."""
    conf, key = spark.conf, "spark.sql.shuffle.partitions"
    before = conf.get(key)
    conf.set(key, str(min(int(before), max(2, spark.sparkContext.defaultParallelism))))
    try:
        yield
    finally:
        conf.set(key, before)


def _start(df: DataFrame, fn, checkpoint: str, trigger: dict | None, name: str):
    w = df.writeStream.queryName(name).option("checkpointLocation", checkpoint).foreachBatch(fn)
    trigger = trigger or {"processingTime": TRIGGER}
    with state_partitions(df.sparkSession):
        return w.trigger(**trigger).start()


def _start_router(log: DataFrame, table: Table, dlq_path: str, checkpoint: str, trigger: dict | None, name: str, keep: list,
                  merged: Table | None = None):
    """Log -> decode -> gate -> table + dead letters, each written from the batch once cached,
    with the columns that either needs; bytes of decoded records are not kept."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        payload = F.when(F.col("stage").isNotNull(), F.col("value")).alias("value")
        batch = batch.select(*READING_NAMES, "stage", "reject_reason", "partition", "offset", payload).persist()
        try:
            rows = to_table_row(route.valid_rows(batch), keep=keep)
            table.commit_batch(rows, writer=name, batch_id=batch_id)
            if merged is not None:
                merge_batch(merged, rows, batch_id, writer=name)
            write_dead_letters(route.dead_letters(batch, payload_col="value", keep=keep), dlq_path, name, batch_id)
        finally:
            batch.unpersist()

    return _start(classified_stream(log), sink, checkpoint, trigger, name)


def start_append_job(log: DataFrame, table: Table, dlq_path: str, checkpoint: str,
                     trigger: dict | None = None, name: str = "telemetry_append"):
    """Log -> decode -> gate -> append table + dead letters (3.1)."""
    return _start_router(log, table, dlq_path, checkpoint, trigger, name, [])


def start_upsert_job(log: DataFrame, table: Table, dlq_path: str, checkpoint: str,
                     trigger: dict | None = None, name: str = "telemetry_upsert", merged: Table | None = None):
    """Same front half; the table is a change log with hidden log coordinates,
    merged latest-wins on read (3.3, SNK2); ``merged`` also keeps the current
    state, renewed in the days that each batch touches."""
    keep = [F.col("partition").cast("int").alias("_partition"), F.col("offset").cast("long").alias("_offset")]
    return _start_router(log, table, dlq_path, checkpoint, trigger, name, keep, merged)


def read_upsert_table(table: Table, as_of: int | None = None) -> DataFrame:
    """Current state of an upsert table: latest ``_offset`` per (device_id, ts)."""
    cur = latest_by_key(table.read(as_of).drop(table.day_col, "part_key"), key=("device_id", "ts"),
                        order_col="_offset")
    return cur.drop("_partition", "_offset")


#: Groups over which the rejects of one log partition are dealt; they touch no state.
REJECT_GROUPS = 64


def window_stream(log: DataFrame) -> DataFrame:
    """Tagged rows (agg / late / reject) of the window job, as a streaming DataFrame.

    The watermark is attached to the event time of every record (rejected and
    undecodable ones too, W2). No filter runs before the stateful operator and
    the timestamp column is projected away, so late rows reach the processor,
    which applies the window-has-fired rule itself (2.7.1 a, d). Rejects need no
    state: their key is their place in the log, dealt over REJECT_GROUPS.
    """
    d = classified_stream(log)
    d = d.withColumn("event_time", F.timestamp_millis("event_ms")).withWatermark("event_time", WATERMARK_DELAY)
    reject_key = F.concat_ws("~", F.lit(""), F.col("partition").cast("string"), F.pmod(F.col("offset"), F.lit(REJECT_GROUPS)).cast("string"))
    keyed = d.select(
        F.when(F.col("stage").isNull(), F.col("device_id")).otherwise(reject_key).alias("_key"),
        "device_id", "event_ms", "stage", "reject_reason", "payload_len",
        "temperature_c", "humidity_pct", "pressure_hpa")
    return keyed.groupBy("_key").transformWithStateInPandas(
        statefulProcessor=LateAwareWindows(), outputStructType=OUTPUT,
        outputMode="Append", timeMode="EventTime")


def start_window_job(log: DataFrame, table: Table, dlq_path: str, checkpoint: str,
                     trigger: dict | None = None, name: str = "telemetry_1m_agg"):
    """Windowed aggregate job (3.2): agg rows -> table, reject + late -> one DLQ."""
    tagged = window_stream(log)

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            agg = batch.filter(F.col("kind") == "agg").select(
                "device_id", F.timestamp_millis("window_start_ms").alias("window_start"),
                F.timestamp_millis("window_end_ms").alias("window_end"), *AGG_TABLE.fieldNames()[3:])
            table.commit_batch(agg, writer=name, batch_id=batch_id)
            dlq = batch.filter(F.col("kind") != "agg").select(
                F.when(F.col("kind") == "late", envelope.late_event("device_id", "event_ts"))
                 .otherwise(envelope.envelope_for_stage("stage", "reason", "device_id", payload_len="payload_len"))
                 .alias("value"))
            write_dead_letters(dlq, dlq_path, name, batch_id)
        finally:
            batch.unpersist()

    return _start(tagged, sink, checkpoint, trigger, name)


def agg_table(spark: SparkSession, root: str, name: str = "telemetry_1m_agg") -> Table:
    return Table(spark, name, AGG_TABLE, "window_start", root=root).create_if_absent()


def telemetry_table(spark: SparkSession, root: str, name: str = "telemetry") -> Table:
    return Table(spark, name, TELEMETRY_TABLE, "ts", root=root).create_if_absent()


def upsert_table(spark: SparkSession, root: str, name: str = "telemetry_upsert") -> Table:
    return Table(spark, name, UPSERT_TABLE, "ts", root=root).create_if_absent()
