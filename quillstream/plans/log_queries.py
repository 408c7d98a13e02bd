"""Registered queries over the log's partitions and offsets.

The log is that of the stream queries with offsets renumbered within each log
partition, as a log has them, and laid out in segment files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.quality import plausible
from ..functions.timefn import ts_to_millis
from ..schema import TELEMETRY_TABLE
from ..operators.health import offset_lag, progress_positions, stored_progress
from ..operators.rates import SCRAPE_MS, sampled_rate
from ..operators.reconcile import reconcile_offsets
from ..operators.running import numbered
from ..operators.watermarks import classify_late_by_partition, combined_watermarks, partition_states
from ..sources.epoch_log import read_epochs, write_keyed_stream
from ..sources.events import LOG_PARTITIONS, batch_of, telemetry_view
from ..sources.offset_log import log_ends, read_offset_stream, read_segments, write_segments
from ..streaming import jobs
from ..streaming.native_windows import start_native_window_job
from ..streaming.partition_windows import start_partition_window_job
from ..streaming.supervise import run_supervised
from .queries import DECIMALS, register
from .stream_queries import STREAM_BATCH_MS, _ROW_COLS, _files_source, _run, _stream_log, write_log_files
from .tables import Table, new_root

PARTITIONS = range(LOG_PARTITIONS)
# --- Fixed values of the offset fixtures ---------------------------------------
SEGMENT = 1 << 16          # offsets per segment file
READ_LIMIT = 100           # offsets of each log partition per limited run
LIMITED_RUNS = 2
GAP = (1, 40, 59)          # log partition, first and last offset that the job never sees
AGAIN = (2, 10, 29)        # log partition, first and last offset whose table rows are written again
OFFSET_CHUNK = 1 << 16
RESTART_MS = 3_600_000     # the sampled counters start again
SKIP_EVERY = 7             # scrapes that are missing
# --------------------------------------------------------------------------------


# ------------------------------------------------------- watermark per log partition

def _batched(spark, sf_dir) -> DataFrame:
    return telemetry_view(spark, sf_dir).withColumn("batch_id", F.expr(batch_of()))


@register("partition_watermarks")
def q_partition_watermarks(spark, sf_dir):
    """Watermark and activity of every log partition, and the one in force, per micro-batch."""
    states = partition_states(_batched(spark, sf_dir), PARTITIONS, "batch_id")
    both = states.join(combined_watermarks(states), "batch")
    return both.select(F.col("batch").alias("batch_id"), "partition", "partition_ms", "active", "watermark_ms")


@register("late_events_by_partition")
def q_late_events_by_partition(spark, sf_dir):
    """Readings whose window had fired under the smallest watermark of active log partitions."""
    every = _batched(spark, sf_dir)
    flagged = classify_late_by_partition(every.filter(plausible(ts_col="ts_ms")), PARTITIONS, "batch_id", watermark_source=every)
    return flagged.filter("is_late").select("seq", "device_id", F.col("ts_ms").alias("event_ts"), "batch_id", "watermark_ms", "window_end_ms")


def _hour_clock(batch: DataFrame) -> int:
    """A replayed batch starts at the beginning of its hour of arrival."""
    first = batch.agg(F.min(F.unix_millis("timestamp"))).first()[0]
    return first // STREAM_BATCH_MS * STREAM_BATCH_MS


def _agg_rows(table: Table) -> DataFrame:
    return table.read().select("device_id", ts_to_millis("window_start").alias("window_start_ms"), ts_to_millis("window_end").alias("window_end_ms"),
                               "reading_count", *[F.round(c, DECIMALS).alias(c) if c.startswith("avg") else c for c in (
                                   "avg_temperature_c", "min_temperature_c", "max_temperature_c", "avg_humidity_pct", "avg_pressure_hpa")])


def run_partition_windows(spark, sf_dir):
    root = new_root(spark, "stream-window-by-partition")
    write_log_files(_stream_log(spark, sf_dir), "_batch", f"{root}/log")
    table = jobs.agg_table(spark, root)
    _run(start_partition_window_job, _files_source(spark, root), table, f"{root}/dlq", f"{root}/ckpt", name="window_by_partition", progress=f"{root}/progress",
         partitions=PARTITIONS, clock=_hour_clock)
    return table, f"{root}/dlq"


@register("stream_window_by_partition")
def q_stream_window_by_partition(spark, sf_dir):
    """Window job under the watermark of active log partitions: windows that have fired."""
    return _agg_rows(run_partition_windows(spark, sf_dir)[0])


@register("stream_window_native")
def q_stream_window_native(spark, sf_dir):
    """Window job on Spark's own windowed aggregation, lenient by one micro-batch."""
    root = new_root(spark, "stream-window-native")
    write_log_files(_stream_log(spark, sf_dir), "_batch", f"{root}/log")
    table = jobs.agg_table(spark, root)
    _run(start_native_window_job, _files_source(spark, root), table, f"{root}/ckpt", name="window_native", progress=f"{root}/progress")
    return _agg_rows(table)


# --------------------------------------------------------------------- offsets

def offset_log(spark, sf_dir) -> DataFrame:
    """The damaged log with offsets 0, 1, 2, ... in each log partition."""
    log = _stream_log(spark, sf_dir).drop("_batch")
    return numbered(log, ["partition"], "offset", "place", OFFSET_CHUNK).drop("offset").withColumnRenamed("place", "offset")


def run_offsets(spark, sf_dir, *limits: int | None):
    """The append job over the segment log, started once per limit from the same
    checkpoint; the positions of each run's last report."""
    root = new_root(spark, "stream-offsets")
    write_segments(offset_log(spark, sf_dir), f"{root}/log", SEGMENT)
    table = jobs.telemetry_table(spark, root)
    for limit in limits:
        source = read_offset_stream(spark, f"{root}/log", limit, f"{root}/positions.json")
        _run(jobs.start_append_job, source, table, f"{root}/dlq", f"{root}/ckpt", name="append_offsets", progress=f"{root}/progress")
    return table, root


@register("stream_append_offsets")
def q_stream_append_offsets(spark, sf_dir):
    """Append job on the source with offsets: limited runs, each resuming where the last ended, then the rest (SRC1, W9)."""
    table, _ = run_offsets(spark, sf_dir, *[READ_LIMIT] * LIMITED_RUNS, None)
    return table.read().select("device_id", "site_id", ts_to_millis("ts").alias("ts_ms"), *_ROW_COLS[2:])


@register("consumer_lag")
def q_consumer_lag(spark, sf_dir):
    """Offsets between the job's position in its progress reports and the log's end, after limited runs (MET1)."""
    _, root = run_offsets(spark, sf_dir, *[READ_LIMIT] * LIMITED_RUNS)
    positions = progress_positions(stored_progress(spark, f"{root}/progress"))
    return offset_lag(positions, log_ends(spark, f"{root}/log")).select("query", "partition", "position", "log_end", "lag")


@register("offset_reconciliation")
def q_offset_reconciliation(spark, sf_dir):
    """Offsets of the log against those of table rows and dead letters, as ranges: the log's own,
    those that never arrived and those that arrived twice (A8); a gap and a repeated write are planted."""
    root = new_root(spark, "reconcile-offsets")
    log = offset_log(spark, sf_dir)
    write_segments(log, f"{root}/log", SEGMENT)
    in_gap = (F.col("partition") == GAP[0]) & F.col("offset").between(GAP[1], GAP[2])
    write_segments(read_segments(spark, f"{root}/log").filter(~in_gap), f"{root}/seen", SEGMENT)
    table = jobs.upsert_table(spark, root)
    _run(jobs.start_upsert_job, read_offset_stream(spark, f"{root}/seen"), table, f"{root}/dlq", f"{root}/ckpt", name="reconciled", progress=f"{root}/progress")
    again = table.read().filter((F.col("_partition") == AGAIN[0]) & F.col("_offset").between(AGAIN[1], AGAIN[2]))
    table.commit_batch(again.select(*table.schema.fieldNames()), writer="again", batch_id=0)
    rows = table.read().select(F.col("_partition").alias("partition"), F.col("_offset").alias("offset"))
    delivered = rows.unionByName(jobs.dead_letter_places(spark, f"{root}/dlq"))
    return reconcile_offsets(read_segments(spark, f"{root}/log"), delivered, OFFSET_CHUNK)


@register("stream_keyed_log")
def q_stream_keyed_log(spark, sf_dir):
    """Readings produced to a log by key, in epochs, and read back: each key's records in order (SNK4)."""
    root = new_root(spark, "stream-keyed")
    write_log_files(_stream_log(spark, sf_dir), "_batch", f"{root}/log")
    rows = _files_source(spark, root).select("key", F.coalesce("value", F.lit(b"")).alias("value"), F.col("offset").alias("order"))
    write_keyed_stream(rows, f"{root}/keyed", f"{root}/ckpt", LOG_PARTITIONS, "keyed", {"availableNow": True}).awaitTermination()
    back = read_epochs(spark, f"{root}/keyed")
    placed = numbered(back.withColumn("device_id", F.col("key").cast("string")), ["device_id"], "offset", "place", OFFSET_CHUNK)
    return placed.select("device_id", "place", F.col("order").alias("seq"))


# ------------------------------------------------------------- supervised runs

class _CrashingTable(Table):
    """A table whose commits fail after the rows are written, once for each batch in ``crashes``."""

    crashes: set[int] = set()

    def publish(self, after, new) -> None:
        for batch in [c[2] for c in new if c[2] in self.crashes]:
            self.crashes.discard(batch)
            raise RuntimeError(f"crash between data and commit of batch {batch}")
        super().publish(after, new)


@register("stream_supervised")
def q_stream_supervised(spark, sf_dir):
    """Append job whose commits crash after the data is written; restarted from its checkpoint,
    its rows are those of an uninterrupted run (W8, W9)."""
    root = new_root(spark, "stream-supervised")
    write_log_files(_stream_log(spark, sf_dir), "_batch", f"{root}/log")
    table = _CrashingTable(spark, "telemetry", TELEMETRY_TABLE, "ts", root=root).create_if_absent()
    table.crashes = {0, 2, 3}
    run_supervised(lambda: jobs.start_append_job(_files_source(spark, root), table, f"{root}/dlq", f"{root}/ckpt",
                                                 trigger={"availableNow": True}, name="supervised"), pause_s=0)
    return table.read().select("device_id", "site_id", ts_to_millis("ts").alias("ts_ms"), *_ROW_COLS[2:])


# ------------------------------------------------------------- sampled counters

def _counter_samples(spark, sf_dir) -> DataFrame:
    """Samples of each device's count of readings at every scrape from its first reading to its
    last; the counter starts again every RESTART_MS and every SKIP_EVERY-th scrape is missing."""
    bucket = F.floor(F.col("ts_ms") / F.lit(SCRAPE_MS)).cast("long")
    series = ["site_id", "device_id"]
    per = telemetry_view(spark, sf_dir).groupBy(*series, bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    spans = per.groupBy(*series).agg(F.min("bucket").alias("low"), F.max("bucket").alias("high"))
    every = spans.select(*series, F.explode(F.sequence("low", "high")).alias("bucket"))
    epoch = F.floor(F.col("bucket") * SCRAPE_MS / F.lit(RESTART_MS)).alias("epoch")
    counted = every.join(per, [*series, "bucket"], "left").select(*series, "bucket", epoch, F.coalesce("n", F.lit(0)).alias("n"))
    so_far = Window.partitionBy(*series, "epoch").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    return (counted.select(*series, ((F.col("bucket") + 1) * SCRAPE_MS).alias("sample_ms"), F.sum("n").over(so_far).alias("value"))
            .filter(F.col("sample_ms") / SCRAPE_MS % SKIP_EVERY != 0))


@register("sampled_rate")
def q_sampled_rate(spark, sf_dir):
    """Per-device rate over the last minute at each scrape, from samples of a counter that restarts (F8, MET2)."""
    rates = sampled_rate(_counter_samples(spark, sf_dir), "site_id", "device_id")
    return rates.select("site_id", "device_id", "scrape_ms", "increase", F.round("rate_per_sec", DECIMALS).alias("rate_per_sec"))


@register("sampled_rate_by_site")
def q_sampled_rate_by_site(spark, sf_dir):
    """The same rates summed over the devices of a site (``sum by``, F8)."""
    rates = sampled_rate(_counter_samples(spark, sf_dir), "site_id", "device_id")
    summed = rates.groupBy("site_id", "scrape_ms").agg(F.sum("increase").alias("increase"), F.sum("rate_per_sec").alias("rate_per_sec"))
    return summed.withColumn("rate_per_sec", F.round("rate_per_sec", DECIMALS))
