"""Registered queries that run the streaming jobs end to end.

The log is derived from ``events`` (encoded readings plus damaged records) and
written in one distributed job, a file per hour of arrival time. The files get
the times of their hours, so a file stream with ``maxFilesPerTrigger=1`` and
``availableNow`` replays them in that order, each as one micro-batch. Results
are read back from the tables and dead-letter sets the jobs wrote; the SQL
oracle models the same batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timefn import ts_to_millis
from ..operators import route
from ..operators.health import ProgressLog, counter_rate, health_summary, stored_progress, sum_by
from ..schema import LOG_ROW
from ..sources.events import EPOCH_2024_MS, telemetry_view
from ..sources.log import read_log_stream, to_log_rows
from ..streaming import jobs
from .ingest_queries import CORRUPT_RULES, correction_records
from .queries import DECIMALS, register
from .tables import _fs, list_dirs, new_root

STREAM_BATCH_MS = 3_600_000  # one file (micro-batch) per hour of arrival
ROW_GROUP_BYTES = 1 << 21    # of these files; a file is read in tasks of whole row groups


def write_log_files(log: DataFrame, batch_col: str, path: str) -> int:
    """Write log rows as one file per batch, in one job; a batch's file time
    follows from its number, as file streams replay by file time. Files have small
    row groups, so that a large batch is not one task. Returns the count."""
    spark = log.sparkSession
    log.repartition(batch_col).write.option("parquet.block.size", ROW_GROUP_BYTES).partitionBy(batch_col).parquet(path)
    names = [n for n in list_dirs(spark, path) if n.startswith(f"{batch_col}=")]
    for name in names:  # one per batch
        fs, p = _fs(spark, f"{path}/{name}")
        for status in fs.listStatus(p):
            fs.setTimes(status.getPath(), EPOCH_2024_MS + 1000 * int(name.split("=")[1]), -1)
    return len(names)


def _stream_log(spark, sf_dir) -> DataFrame:
    tv = telemetry_view(spark, sf_dir)
    log = to_log_rows(tv).withColumn("value", F.expr(CORRUPT_RULES))
    batch = F.floor((F.unix_millis("timestamp") - F.lit(EPOCH_2024_MS)) / F.lit(STREAM_BATCH_MS)).cast("long")
    return log.withColumn("_batch", batch)


def _files_source(spark, root: str):
    return read_log_stream(spark, path=f"{root}/log/*", max_files_per_trigger=1)


def _run(start, *args, name: str, progress: str, **options) -> None:
    """Run a job over all there is; its progress reports go to ``progress``."""
    spark = args[0].sparkSession
    with ProgressLog(spark, name, progress):
        query = start(*args, trigger={"availableNow": True}, name=name, **options)
        query.awaitTermination()
        if query.exception() is not None:
            raise query.exception()


def run_append(spark, sf_dir):
    root = new_root(spark, "stream-append")
    write_log_files(_stream_log(spark, sf_dir), "_batch", f"{root}/log")
    table = jobs.telemetry_table(spark, root)
    _run(jobs.start_append_job, _files_source(spark, root), table, f"{root}/dlq", f"{root}/ckpt/append", name="append", progress=f"{root}/progress")
    return table, f"{root}/dlq"


def run_window(spark, sf_dir):
    root = new_root(spark, "stream-window")
    write_log_files(_stream_log(spark, sf_dir), "_batch", f"{root}/log")
    table = jobs.agg_table(spark, root)
    _run(jobs.start_window_job, _files_source(spark, root), table, f"{root}/dlq", f"{root}/ckpt/window", name="window", progress=f"{root}/progress")
    return table, f"{root}/dlq"


def run_upsert(spark, sf_dir):
    root = new_root(spark, "stream-upsert")
    log = _stream_log(spark, sf_dir)
    last = log.agg(F.max("_batch")).first()[0]
    corr = to_log_rows(correction_records(spark, sf_dir)).withColumn("_batch", F.lit(last + 1).cast("long"))
    write_log_files(log.unionByName(corr), "_batch", f"{root}/log")
    table = jobs.upsert_table(spark, root)
    _run(jobs.start_upsert_job, _files_source(spark, root), table, f"{root}/dlq", f"{root}/ckpt/upsert", name="upsert", progress=f"{root}/progress")
    return table, f"{root}/dlq"


_ROW_COLS = ["device_id", "site_id", "temperature_c", "humidity_pct", "pressure_hpa", "vibration_g",
             "firmware_version"]


@register("stream_append")
def q_stream_append(spark, sf_dir):
    """Append job over the replayed log: table rows (W8, SNK1, P1-P4)."""
    table, _ = run_append(spark, sf_dir)
    return table.read().select("device_id", "site_id", ts_to_millis("ts").alias("ts_ms"), *_ROW_COLS[2:])


@register("stream_dead_letters")
def q_stream_dead_letters(spark, sf_dir):
    """Append job dead letters, parsed (SNK3, P5, P6)."""
    _, dlq = run_append(spark, sf_dir)
    p = route.parsed_dead_letters(jobs.read_dead_letters(spark, dlq))
    return p.select("stage", "device_id", "payload_len", "reason_field")


@register("stream_window")
def q_stream_window(spark, sf_dir):
    """Window job: 1-minute aggregates emitted as windows close."""
    table, _ = run_window(spark, sf_dir)
    return table.read().select("device_id", ts_to_millis("window_start").alias("window_start_ms"),
                               ts_to_millis("window_end").alias("window_end_ms"), "reading_count",
                               *[F.round(c, DECIMALS).alias(c) if c.startswith("avg") else c for c in (
                                   "avg_temperature_c", "min_temperature_c", "max_temperature_c",
                                   "avg_humidity_pct", "avg_pressure_hpa")])


@register("stream_window_dead_letters")
def q_stream_window_dead_letters(spark, sf_dir):
    """Window job dead letters: rejects and late readings in one sink."""
    _, dlq = run_window(spark, sf_dir)
    p = route.parsed_dead_letters(jobs.read_dead_letters(spark, dlq))
    return p.select("stage", "device_id", "event_ts", "payload_len", "reason_field")


@register("stream_upsert")
def q_stream_upsert(spark, sf_dir):
    """Upsert job with corrections: latest record per (device_id, ts) (SNK2, T2, T6)."""
    table, _ = run_upsert(spark, sf_dir)
    cur = jobs.read_upsert_table(table)
    return cur.select("device_id", "site_id", ts_to_millis("ts").alias("ts_ms"), *_ROW_COLS[2:])


@register("stream_health")
def q_stream_health(spark, sf_dir):
    """Stream-health panel numbers of the window job from its stored progress (MET2-MET7); timing values vary."""
    table, _ = run_window(spark, sf_dir)
    return health_summary(stored_progress(spark, f"{table.root}/progress"))


@register("stream_progress")
def q_stream_progress(spark, sf_dir):
    """Batches, input rows and quality counters of each job (MET4, MET7, A6)."""
    out = None
    for run in (run_append, run_upsert, run_window):
        table, _ = run(spark, sf_dir)
        own = health_summary(stored_progress(spark, f"{table.root}/progress")).select(
            "query", "input_batches", "input_rows", "records_valid", "records_parse_failed", "records_validation_failed")
        out = own if out is None else out.unionByName(own)
    return out


@register("stream_completed_batches")
def q_stream_completed_batches(spark, sf_dir):
    """Completed micro-batches and their input rows, from reports written while the jobs ran (MET2, MET4)."""
    out = None
    for run in (run_append, run_upsert):
        table, _ = run(spark, sf_dir)
        own = health_summary(stored_progress(spark, f"{table.root}/progress")).select("query", "completed_batches", "input_rows")
        out = own if out is None else out.unionByName(own)
    return out


@register("reconcile")
def q_reconcile(spark, sf_dir):
    """Losslessness: log records = table rows + dead letters; snapshot total = table rows."""
    table, dlq = run_append(spark, sf_dir)
    parts = {"log_records": spark.read.schema(LOG_ROW).parquet(f"{table.root}/log/*"), "table_rows": table.read(),
             "dead_letters": jobs.read_dead_letters(spark, dlq)}
    counted = None
    for name, rows in parts.items():
        one = rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("part"), "n")
        counted = one if counted is None else counted.unionByName(one)
    snapshot = table.commits().agg(F.max_by("total_records", "commit_id").alias("n")).select(F.lit("snapshot_total").alias("part"), "n")
    counted = counted.unionByName(snapshot)  # four rows
    n = lambda part: F.sum(F.when(F.col("part") == part, F.col("n"))).alias(part)
    out = counted.agg(*[n(p) for p in ("log_records", "table_rows", "snapshot_total", "dead_letters")])
    balanced = (F.col("log_records") == F.col("table_rows") + F.col("dead_letters")) & (F.col("snapshot_total") == F.col("table_rows"))
    return out.withColumn("balanced", balanced)


@register("counter_rate")
def q_counter_rate(spark, sf_dir):
    """Per-device records/s over the last minute at each 15 s scrape (MET2, F8)."""
    v = telemetry_view(spark, sf_dir)
    return counter_rate(v, "device_id", "ts_ms").select(
        F.col("series").alias("device_id"), "scrape_ms", "rate_per_sec")


@register("counter_rate_by_site")
def q_counter_rate_by_site(spark, sf_dir):
    """The same rates summed over the devices of a site (``sum by``, F8)."""
    v = telemetry_view(spark, sf_dir)
    rates = counter_rate(v.withColumn("series_key", F.concat_ws("|", "site_id", "device_id")), "series_key", "ts_ms")
    summed = sum_by(rates.withColumn("site_id", F.split_part("series", F.lit("|"), F.lit(1))), "site_id")
    return summed.withColumn("rate_per_sec", F.round("rate_per_sec", DECIMALS))
