"""Stream-health queries (MET1-MET7, F8) as DataFrame jobs.

* ``counter_rate``: per-second rate of a counter over the last minute at each
  scrape, per series (``rate(x[1m])``), and ``sum_by`` over series. Events are
  first counted per (series, scrape interval); each count then enters the
  scrapes whose range covers it, so every scrape that saw events in its range
  has a row and nothing is sorted. Sampled counters are in ``operators.rates``.
* ``ProgressLog`` writes every progress report of a query to the shared folder as it
  comes (the query's own list is a short ring buffer); ``stored_progress`` and
  ``health_summary``/``offset_lag``/``consumer_lag`` turn reports into rows (batches, rows/s, trigger duration, state memory,
  uptime, the router's observed counters, lag behind the log's end).
"""

from __future__ import annotations

import json
import queue
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

SCRAPE_MS = 15_000
RATE_RANGE_MS = 60_000


def counter_rate(df: DataFrame, series_col: str, time_ms_col: str,
                 scrape_ms: int = SCRAPE_MS, range_ms: int = RATE_RANGE_MS) -> DataFrame:
    """Events per second over the trailing ``range_ms``, at each scrape whose range holds events."""
    bucket = F.floor(F.col(time_ms_col) / F.lit(scrape_ms)).cast("long")
    per = df.groupBy(F.col(series_col).alias("series"), bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    ahead = F.explode(F.sequence(F.lit(1), F.lit(range_ms // scrape_ms))).alias("ahead")
    seen = per.select("series", "n", "bucket", ahead).withColumn("scrape_ms", (F.col("bucket") + F.col("ahead")) * F.lit(scrape_ms))
    return seen.groupBy("series", "scrape_ms").agg((F.sum("n") / F.lit(range_ms / 1000.0)).alias("rate_per_sec"))


def sum_by(rates: DataFrame, *by: str) -> DataFrame:
    """Rates summed over all series that agree in ``by``, at each scrape."""
    return rates.groupBy(*by, "scrape_ms").agg(F.sum("rate_per_sec").alias("rate_per_sec"))


class ProgressLog(StreamingQueryListener):
    """Writes each progress report of queries with one name to ``path`` as it comes, while entered.

    Reports wait in a queue of at most ``waiting``; the stream waits when it is full. What is
    written is there whatever becomes of the job or the driver, in a file per run and batch."""

    def __init__(self, spark: SparkSession, name: str, path: str, waiting: int = 256):
        self.spark, self.name, self.path = spark, name, path.rstrip("/")
        self.queue: queue.Queue[tuple[str, int, str] | None] = queue.Queue(waiting)
        self.writer = threading.Thread(target=self._write, daemon=True)
        self.failure: Exception | None = None
        self.started: set[str] = set()
        self.ended: set[str] = set()
        self.quiet = threading.Event()

    def __enter__(self) -> ProgressLog:
        self.writer.start()
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *exc) -> None:
        self.quiet.wait(30)  # reports arrive a little after the query ends
        self.spark.streams.removeListener(self)
        self.queue.put(None)
        self.writer.join()
        if self.failure is not None and exc[0] is None:
            raise self.failure

    def _write(self) -> None:
        from ..plans.tables import replace_file

        while (entry := self.queue.get()) is not None:
            run, batch, report = entry
            try:
                replace_file(self.spark, f"{self.path}/{run}-{batch:012d}.json", report + "\n")
            except Exception as e:  # noqa: BLE001  raised on leaving; the queue must go on emptying
                self.failure = e

    def onQueryStarted(self, event) -> None:
        if event.name == self.name:
            self.started.add(str(event.runId))
            self.quiet.clear()

    def onQueryProgress(self, event) -> None:
        if event.progress.name == self.name:
            self.queue.put((str(event.progress.runId), int(event.progress.batchId), event.progress.json))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) in self.started:
            self.ended.add(str(event.runId))
            if self.ended == self.started:
                self.quiet.set()


#: The parts of a progress report that the queries use; offsets stay as JSON text.
REPORT = """name string, batchId long, timestamp string, numInputRows long, processedRowsPerSecond double, durationMs struct<triggerExecution: long>,
stateOperators array<struct<memoryUsedBytes: long>>,
observedMetrics struct<quality: struct<records_valid: long, records_parse_failed: long, records_validation_failed: long>>,
sources array<struct<endOffset: string>>"""


def stored_progress(spark: SparkSession, path: str) -> DataFrame:
    """One row per report that a ``ProgressLog`` wrote; the columns of ``progress_frame``."""
    r = spark.read.schema(REPORT).json(path)
    count = lambda c: F.coalesce(F.col(c), F.lit(0))
    quality = [count(f"observedMetrics.quality.{c}").alias(c) for c in ("records_valid", "records_parse_failed", "records_validation_failed")]
    state = F.aggregate(F.coalesce("stateOperators", F.array()), F.lit(0).cast("long"), lambda a, s: a + F.coalesce(s["memoryUsedBytes"], F.lit(0)))
    # positions are whole numbers by log partition; the offsets of other sources are not
    end = F.when(F.size("sources") == 1, F.col("sources")[0]["endOffset"])
    position = F.when(end.rlike(r'^\{("\d+":\d+,?)+\}$'), F.from_json(end, "map<string, long>"))
    return r.select(F.col("name").alias("query"), F.col("batchId").alias("batch_id"), F.to_timestamp("timestamp").alias("ts"),
                    count("numInputRows").alias("input_rows"), F.coalesce("processedRowsPerSecond", F.lit(0.0)).alias("rows_per_sec"),
                    count("durationMs.triggerExecution").alias("trigger_ms"), state.alias("state_bytes"), *quality, position.alias("position"))


def _position(report: dict) -> dict[str, int] | None:
    """Next offset per log partition that a report of a single offset source ends at."""
    ends = [s.get("endOffset") for s in report.get("sources") or []]
    end = json.loads(ends[0]) if len(ends) == 1 and isinstance(ends[0], str) else ends[0] if len(ends) == 1 else None
    if not isinstance(end, dict) or not all(isinstance(v, int) for v in end.values()):
        return None
    return end


def progress_positions(progress: DataFrame) -> DataFrame:
    """(query, partition, position) from each query's newest stored report that has positions."""
    newest = progress.filter("position IS NOT NULL").groupBy("query").agg(F.max_by("position", F.struct("batch_id", "ts")).alias("position"))
    return newest.select("query", F.explode("position").alias("partition", "position")).withColumn("partition", F.col("partition").cast("int"))


def offset_lag(positions: DataFrame, ends: DataFrame) -> DataFrame:
    """Records behind the log's end (MET1): per query and log partition, from (partition,
    first, end) of the log; a partition without a position is read from its first offset."""
    known = positions.select("query").distinct()  # a row per query
    every = ends.select("partition", "first", F.col("end").alias("log_end")).join(F.broadcast(known), F.lit(True))
    at = F.coalesce("position", "first")
    return every.join(positions, ["query", "partition"], "left").select("query", "partition", at.alias("position"), "log_end", (F.col("log_end") - at).alias("lag"))


def progress_frame(spark: SparkSession, progresses) -> DataFrame:
    """One row per micro-batch progress (list of ``StreamingQueryProgress`` or JSON)."""
    rows = []
    for p in progresses:
        d = json.loads(p.json) if hasattr(p, "json") else (json.loads(p) if isinstance(p, str) else p)
        state = d.get("stateOperators") or []
        obs = (d.get("observedMetrics") or {}).get("quality") or {}
        rows.append((d.get("name"), int(d.get("batchId", 0)), d.get("timestamp"),
                     int(d.get("numInputRows", 0)), float(d.get("processedRowsPerSecond") or 0.0),
                     int((d.get("durationMs") or {}).get("triggerExecution", 0)),
                     int(sum(s.get("memoryUsedBytes", 0) for s in state)),
                     int(obs.get("records_valid", 0)), int(obs.get("records_parse_failed", 0)),
                     int(obs.get("records_validation_failed", 0)), _position(d)))
    schema = ("query string, batch_id long, ts string, input_rows long, rows_per_sec double, "
              "trigger_ms long, state_bytes long, records_valid long, records_parse_failed long, "
              "records_validation_failed long, position map<string, long>")
    return spark.createDataFrame(rows, schema).withColumn("ts", F.to_timestamp("ts"))


def health_summary(progress: DataFrame) -> DataFrame:
    """Dashboard numbers per query: completed batches (MET4), input rows and
    mean rows/s (MET2), last trigger duration (MET3), state size (MET5),
    seconds since the first report (MET6) and quality counters (MET7)."""
    last = F.max_by
    return progress.groupBy("query").agg(
        (F.max("batch_id") + 1).alias("completed_batches"),
        F.count_if(F.col("input_rows") > 0).alias("input_batches"),
        F.sum("input_rows").alias("input_rows"),
        F.avg("rows_per_sec").alias("avg_rows_per_sec"),
        last("trigger_ms", "batch_id").alias("last_trigger_ms"),
        last("state_bytes", "batch_id").alias("state_bytes"),
        (F.unix_seconds(F.current_timestamp()) - F.unix_seconds(F.min("ts"))).alias("uptime_s"),
        F.sum("records_valid").alias("records_valid"),
        F.sum("records_parse_failed").alias("records_parse_failed"),
        F.sum("records_validation_failed").alias("records_validation_failed"))


def consumer_lag(spark: SparkSession, progresses) -> DataFrame:
    """Records between a query's position and the end of its log (MET1), per query and
    topic, from the latest report of each query that names both offsets."""
    latest: dict[str, dict] = {}
    for p in progresses:
        d = json.loads(p) if isinstance(p, str) else p
        if int(d.get("batchId", 0)) >= int(latest.get(d.get("name"), {}).get("batchId", -1)):
            latest[d.get("name")] = d
    rows = []
    for name, d in latest.items():
        for source in d.get("sources") or []:
            end, last = source.get("endOffset"), source.get("latestOffset")
            end, last = (json.loads(x) if isinstance(x, str) else x for x in (end, last))
            for topic, parts in (last or {}).items():
                if isinstance(parts, dict) and isinstance(end, dict):
                    rows += [(name, topic, int(q), int(o) - int((end.get(topic) or {}).get(q, 0))) for q, o in parts.items()]
    frame = spark.createDataFrame(rows, "query string, topic string, partition int, lag long")
    return frame.groupBy("query", "topic").agg(F.sum("lag").alias("lag"))
