"""Watermark per log partition with idleness (W1, W3), in batch form.

Each log partition has a watermark of its own: its largest event time so far
minus the allowed delay. The watermark in force is the smallest over the
partitions that are active; a partition that has been silent for longer than
the idle timeout is left out, and a partition that has sent nothing yet holds
the watermark back until it counts as silent. The watermark never goes back.

The clock is that of the micro-batches: batch ``b`` starts at ``b * trigger_ms``
and sees what arrived before. Besides the batches with rows, the watermark is
looked at where a partition falls silent, as it may advance there without rows.

Readings are reduced to one row per (batch, log partition) before anything is
ordered; running maxima are cut into chunks of batches (``operators.running``).
What one task orders at the end is a row per batch, which grows with time only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .running import running_max
from .util import materialize_small
from .windows import WATERMARK_DELAY_MS, WINDOW_MS

IDLE_MS = 60_000
#: micro-batches per chunk of a log partition's running maximum
CHUNK_BATCHES = 4096


def partition_states(df: DataFrame, partitions: Sequence[int], batch_col: str, partition_col: str = "partition", event_ms_col: str = "ts_ms",
                     arrival_ms_col: str = "arrival_ms", trigger_ms: int = 30_000, delay_ms: int = WATERMARK_DELAY_MS,
                     idle_ms: int = IDLE_MS) -> DataFrame:
    """(batch, log partition) with ``partition_ms``, the partition's own watermark, and
    ``active``, at the start of every batch with rows and wherever a partition falls silent.

    ``partitions`` are the log's partitions, those without a record included."""
    per = df.groupBy(F.col(batch_col).cast("long").alias("batch"), F.col(partition_col).cast("int").alias("p")).agg(
        F.max(event_ms_col).alias("event"), F.max(arrival_ms_col).alias("arrival"))
    per = materialize_small(per)  # a row per batch and log partition, read four times below
    ends = per.agg(F.min("batch").alias("start"), F.max("batch").alias("end"))  # one row
    # the first batch that starts more than the idle timeout after an arrival, or after the start
    silent = per.select((F.floor((F.col("arrival") + idle_ms) / F.lit(trigger_ms)) + 1).cast("long").alias("batch")).union(
        ends.select((F.floor((F.col("start") * trigger_ms + idle_ms) / F.lit(trigger_ms)) + 1).cast("long")))
    looks = per.select("batch").union(silent).distinct().join(F.broadcast(ends), F.col("batch") <= F.col("end"))
    grid = looks.select("batch", "start", F.explode(F.array(*[F.lit(int(p)) for p in partitions])).alias("p"))
    seen = running_max(grid.join(per, ["batch", "p"], "left"), ["p"], "batch", {"event": "max_event", "arrival": "last_arrival"}, CHUNK_BATCHES)
    since = F.coalesce(F.col("last_arrival"), F.col("start") * trigger_ms)
    return seen.select("batch", F.col("p").alias("partition"), (F.col("max_event") - delay_ms).alias("partition_ms"),
                       (F.col("batch") * trigger_ms - since <= idle_ms).alias("active"))


def combined_watermarks(states: DataFrame) -> DataFrame:
    """(batch, watermark_ms): the smallest watermark of active partitions, held by one
    without any and kept where none is active; it never goes back."""
    of_active = F.when(F.col("active"), F.col("partition_ms"))
    per = states.groupBy("batch").agg(F.min(of_active).alias("least"), F.count_if(F.col("active") & F.col("partition_ms").isNull()).alias("waiting"))
    candidate = F.when(F.col("waiting") == 0, F.col("least"))
    so_far = Window.orderBy("batch").rowsBetween(Window.unboundedPreceding, 0)
    return per.select("batch", F.max(candidate).over(so_far).alias("watermark_ms"))


def classify_late_by_partition(df: DataFrame, partitions: Sequence[int], batch_col: str, event_ms_col: str = "ts_ms",
                               watermark_source: DataFrame | None = None, window_ms: int = WINDOW_MS, **options) -> DataFrame:
    """``df`` with ``watermark_ms``, ``window_end_ms`` and ``is_late`` under the rule above.

    ``watermark_source`` is the stream that the watermark follows (default ``df``):
    pass the unfiltered one, as rejected readings move the watermark too."""
    source = watermark_source if watermark_source is not None else df
    states = partition_states(source, partitions, batch_col, event_ms_col=event_ms_col, **options)
    marks = materialize_small(combined_watermarks(states)).withColumnRenamed("batch", batch_col)
    end = F.col(event_ms_col) - F.pmod(F.col(event_ms_col), F.lit(window_ms)) + F.lit(window_ms)
    out = df.join(marks, batch_col, "left").withColumn("window_end_ms", end)
    return out.withColumn("is_late", F.coalesce(F.col("window_end_ms") <= F.col("watermark_ms"), F.lit(False)))
