"""Registered queries: one DataFrame builder per operator of the inventory.

Each builder takes ``(spark, sf_dir)``, reads the fixture tables from
``sf_dir`` (or tables Spark derives from them) and returns a lazy DataFrame.
Timestamps are emitted as epoch millis (BIGINT) so results compare exactly
with the SQL oracle in ``plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.quality import to_table_row
from ..functions.timefn import ts_to_millis
from ..operators import route
from ..operators.windows import windowed_stats
from .queries import DECIMALS, QUERIES, classified, late_flagged, register, valid  # noqa: F401


def _stats_ms(stats: DataFrame) -> DataFrame:
    avg = lambda c: F.round(c, DECIMALS).alias(c)
    return stats.select(
        "device_id",
        ts_to_millis("window_start").alias("window_start_ms"),
        ts_to_millis("window_end").alias("window_end_ms"),
        "reading_count", avg("avg_temperature_c"), "min_temperature_c", "max_temperature_c",
        avg("avg_humidity_pct"), avg("avg_pressure_hpa"))


# ------------------------------------------------------------------- queries

@register("window_1m_device")
def q_window_1m_device(spark, sf_dir):
    """Flagship: per-device 1-minute tumbling statistics of plausible readings."""
    rows = to_table_row(valid(spark, sf_dir), ts_col="ts_ms")
    return _stats_ms(windowed_stats(rows))


@register("telemetry_rows")
def q_telemetry_rows(spark, sf_dir):
    """Table rows of the append job."""
    rows = to_table_row(valid(spark, sf_dir), ts_col="ts_ms")
    return rows.select("device_id", "site_id", ts_to_millis("ts").alias("ts_ms"), "temperature_c",
                       "humidity_pct", "pressure_hpa", "vibration_g", "firmware_version")


@register("quality_route")
def q_quality_route(spark, sf_dir):
    """Route of every reading: table or validate dead letter, with reason."""
    c = classified(spark, sf_dir)
    return c.select("seq", "device_id", F.coalesce(F.col("stage"), F.lit("table")).alias("route"),
                    "reject_field", "reject_reason")


@register("quality_reason_counts")
def q_quality_reason_counts(spark, sf_dir):
    c = classified(spark, sf_dir)
    return (c.groupBy(F.coalesce(F.col("stage"), F.lit("table")).alias("route"),
                      F.coalesce(F.col("reject_field"), F.lit("")).alias("reject_field"))
             .agg(F.count(F.lit(1)).alias("records")))


@register("quality_counters")
def q_quality_counters(spark, sf_dir):
    """records_valid / records_parse_failed / records_validation_failed."""
    return route.quality_counters(classified(spark, sf_dir))


@register("late_events")
def q_late_events(spark, sf_dir):
    """Readings whose window had fired before they arrived."""
    lf = late_flagged(spark, sf_dir).filter("is_late")
    return lf.select("seq", "device_id", F.col("ts_ms").alias("event_ts"), "batch_id",
                     "watermark_ms", "window_end_ms")


@register("window_1m_on_time")
def q_window_1m_on_time(spark, sf_dir):
    """Window statistics as the window job emits them: late readings excluded (W6 + A1)."""
    on_time = to_table_row(late_flagged(spark, sf_dir).filter(~F.col("is_late")), ts_col="ts_ms")
    return _stats_ms(windowed_stats(on_time))


def _all_dead_letters(spark, sf_dir) -> DataFrame:
    rejects = route.dead_letters(classified(spark, sf_dir))
    return route.merge_dead_letters(rejects, route.late_dead_letters(late_flagged(spark, sf_dir).filter("is_late")))


@register("dead_letters")
def q_dead_letters(spark, sf_dir):
    """Validation and late dead letters in one sink, parsed back."""
    return route.parsed_dead_letters(_all_dead_letters(spark, sf_dir))


@register("dlq_triage")
def q_dlq_triage(spark, sf_dir):
    """Dead letters counted by stage and failing field."""
    return route.triage(_all_dead_letters(spark, sf_dir))


@register("total_rows")
def q_total_rows(spark, sf_dir):
    """SELECT COUNT(*) AS total_rows (A3)."""
    return valid(spark, sf_dir).agg(F.count(F.lit(1)).alias("total_rows"))


@register("count_by_device")
def q_count_by_device(spark, sf_dir):
    """Readings per device (A4)."""
    return valid(spark, sf_dir).groupBy("device_id").agg(F.count(F.lit(1)).alias("readings"))


@register("device_stats")
def q_device_stats(spark, sf_dir):
    """Per-device count and rounded avg/min/max temperature, ordered by device."""
    v = valid(spark, sf_dir)
    return (v.groupBy("device_id")
             .agg(F.count(F.lit(1)).alias("readings"),
                  F.round(F.avg("temperature_c"), 2).alias("avg_temp"),
                  F.round(F.min("temperature_c"), 2).alias("min_temp"),
                  F.round(F.max("temperature_c"), 2).alias("max_temp"))
             .orderBy("device_id"))


@register("latest_10")
def q_latest_10(spark, sf_dir):
    """Latest 10 readings, column subset (L1, P9); ties broken by device, offset."""
    v = valid(spark, sf_dir)
    return (v.orderBy(F.col("ts_ms").desc(), "device_id", "seq").limit(10)
             .select("device_id", "ts_ms", "temperature_c", "humidity_pct", "firmware_version"))


# Further query groups register themselves on import.
from . import ingest_queries, log_queries, sql_queries, stream_queries, table_queries  # noqa: E402,F401
