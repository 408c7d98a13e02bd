"""Routing and dead letters.

A classified frame (``functions.quality.classify``) has ``stage`` NULL for
table rows and ``deserialize``/``validate`` for dead letters. These helpers
split it, build envelopes, merge dead-letter streams and count outcomes; all
are column expressions and filters, no Python per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import envelope
from ..functions.quality import STAGE_DESERIALIZE, STAGE_VALIDATE, reason_field


def valid_rows(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col("stage").isNull())


def rejected_rows(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col("stage").isNotNull())


def dead_letters(classified: DataFrame, payload_col: str | None = None,
                 device_col: str = "device_id", keep: Sequence[Column] = ()) -> DataFrame:
    """One ``value`` JSON string per rejected row (parse or validation failure), beside the columns of ``keep``."""
    payload = F.col(payload_col) if payload_col else F.lit(None).cast("binary")
    rej = rejected_rows(classified)
    return rej.select(envelope.envelope_for_stage("stage", "reject_reason", device_col, payload).alias("value"), *keep)


def late_dead_letters(late: DataFrame, device_col: str = "device_id",
                      event_ms_col: str = "ts_ms") -> DataFrame:
    """``stage=late`` envelope per late reading."""
    return late.select(envelope.late_event(device_col, event_ms_col).alias("value"))


def merge_dead_letters(*streams: DataFrame) -> DataFrame:
    """Union of dead-letter outputs into one sink."""
    out = streams[0]
    for s in streams[1:]:
        out = out.unionByName(s)
    return out


def parsed_dead_letters(dlq: DataFrame, value_col: str = "value") -> DataFrame:
    """Dead letters with their fields parsed back out of the JSON value."""
    p = dlq.select(envelope.parse_envelope(value_col).alias("e"))
    return p.select("e.stage", "e.device_id", "e.reason", "e.payload_len", "e.event_ts",
                    reason_field(F.col("e.reason")).alias("reason_field"))


def triage(dlq: DataFrame, value_col: str = "value") -> DataFrame:
    """Dead letters counted by stage and failing field."""
    p = parsed_dead_letters(dlq, value_col)
    return (p.groupBy("stage", F.coalesce(F.col("reason_field"), F.lit("")).alias("reason_field"))
             .agg(F.count(F.lit(1)).alias("records")))


def counter_exprs(stage: Column | None = None) -> list[Column]:
    """The three quality counters of a router (A6) as aggregate expressions."""
    st = stage if stage is not None else F.col("stage")
    return [
        F.count_if(st.isNull()).alias("records_valid"),
        F.count_if(st == F.lit(STAGE_DESERIALIZE)).alias("records_parse_failed"),
        F.count_if(st == F.lit(STAGE_VALIDATE)).alias("records_validation_failed"),
    ]


def quality_counters(classified: DataFrame) -> DataFrame:
    return classified.agg(*counter_exprs())
