"""Dead-letter envelopes (P5-P7, J4) and their parsed view.

Each envelope is ``to_json`` of a struct with a fixed key order; NULL values
are kept as JSON ``null`` (``ignoreNullFields=false``) so a missing reason is
still visible. Spark escapes control characters, so any reason text stays
valid JSON.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import DLQ_PARSED
from .quality import STAGE_DESERIALIZE, STAGE_LATE, STAGE_VALIDATE

_KEEP_NULLS = {"ignoreNullFields": "false"}


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_failure(reason: Column | str, payload_len: Column | str) -> Column:
    """``{"stage":"deserialize","reason":…,"payload_len":n}``; no payload -> 0."""
    return F.to_json(F.struct(
        F.lit(STAGE_DESERIALIZE).alias("stage"),
        _c(reason).cast("string").alias("reason"),
        F.coalesce(_c(payload_len), F.lit(0)).cast("long").alias("payload_len"),
    ), _KEEP_NULLS)


def validation_failure(reason: Column | str, device_id: Column | str) -> Column:
    """``{"stage":"validate","device_id":…,"reason":…}``."""
    return F.to_json(F.struct(
        F.lit(STAGE_VALIDATE).alias("stage"),
        _c(device_id).cast("string").alias("device_id"),
        _c(reason).cast("string").alias("reason"),
    ), _KEEP_NULLS)


def late_event(device_id: Column | str, event_ts_ms: Column | str) -> Column:
    """``{"stage":"late","device_id":…,"event_ts":ms}`` (values are not kept)."""
    return F.to_json(F.struct(
        F.lit(STAGE_LATE).alias("stage"),
        _c(device_id).cast("string").alias("device_id"),
        _c(event_ts_ms).cast("long").alias("event_ts"),
    ), _KEEP_NULLS)


def envelope_for_stage(stage: Column | str, reason: Column | str, device_id: Column | str,
                       payload: Column | str | None = None,
                       event_ts_ms: Column | str | None = None, payload_len: Column | str | None = None) -> Column:
    """Pick the envelope shape by stage (one expression for a tagged stream); the
    length of a payload is taken from it or given."""
    stage = _c(stage)
    size = _c(payload_len) if payload_len is not None else F.octet_length(_c(payload)) if payload is not None else F.lit(None).cast("int")
    ts_c = _c(event_ts_ms) if event_ts_ms is not None else F.lit(None).cast("long")
    return (F.when(stage == STAGE_DESERIALIZE, parse_failure(reason, size))
            .when(stage == STAGE_VALIDATE, validation_failure(reason, device_id))
            .when(stage == STAGE_LATE, late_event(device_id, ts_c)))


def parse_envelope(value: Column | str) -> Column:
    """Parsed struct of any envelope shape (missing keys -> NULL)."""
    return F.from_json(_c(value), DLQ_PARSED)
