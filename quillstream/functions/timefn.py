"""Time column functions.

All functions return Column expressions, so they stay inside whole-stage
codegen; nothing here runs Python per row.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Largest |millis| that fits in a microsecond timestamp without overflow.
MAX_ABS_MILLIS = 9223372036854775


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def millis_in_range(ms: Column | str) -> Column:
    """True when ``timestamp_millis(ms)`` cannot overflow."""
    ms = _c(ms)
    return ms.isNotNull() & (F.abs(ms) <= F.lit(MAX_ABS_MILLIS))


def millis_to_ts(ms: Column | str) -> Column:
    """Epoch millis -> timestamp (F1); NULL instead of an overflow error."""
    ms = _c(ms)
    return F.when(millis_in_range(ms), F.timestamp_millis(ms))


def ts_to_millis(ts: Column | str) -> Column:
    """Timestamp (or timestamp_ntz, read as UTC) -> epoch millis."""
    return F.unix_millis(_c(ts).cast("timestamp"))


def normalise_ts_millis(raw: Column | str) -> Column:
    """Bridge timestamp normaliser.

    A number is taken as epoch millis and truncated toward zero; a string is
    parsed as ISO-8601 and converted to UTC millis (a string without offset is
    read in the session time zone, which the library pins to UTC).
    """
    raw = _c(raw).cast("string")
    as_number = raw.try_cast("double")
    number_ms = F.when(F.abs(as_number) < F.lit(9.2e18), as_number.cast("long"))
    iso = F.regexp_replace(F.trim(raw), r"(\d)T(\d)", "$1 $2")
    iso = F.regexp_replace(iso, r"( \d{2}:\d{2})(Z|[+-].*)?$", "$1:00$2")  # seconds may be left out
    iso_ms = F.unix_millis(F.try_to_timestamp(iso))
    # A numeric string is millis, otherwise the ISO form.
    return F.coalesce(number_ms, iso_ms)


def _day_lit(value) -> _dt.date:
    if isinstance(value, _dt.datetime):
        value = value.astimezone(_dt.timezone.utc) if value.tzinfo else value
        return value.date()
    if isinstance(value, _dt.date):
        return value
    return _dt.datetime.fromisoformat(str(value).replace("Z", "+00:00")).date()


def ts_between(df: DataFrame, lo, hi, ts_col: str = "ts", day_col: str | None = None) -> DataFrame:
    """Time-range filter on the raw event time with day-partition pruning (P10).

    Adds the equivalent predicate on the day column so Parquet partition
    pruning applies (Catalyst does not derive it from a filter on ``ts``).
    ``lo`` inclusive, ``hi`` exclusive; literals are UTC.
    """
    day_col = day_col or f"{ts_col}_day"
    lo_l, hi_l = F.lit(lo).cast("timestamp"), F.lit(hi).cast("timestamp")
    out = df.filter((F.col(ts_col).cast("timestamp") >= lo_l) & (F.col(ts_col).cast("timestamp") < hi_l))
    if day_col in df.columns:
        out = out.filter((F.col(day_col) >= F.lit(_day_lit(lo))) & (F.col(day_col) <= F.lit(_day_lit(hi))))
    return out
