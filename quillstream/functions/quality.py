"""Plausibility gate (P2, P3) and stage classification (P4) as column expressions.

The gate is one chained ``CASE WHEN``: first failing rule wins. It runs inside
whole-stage codegen and is shared by batch queries and streams. A NULL device is
an empty one, a NULL ``ts`` no positive one and a NULL measure not finite.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- Fixed values (must equal the reference's gate) -------------------------
# Inclusive bounds per measure, checked in this order after device_id and ts.
RANGE_RULES = [
    ("temperature_c", -60.0, 150.0),
    ("humidity_pct", 0.0, 100.0),
    ("pressure_hpa", 800.0, 1100.0),
    ("vibration_g", 0.0, 50.0),
]
REASON_EMPTY_DEVICE = "empty device_id"
REASON_NON_POSITIVE_TS = "non-positive ts: "
REASON_NOT_FINITE = " not finite: "
REASON_OUT_OF_RANGE = " out of range ["
REASON_TOO_SHORT = "null payload or too short"
REASON_TS_OVERFLOW = "ts out of timestamp range: "  # our guard, not in the reference
# Stage names used in dead letters.
STAGE_DESERIALIZE = "deserialize"
STAGE_VALIDATE = "validate"
STAGE_LATE = "late"
# ----------------------------------------------------------------------------

_INF = float("inf")


def _fmt(x: float) -> str:
    # Java/Spark double text for the bound literals (-60.0, 1100.0, ...).
    return repr(float(x))


def not_finite(c: Column) -> Column:
    """NaN, +/-infinity or NULL (F3). Checked before the range test: NaN > x is true in Spark."""
    return c.isNull() | F.isnan(c) | c.isin(_INF, -_INF)


def _range_reason(field: str, lo: float, hi: float, c: Column) -> tuple[Column, Column]:
    text = F.coalesce(c.cast("string"), F.lit("null"))
    nf = not_finite(c)
    oor = (c < F.lit(lo)) | (c > F.lit(hi))
    reason = (F.when(nf, F.concat(F.lit(field + REASON_NOT_FINITE), text))
              .when(oor, F.concat(F.lit(f"{field}{REASON_OUT_OF_RANGE}{_fmt(lo)}, {_fmt(hi)}]: "), text)))
    return nf | oor, reason


def reject_reason(prefix: str = "", ts_col: str = "ts") -> Column:
    """Reason text of the first failing rule, NULL for a plausible reading.

    ``prefix`` addresses nested fields (e.g. ``"reading."``).
    """
    col = lambda n: F.col(prefix + n)
    ts = col(ts_col)
    expr = F.when(F.coalesce(col("device_id"), F.lit("")) == F.lit(""), F.lit(REASON_EMPTY_DEVICE))
    expr = expr.when(ts.isNull() | (ts <= 0), F.concat(F.lit(REASON_NON_POSITIVE_TS), F.coalesce(ts.cast("string"), F.lit("null"))))
    for field, lo, hi in RANGE_RULES:
        bad, reason = _range_reason(field, lo, hi, col(field))
        expr = expr.when(bad, reason)
    # Our guard: a ts the timestamp type cannot hold is dead-lettered, not a crash.
    expr = expr.when(F.abs(ts) > F.lit(9223372036854775),
                     F.concat(F.lit(REASON_TS_OVERFLOW), ts.cast("string")))
    return expr


def reject_field(prefix: str = "", ts_col: str = "ts") -> Column:
    """Name of the field that failed the gate (``device_id``, ``ts`` or a measure)."""
    col = lambda n: F.col(prefix + n)
    expr = F.when(F.coalesce(col("device_id"), F.lit("")) == F.lit(""), F.lit("device_id"))
    expr = expr.when(col(ts_col).isNull() | (col(ts_col) <= 0), F.lit("ts"))
    for field, lo, hi in RANGE_RULES:
        c = col(field)
        expr = expr.when(not_finite(c) | (c < F.lit(lo)) | (c > F.lit(hi)), F.lit(field))
    expr = expr.when(F.abs(col(ts_col)) > F.lit(9223372036854775), F.lit("ts"))
    return expr


def plausible(prefix: str = "", ts_col: str = "ts") -> Column:
    """Boolean form of the gate: true iff ``reject_reason`` would be NULL.

    Cheaper than testing the reason text (no string building per row), and a
    plain conjunction Catalyst can push into scans.
    """
    col = lambda n: F.col(prefix + n)
    ts = col(ts_col)
    ok = (F.coalesce(col("device_id"), F.lit("")) != F.lit("")) & (ts > 0) & (ts <= F.lit(9223372036854775))
    for field, lo, hi in RANGE_RULES:
        c = col(field)
        ok = ok & ~not_finite(c) & (c >= F.lit(lo)) & (c <= F.lit(hi))
    return F.coalesce(ok, F.lit(False))


def reason_field(reason: Column) -> Column:
    """Failing field recovered from a reason text (for dead-letter triage, P8)."""
    return (F.when(reason.startswith("empty device_id"), F.lit("device_id"))
            .when(reason.startswith("non-positive ts") | reason.startswith("ts out of"), F.lit("ts"))
            .otherwise(F.regexp_extract(reason, r"^([a-z_]+) (not finite|out of range)", 1)))


def classify(df: DataFrame, decoded_col: str | None = None, prefix: str = "",
             ts_col: str = "ts") -> DataFrame:
    """Route every row to exactly one output.

    Adds ``reject_reason`` and ``stage``: ``deserialize`` for rows that failed to
    decode (``decoded_col`` false), ``validate`` for gate rejects, NULL for rows
    bound for the table. No filter is applied here, so a stream keeps every row
    in front of its watermark (see ``operators.windows``).
    """
    reason = reject_reason(prefix, ts_col)
    if decoded_col is not None:
        ok = F.col(decoded_col)
        out = df.withColumn("reject_reason", F.when(ok, reason).otherwise(F.col("decode_error")))
        return out.withColumn(
            "stage",
            F.when(~ok, F.lit(STAGE_DESERIALIZE))
             .when(F.col("reject_reason").isNotNull(), F.lit(STAGE_VALIDATE)))
    out = df.withColumn("reject_reason", reason)
    return out.withColumn("stage", F.when(F.col("reject_reason").isNotNull(), F.lit(STAGE_VALIDATE)))


def to_table_row(df: DataFrame, prefix: str = "", ts_col: str = "ts", keep: Sequence[Column] = ()) -> DataFrame:
    """Reading -> table row (P1): millis -> timestamp, empty firmware -> NULL (F2);
    ``keep`` are further columns."""
    from .timefn import millis_to_ts

    col = lambda n: F.col(prefix + n)
    return df.select(
        col("device_id").alias("device_id"),
        col("site_id").alias("site_id"),
        millis_to_ts(col(ts_col)).alias("ts"),
        col("temperature_c").alias("temperature_c"),
        col("humidity_pct").alias("humidity_pct"),
        col("pressure_hpa").alias("pressure_hpa"),
        col("vibration_g").alias("vibration_g"),
        F.nullif(col("firmware_version"), F.lit("")).alias("firmware_version"),
        *keep,
    )
