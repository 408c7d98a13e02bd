"""Device JSON payloads -> canonical readings (SRC2, SRC3, J1-J3).

Payloads are parsed JVM-side into per-key VARIANTs, so each key's JSON type is known:
numbers, booleans and numeric strings are accepted for the measures
(``float(x)`` semantics), ``ts`` is epoch millis when it is a JSON number or
boolean (truncated) and a full ISO-8601 date with an optional time when it is a
string. ``firmware_version`` defaults to ``""``; it and the two ids have to be
strings or JSON null, which leaves the field at ``""``. A payload that is not
JSON, lacks a required key or has a bad value is counted as an error and dropped
(not dead-lettered), like the bridge.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timefn import normalise_ts_millis

# --- Fixed values -------------------------------------------------------------
DEVICE_TOPIC_FILTER = "sensors/+/+/telemetry"   # '+' = exactly one level
REQUIRED_KEYS = ["device_id", "site_id", "ts", "temperature_c", "humidity_pct", "pressure_hpa", "vibration_g"]
NUMERIC_KEYS = ["temperature_c", "humidity_pct", "pressure_hpa", "vibration_g"]
# ------------------------------------------------------------------------------


def topic_regex(topic_filter: str = DEVICE_TOPIC_FILTER) -> str:
    """MQTT topic filter -> anchored regex (``+`` one level, ``#`` the rest)."""
    parts = []
    for level in topic_filter.split("/"):
        if level == "+":
            parts.append("[^/]*")
        elif level == "#":
            parts.append(".*")
        else:
            parts.append(level.replace(".", r"\."))
    return "^" + "/".join(parts) + "$"


def filter_topics(df: DataFrame, topic_col: str = "topic", topic_filter: str = DEVICE_TOPIC_FILTER) -> DataFrame:
    """Keep messages whose topic matches the filter; add ``topic_site`` and ``topic_device`` (SRC3)."""
    t = F.col(topic_col)
    out = df.filter(t.rlike(topic_regex(topic_filter)))
    return (out.withColumn("topic_site", F.split_part(t, F.lit("/"), F.lit(2)))
               .withColumn("topic_device", F.split_part(t, F.lit("/"), F.lit(3))))


def _kind(v: Column) -> Column:
    return F.schema_of_variant(v)


_NUMBER_KINDS = ("BIGINT", "DOUBLE", "FLOAT", "INT", "SMALLINT", "TINYINT")


def _is_number(kind: Column) -> Column:
    return kind.isin(*_NUMBER_KINDS) | kind.startswith("DECIMAL")


# --- Fixed values: texts that ``float()`` and ISO parsing accept ---------------
NUMBER_TEXT = (r"^\s*[+-]?((\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?|(?i:inf|infinity|nan))\s*$")
ISO_TEXT = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}([.,]\d{1,9})?)?(Z|[+-]\d{2}:\d{2})?)?$"
# ------------------------------------------------------------------------------


def _flag(v: Column) -> Column:
    """1 or 0 of a JSON boolean."""
    return F.try_variant_get(v, "$", "boolean").cast("int")


def _number(v: Column) -> Column:
    """``float(x)``: a JSON number or boolean, or a string holding a number."""
    kind = _kind(v)
    text = F.try_variant_get(v, "$", "string")
    from_str = F.when(text.rlike(NUMBER_TEXT), F.regexp_replace(F.trim(text), "_", "").try_cast("double"))
    return (F.when(kind == "STRING", from_str).when(kind == "BOOLEAN", _flag(v).cast("double"))
            .when(_is_number(kind), F.try_variant_get(v, "$", "double")))


def _string(v: Column) -> Column:
    """A JSON string; JSON null leaves the field at its default."""
    kind = _kind(v)
    return F.when(kind == "STRING", F.try_variant_get(v, "$", "string")).when(kind == "VOID", F.lit(""))


def _ts_millis(v: Column) -> Column:
    """JSON number -> millis truncated toward zero; JSON string -> ISO-8601 (a
    numeric string, a time or a month alone is an error)."""
    kind = _kind(v)
    text = F.try_variant_get(v, "$", "string")
    int_ms = F.try_variant_get(v, "$", "long")
    num = F.try_variant_get(v, "$", "double")
    number_ms = F.coalesce(int_ms, F.when(F.abs(num) < F.lit(9.2e18), num.cast("long")))
    iso_ms = F.when(text.rlike(ISO_TEXT), normalise_ts_millis(F.replace(text, F.lit(","), F.lit("."))))
    return (F.when(kind == "STRING", iso_ms).when(kind == "BOOLEAN", _flag(v).cast("long"))
            .when(_is_number(kind), number_ms))


_PAYLOAD_SCHEMA = ", ".join(f"{k} variant" for k in REQUIRED_KEYS + ["firmware_version"])


def normalise_payload(df: DataFrame, payload_col: str = "payload") -> DataFrame:
    """Parse JSON payloads into reading columns plus ``parse_ok``.

    Each payload is parsed once into a struct of per-key VARIANT values, so the
    JSON type of every key is known. Reading columns are NULL where
    ``parse_ok`` is false. ``ts`` is epoch millis.
    """
    d = df.withColumn("_p", F.from_json(F.col(payload_col), _PAYLOAD_SCHEMA))
    p = lambda k: F.col(f"_p.{k}")
    fields = {
        "device_id": _string(p("device_id")),
        "site_id": _string(p("site_id")),
        "ts": _ts_millis(p("ts")),
        **{k: _number(p(k)) for k in NUMERIC_KEYS},
    }
    fields["firmware_version"] = F.when(p("firmware_version").isNull(), F.lit("")).otherwise(_string(p("firmware_version")))
    d = d.select("*", *[e.alias(f"_f_{k}") for k, e in fields.items()])
    ok = F.lit(True)
    for k in fields:
        ok = ok & F.col(f"_f_{k}").isNotNull()
    d = d.withColumn("parse_ok", ok)
    for k in fields:
        d = d.withColumn(k, F.when(F.col("parse_ok"), F.col(f"_f_{k}")))
    return d.drop("_p", *[f"_f_{k}" for k in fields])


def bridge_counters(normalised: DataFrame) -> DataFrame:
    """Forwarded / error counts of the bridge."""
    return normalised.agg(F.count_if("parse_ok").alias("forwarded"), F.count_if(~F.col("parse_ok")).alias("errors"))
