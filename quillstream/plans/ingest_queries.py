"""Registered queries for the ingest side: wire codec, bridge JSON, topics,
upsert and corrections. Inputs are derived from ``events`` by fixed rules
(see ``sources.events``); the SQL oracle applies the same rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.quality import REASON_TOO_SHORT, classify
from ..operators import route
from ..operators.upsert import latest_by_key, make_corrections
from ..sources.bridge import bridge_counters, filter_topics, normalise_payload
from ..sources.events import CORRECTIONS, telemetry_view
from ..sources.log import decode_and_classify, replay_first, to_log_rows
from .queries import register

# --- Fixed values: which derived records are damaged, and how ----------------
CORRUPT_RULES = """
CASE WHEN offset % 73 = 0 THEN NULL
     WHEN offset % 79 = 0 THEN unhex('000000000180')
     WHEN offset % 83 = 0 THEN unhex('000000000100FFFF')
     WHEN offset % 89 = 0 THEN substring(value, 1, 5)
     ELSE value END"""
# ------------------------------------------------------------------------------


def wire_log(spark, sf_dir) -> DataFrame:
    """Binary log rows encoded from the readings, with some damaged values."""
    log = to_log_rows(telemetry_view(spark, sf_dir))
    return log.withColumn("value", F.expr(CORRUPT_RULES))


@register("decode_wire")
def q_decode_wire(spark, sf_dir):
    """Never-fail decode of the wire log + gate: every record routed."""
    d = decode_and_classify(wire_log(spark, sf_dir))
    err = F.col("decode_error")
    reason = (F.when(F.col("stage") == "validate", F.col("reject_reason"))
               .when(F.col("stage") == "deserialize",
                     F.when(err.isNull(), F.lit("null")).when(err == REASON_TOO_SHORT, err)
                      .otherwise(F.lit("corrupt"))))
    return d.select(
        F.col("offset").alias("seq"),
        F.coalesce(F.col("stage"), F.lit("table")).alias("route"),
        reason.alias("reason"),
        F.when(F.col("stage") == "deserialize", F.col("payload_len")).alias("payload_len"),
        "device_id", F.col("ts").alias("ts_ms"), "temperature_c", "humidity_pct", "pressure_hpa",
        "vibration_g", F.nullif(F.col("firmware_version"), F.lit("")).alias("firmware_version"))


@register("wire_counters")
def q_wire_counters(spark, sf_dir):
    """Router quality counters over the decoded wire log."""
    return route.quality_counters(decode_and_classify(wire_log(spark, sf_dir)))


@register("encode_roundtrip")
def q_encode_roundtrip(spark, sf_dir):
    """Encode (D2) then decode (D1): rebuilt readings must equal the source."""
    d = decode_and_classify(to_log_rows(telemetry_view(spark, sf_dir)))
    return d.select(F.col("offset").alias("seq"), "decoded", "device_id", "site_id", F.col("ts").alias("ts_ms"),
                    "temperature_c", "humidity_pct", "pressure_hpa", "vibration_g",
                    F.nullif(F.col("firmware_version"), F.lit("")).alias("firmware_version"))


# --- bridge payloads -----------------------------------------------------------

def bridge_payloads(spark, sf_dir) -> DataFrame:
    """Device JSON messages derived from the readings: ts as a number or an
    ISO string (UTC or +02:00), some numeric strings and booleans, optional
    firmware, some broken or incomplete payloads, times and months for dates,
    numbers for firmware; topic per device with some foreign topics."""
    tv = telemetry_view(spark, sf_dir)
    iso_utc = F.date_format(F.timestamp_millis("ts_ms"), "yyyy-MM-dd'T'HH:mm:ss.SSSXXX")
    iso_plus2 = F.concat(F.date_format(F.timestamp_millis(F.col("ts_ms") + 7200000), "yyyy-MM-dd'T'HH:mm:ss.SSS"),
                         F.lit("+02:00"))
    # JSON types per key are chosen through VARIANT values.
    ts_v = (F.when(F.col("seq") % 107 == 2, F.lit("12:30").cast("variant"))
             .when(F.col("seq") % 109 == 2, F.lit("2024-01").cast("variant"))
             .when(F.col("seq") % 3 == 0, F.col("ts_ms").cast("variant"))
             .when(F.col("seq") % 3 == 1, iso_utc.cast("variant"))
             .otherwise(iso_plus2.cast("variant")))
    temp_v = F.when(F.col("seq") % 113 == 2, F.lit("1d").cast("variant")).when(F.col("seq") % 127 == 2, F.lit(True).cast("variant")).when(
        F.col("seq") % 7 == 0, F.col("temperature_c").cast("string").cast("variant")).otherwise(
        F.col("temperature_c").cast("variant"))
    firmware_v = F.when(F.col("seq") % 131 == 2, F.lit(2).cast("variant")).otherwise(F.col("firmware_version").cast("variant"))
    hum = F.when(F.col("seq") % 103 != 1, F.col("humidity_pct"))
    js = F.to_json(F.struct(
        F.col("device_id"), F.col("site_id"), ts_v.alias("ts"), temp_v.alias("temperature_c"),
        hum.alias("humidity_pct"), F.col("pressure_hpa"), F.col("vibration_g"), firmware_v.alias("firmware_version")))
    js = F.when(F.col("seq") % 101 == 0, F.substring(js, 1, 40)).otherwise(js)
    topic = (F.when(F.col("seq") % 17 == 0, F.concat_ws("/", F.lit("sensors"), "site_id", "device_id", F.lit("status")))
              .when(F.col("seq") % 19 == 0, F.concat_ws("/", F.lit("sensors"), "site_id", F.lit("telemetry")))
              .when(F.col("seq") % 23 == 0,
                    F.concat_ws("/", F.lit("sensors"), "site_id", "device_id", F.lit("x"), F.lit("telemetry")))
              .otherwise(F.concat_ws("/", F.lit("sensors"), "site_id", "device_id", F.lit("telemetry"))))
    return tv.select("seq", topic.alias("topic"), js.alias("payload"))


@register("json_normalise")
def q_json_normalise(spark, sf_dir):
    """JSON payload -> canonical reading, errors flagged (SRC2, J1-J3)."""
    n = normalise_payload(bridge_payloads(spark, sf_dir))
    return n.select("seq", "parse_ok", "device_id", "site_id", F.col("ts").alias("ts_ms"), "temperature_c",
                    "humidity_pct", "pressure_hpa", "vibration_g", "firmware_version")


@register("bridge_counts")
def q_bridge_counts(spark, sf_dir):
    """Forwarded and error counts of the bridge."""
    return bridge_counters(normalise_payload(bridge_payloads(spark, sf_dir)))


@register("topic_filter")
def q_topic_filter(spark, sf_dir):
    """Messages on ``sensors/+/+/telemetry`` with site and device from the topic (SRC3)."""
    t = filter_topics(bridge_payloads(spark, sf_dir))
    return t.select("seq", "topic_site", "topic_device")


# --- upsert and corrections ------------------------------------------------------

def correction_records(spark, sf_dir) -> DataFrame:
    """Re-emitted readings: the first records of the log, temperature +2.0,
    firmware omitted, appended after all originals (T6, F6)."""
    return make_corrections(telemetry_view(spark, sf_dir), CORRECTIONS)


def upsert_input(spark, sf_dir) -> DataFrame:
    tv = telemetry_view(spark, sf_dir)
    both = tv.withColumn("corrected", F.lit(False)).unionByName(
        correction_records(spark, sf_dir).withColumn("corrected", F.lit(True)))
    return route.valid_rows(classify(both, ts_col="ts_ms"))


@register("corrections")
def q_corrections(spark, sf_dir):
    """The correction records as emitted."""
    c = correction_records(spark, sf_dir)
    return c.select("seq", "offset", "device_id", "ts_ms", "temperature_c", "firmware_version")


@register("upsert_current")
def q_upsert_current(spark, sf_dir):
    """Current state of the upsert table: latest record per (device_id, ts)."""
    cur = latest_by_key(upsert_input(spark, sf_dir), key=("device_id", "ts_ms"), order_col="offset")
    return cur.select("device_id", "site_id", "ts_ms", "temperature_c", "humidity_pct", "pressure_hpa",
                      "vibration_g", "firmware_version", "offset")


@register("upsert_summary")
def q_upsert_summary(spark, sf_dir):
    """Rows in, rows kept, corrected rows and NULL-firmware rows after the upsert."""
    inp = upsert_input(spark, sf_dir)
    cur = latest_by_key(inp, key=("device_id", "ts_ms"), order_col="offset")
    return cur.agg(F.count(F.lit(1)).alias("current_rows"),
                   F.count_if("corrected").alias("corrected_rows"),
                   F.count_if(F.col("firmware_version").isNull()).alias("null_firmware_rows"))


@register("replay_first_10")
def q_replay_first_10(spark, sf_dir):
    """Bounded replay: the first 10 log records from earliest (SRC4)."""
    tv = telemetry_view(spark, sf_dir)
    return replay_first(tv.select("partition", "offset", "device_id", "ts_ms"), 10)
