"""Gate, router and envelope cases (the reference's unit cases, as DataFrame tests)."""
import json
import math

import pytest
from pyspark.sql import functions as F

from quillstream.functions import envelope
from quillstream.functions.quality import classify, reject_field, reject_reason
from quillstream.schema import READING

BASE = dict(device_id="sensor-1", site_id="site-a", ts=1700000000000, temperature_c=22.5, humidity_pct=55.0,
            pressure_hpa=1013.25, vibration_g=0.1, firmware_version="")


def _reason(spark, **over):
    r = {**BASE, **over}
    df = spark.createDataFrame([tuple(r[f.name] for f in READING.fields)], READING)
    return df.select(reject_reason().alias("r"), reject_field().alias("f")).first()


def test_plausible_reading_accepted(spark):
    assert _reason(spark).r is None


def test_bounds_are_inclusive(spark):
    assert _reason(spark, temperature_c=150.0, humidity_pct=100.0, pressure_hpa=800.0, vibration_g=0.0).r is None
    assert _reason(spark, temperature_c=-60.0, humidity_pct=0.0, pressure_hpa=1100.0, vibration_g=50.0).r is None


def test_out_of_range_temperature(spark):
    r = _reason(spark, temperature_c=9000.0)
    assert r.r == "temperature_c out of range [-60.0, 150.0]: 9000.0" and r.f == "temperature_c"


def test_out_of_range_humidity(spark):
    assert _reason(spark, humidity_pct=250.0).r.startswith("humidity_pct out of range")


def test_not_finite(spark):
    assert _reason(spark, pressure_hpa=float("nan")).r == "pressure_hpa not finite: NaN"
    assert _reason(spark, vibration_g=math.inf).r == "vibration_g not finite: Infinity"


def test_empty_device_and_non_positive_ts(spark):
    assert _reason(spark, device_id="").r == "empty device_id"
    assert _reason(spark, ts=0).r == "non-positive ts: 0"


def test_added_cases(spark):
    assert _reason(spark, humidity_pct=-0.0).r is None          # -0.0 passes as in Java
    assert _reason(spark, pressure_hpa=0.0).r.startswith("pressure_hpa out of range")  # unset pressure
    assert _reason(spark, temperature_c=1.0e7).r.endswith(": 1.0E7")
    assert _reason(spark, ts=2**63 - 1).f == "ts"                # overflow guard, no crash


def test_router_stages(spark):
    rows = [({**BASE}, True, None), ({**BASE, "temperature_c": 9000.0}, True, None), (None, False, "bad magic byte")]
    data = [(*(tuple(r[f.name] for f in READING.fields) if r else (None,) * 8), ok, err) for r, ok, err in rows]
    df = spark.createDataFrame(data, READING.simpleString()[7:-1] + ",decoded boolean,decode_error string")
    out = classify(df, decoded_col="decoded").select("stage", "reject_reason").collect()
    assert out[0].stage is None
    assert out[1].stage == "validate" and "temperature_c" in out[1].reject_reason
    assert out[2].stage == "deserialize" and out[2].reject_reason == "bad magic byte"


@pytest.mark.parametrize("payload,expected", [(bytes([1, 2, 3]), 3), (None, 0)])
def test_parse_failure_envelope(spark, payload, expected):
    df = spark.createDataFrame([(payload,)], "p binary")
    v = json.loads(df.select(envelope.parse_failure(F.lit("boom"), F.octet_length("p"))).first()[0])
    assert v == {"stage": "deserialize", "reason": "boom", "payload_len": expected}


def test_validation_and_late_envelopes(spark):
    df = spark.createDataFrame([("sensor-3", 1700000000000, 'bad "quote"\nline')], "d string, t long, r string")
    val = json.loads(df.select(envelope.validation_failure("r", "d")).first()[0])
    assert list(val) == ["stage", "device_id", "reason"] and val["reason"] == 'bad "quote"\nline'
    late = df.select(envelope.late_event("d", "t")).first()[0]
    assert late == '{"stage":"late","device_id":"sensor-3","event_ts":1700000000000}'


def test_null_reason_kept(spark):
    df = spark.createDataFrame([(None,)], "p binary")
    v = json.loads(df.select(envelope.parse_failure(F.lit(None).cast("string"), F.octet_length("p"))).first()[0])
    assert v["reason"] is None and "reason" in v


def test_gate_and_reason_agree_on_any_values(spark):
    """``plausible`` is true exactly where there is no reason, a missing value in any field included."""
    from quillstream.functions.quality import plausible, reason_field

    odd = {"device_id": [None, ""], "ts": [None, 0, -1, 2**63 - 1]}
    odd |= {m: [None, math.nan, math.inf, -math.inf, 1e9, -1e9] for m in ("temperature_c", "humidity_pct", "pressure_hpa", "vibration_g")}
    rows = [tuple({**BASE, f: v}[x.name] for x in READING.fields) for f, values in odd.items() for v in values] + [tuple(BASE[x.name] for x in READING.fields)]
    r, f = reject_reason(), reject_field()
    got = spark.createDataFrame(rows, READING).select(plausible().alias("ok"), r.alias("r"), f.alias("f"), reason_field(r).alias("again")).collect()
    assert all(x.ok == (x.r is None) == (x.f is None) and x.again == x.f for x in got)
    assert [x.ok for x in got].count(True) == 1 and _reason(spark, pressure_hpa=None).r == "pressure_hpa not finite: null"
    assert _reason(spark, ts=None).r == "non-positive ts: null"
