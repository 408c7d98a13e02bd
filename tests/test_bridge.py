"""Bridge JSON normaliser and topic filter edge cases."""
from quillstream.sources.bridge import filter_topics, normalise_payload, topic_regex

OK = '"device_id":"d","site_id":"s","humidity_pct":50,"pressure_hpa":1000,"vibration_g":0.1'


def _norm(spark, payloads):
    df = spark.createDataFrame([(p,) for p in payloads], "payload string")
    return normalise_payload(df).collect()


def test_types_and_defaults(spark):
    rows = _norm(spark, [
        '{%s,"ts":1704067200123.9,"temperature_c":"22.5"}' % OK,          # float ms truncated, numeric string
        '{%s,"ts":"2024-01-01T02:00:00.500+02:00","temperature_c":21}' % OK,  # ISO with offset
        '{%s,"ts":"1704067200000","temperature_c":21}' % OK,              # quoted number: ISO error
        '{%s,"ts":1,"temperature_c":"x"}' % OK,                            # bad number
        '{"device_id":"d","ts":1,"temperature_c":1}',                      # missing keys
        '{not json',
        '{%s,"ts":5,"temperature_c":1,"firmware_version":"2.0"}' % OK,
    ])
    assert rows[0].parse_ok and rows[0].ts == 1704067200123 and rows[0].temperature_c == 22.5
    assert rows[0].firmware_version == ""
    assert rows[1].parse_ok and rows[1].ts == 1704067200500
    assert [r.parse_ok for r in rows[2:6]] == [False, False, False, False]
    assert rows[6].firmware_version == "2.0"


def test_topic_filter(spark):
    assert topic_regex("sensors/+/+/telemetry") == "^sensors/[^/]*/[^/]*/telemetry$"
    df = spark.createDataFrame([("sensors/a/b/telemetry",), ("sensors/a/telemetry",), ("sensors/a/b/c/telemetry",),
                                ("sensors/a/b/status",)], "topic string")
    got = [(r.topic_site, r.topic_device) for r in filter_topics(df).collect()]
    assert got == [("a", "b")]


def test_as_strict_as_the_bridge(spark):
    bad = ['{%s,"ts":"12:30","temperature_c":1}' % OK, '{%s,"ts":"2024-01","temperature_c":1}' % OK,
           '{%s,"ts":1,"temperature_c":"1d"}' % OK, '{%s,"ts":1,"temperature_c":1,"firmware_version":2}' % OK,
           '{%s,"ts":1,"temperature_c":1,"firmware_version":true}' % OK, '{%s,"ts":null,"temperature_c":1}' % OK,
           '{%s,"ts":1,"temperature_c":null}' % OK, '{%s,"ts":"2024-01-01T10","temperature_c":""}' % OK]
    assert not any(r.parse_ok for r in _norm(spark, bad))
    good = _norm(spark, ['{%s,"ts":"2024-01-01","temperature_c":true}' % OK, '{%s,"ts":true,"temperature_c":" 1_0.5e1 "}' % OK,
                         '{%s,"ts":1,"temperature_c":1,"firmware_version":null}' % OK, '{%s,"ts":"2024-01-01 00:00Z","temperature_c":"-.5"}' % OK])
    assert [r.parse_ok for r in good] == [True] * 4
    assert [r.temperature_c for r in good] == [1.0, 105.0, 1.0, -0.5]
    assert [r.ts for r in good] == [1704067200000, 1, 1, 1704067200000] and good[2].firmware_version == ""
