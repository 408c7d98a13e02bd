"""Rates, cumulative counters, progress rows and lag."""
import json

from quillstream.operators.health import consumer_lag, counter_rate, health_summary, offset_lag, progress_frame, progress_positions, sum_by


def test_every_scrape_of_the_range(spark):
    df = spark.createDataFrame([("a", 1000), ("a", 2000), ("a", 46_000), ("b", 1000)], "s string, ms long")
    rates = counter_rate(df, "s", "ms")
    got = {(r.series, r.scrape_ms): round(r.rate_per_sec * 60) for r in rates.collect()}
    assert got == {("a", 15000): 2, ("a", 30000): 2, ("a", 45000): 2, ("a", 60000): 3, ("a", 75000): 1, ("a", 90000): 1, ("a", 105000): 1,
                   ("b", 15000): 1, ("b", 30000): 1, ("b", 45000): 1, ("b", 60000): 1}
    total = {r.scrape_ms: round(r.rate_per_sec * 60) for r in sum_by(rates).collect()}
    assert total[15000] == 3 and total[60000] == 4


def _report(name, batch, rows, end=None, last=None):
    return json.dumps({"name": name, "batchId": batch, "timestamp": "2024-01-01T00:00:00.000Z", "numInputRows": rows,
                       "observedMetrics": {"quality": {"records_valid": rows, "records_parse_failed": 0, "records_validation_failed": 0}},
                       "sources": [{"endOffset": end, "latestOffset": last}]})


def test_progress_is_summed_over_all_reports(spark):
    rows = health_summary(progress_frame(spark, [_report("q", b, 3) for b in range(150)])).collect()
    assert rows[0].completed_batches == 150 and rows[0].input_rows == rows[0].records_valid == 450


def test_lag_from_offsets(spark):
    reports = [_report("q", 0, 1, {"t": {"0": 1}}, {"t": {"0": 50}}), _report("q", 1, 1, {"t": {"0": 10, "1": 4}}, {"t": {"0": 12, "1": 9, "2": 3}}),
               _report("files", 0, 1, {"logOffset": 3}, None)]
    assert [tuple(r) for r in consumer_lag(spark, reports).collect()] == [("q", "t", 10)]


def test_lag_of_an_offset_source(spark):
    """The newest report with positions counts; a partition that no report names is behind by all its records."""
    reports = [_report("q", 0, 1, json.dumps({"0": 3}), None), _report("q", 1, 1, json.dumps({"0": 10, "1": 4}), None), _report("q", 2, 0, None, None),
               _report("files", 0, 1, {"logOffset": "x"}, None)]
    ends = spark.createDataFrame([(0, 0, 12), (1, 0, 4), (2, 5, 9)], "partition int, first long, end long")
    rows = offset_lag(progress_positions(progress_frame(spark, reports)), ends)
    assert sorted(map(tuple, rows.collect())) == [("q", 0, 10, 12, 2), ("q", 1, 4, 4, 0), ("q", 2, 5, 9, 4)]
