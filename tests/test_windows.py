"""Watermark / late-data rule: batch operator and the streaming job (with restarts)."""
import datetime as dt
import uuid

from pyspark.sql import functions as F

from quillstream.functions.codec import encode_one
from quillstream.operators.windows import classify_late, windowed_stats
from quillstream.schema import LOG_ROW

# one device; seconds per micro-batch (from the fixture description)
SEQ = [[1.0, 59.999, 64.999], [2.0], [65.0], [3.0], [200.0]]


def test_batch_late_rule(spark):
    rows = [(b, int(s * 1000), "a", 20.0, 50.0, 1000.0) for b, batch in enumerate(SEQ) for s in batch]
    df = spark.createDataFrame(rows, "batch long, ts_ms long, device_id string, temperature_c double, "
                                     "humidity_pct double, pressure_hpa double")
    flagged = classify_late(df, "batch", "ts_ms")
    late = sorted(r.ts_ms for r in flagged.filter("is_late").collect())
    assert late == [3000]
    on_time = flagged.filter(~F.col("is_late")).withColumn("ts", F.timestamp_millis("ts_ms"))
    stats = {r.window_start.replace(tzinfo=None): r.reading_count
             for r in windowed_stats(on_time).collect()}
    counts = sorted(stats.values())
    assert counts == [1, 2, 3]  # [0,60): 1, 59.999, 2 ; [60,120): 64.999, 65 ; [180,240): 200


def _log_row(device, secs, offset, temp=20.0, value=None):
    fields = dict(device_id=device, site_id="s", ts=int(secs * 1000), temperature_c=temp, humidity_pct=50.0,
                  pressure_hpa=1000.0, vibration_g=0.1)
    v = value if value is not None else encode_one(fields)
    return (device.encode(), v, "iot.telemetry", 0, offset,
            dt.datetime.fromtimestamp(secs, dt.timezone.utc).replace(tzinfo=None))


def test_stream_window_with_rejects_and_restarts(spark):
    from quillstream.session import warehouse_root
    from quillstream.streaming import jobs
    from quillstream.sources.log import read_log_stream

    root = f"{warehouse_root(spark)}/test-stream-{uuid.uuid4().hex[:8]}"
    batches = [
        [_log_row("a", 1.0, 0), _log_row("a", 59.999, 1), _log_row("a", 64.999, 2)],
        [_log_row("a", 2.0, 3), _log_row("a", 1.0, 4, value=b"\x01\x02\x03")],      # + undecodable row
        [_log_row("b", 65.0, 5, temp=9999.0)],                                       # rejected, still moves wm
        [_log_row("a", 3.0, 6)],
        [_log_row("a", 200.0, 7)],
    ]
    table = jobs.agg_table(spark, root)
    for i, b in enumerate(batches):          # restart the query after every file (W9)
        spark.createDataFrame(b, LOG_ROW).coalesce(1).write.parquet(f"{root}/log/f{i:03d}")
        source = read_log_stream(spark, f"{root}/log/*", max_files_per_trigger=1)
        q = jobs.start_window_job(source, table, f"{root}/dlq",
                                  f"{root}/ckpt", trigger={"availableNow": True}, name="window")
        q.awaitTermination()
        assert q.exception() is None
    agg = {(r.device_id, r.window_start.second + 60 * r.window_start.minute): r.reading_count
           for r in table.read().collect()}
    assert agg[("a", 0)] == 3
    assert agg[("a", 60)] == 1
    dlq = [r.value for r in jobs.read_dead_letters(spark, f"{root}/dlq").collect()]
    assert sum('"stage":"late"' in v for v in dlq) == 1
    assert any('"event_ts":3000' in v for v in dlq)
    assert sum('"stage":"deserialize"' in v for v in dlq) == 1
    assert sum('"stage":"validate"' in v for v in dlq) == 1
    import json
    lengths = [json.loads(v)["payload_len"] for v in dlq if '"stage":"deserialize"' in v]
    assert lengths == [3]


def _run(spark, start, log, root, name, table, **options):
    from quillstream.sources.log import read_log_stream

    q = start(read_log_stream(spark, f"{root}/{log}/*", **options), table, f"{root}/dlq", f"{root}/ckpt/{name}",
              trigger={"availableNow": True}, name=name)
    q.awaitTermination()
    assert q.exception() is None


def test_full_readings_are_averaged(spark):
    rows = [("a", 1000, 20.004), ("a", 2000, 20.004)]
    df = spark.createDataFrame(rows, "device_id string, ts_ms long, temperature_c double").selectExpr(
        "*", "50.0D AS humidity_pct", "1000.0D AS pressure_hpa", "timestamp_millis(ts_ms) AS ts")
    assert windowed_stats(df).first().avg_temperature_c == 20.004


def test_three_jobs_share_one_dead_letter_sink(spark):
    from quillstream.session import warehouse_root
    from quillstream.streaming import jobs

    root = f"{warehouse_root(spark)}/test-shared-{uuid.uuid4().hex[:8]}"
    rows = [_log_row("a", 1.0, 0), _log_row("a", 2.0, 1, value=b"\x01\x02\x03"), _log_row("a", 3.0, 2, temp=9999.0), _log_row("a", 400.0, 3)]
    spark.createDataFrame(rows, LOG_ROW).coalesce(1).write.parquet(f"{root}/log/f0")
    for name, start, table in (("append", jobs.start_append_job, jobs.telemetry_table), ("upsert", jobs.start_upsert_job, jobs.upsert_table),
                               ("window", jobs.start_window_job, jobs.agg_table)):
        _run(spark, start, "log", root, name, table(spark, root))
    dlq = jobs.read_dead_letters(spark, f"{root}/dlq")
    assert {r.writer: r["count"] for r in dlq.groupBy("writer").count().collect()} == {"append": 2, "upsert": 2, "window": 2}
    assert dlq.filter(F.col("value").contains('"payload_len":3')).count() == 3


def test_busy_device_and_many_rejects(spark):
    """One device in many Arrow chunks; nine records of ten are undecodable."""
    from quillstream.session import warehouse_root
    from quillstream.streaming import jobs

    root = f"{warehouse_root(spark)}/test-busy-{uuid.uuid4().hex[:8]}"
    good = [_log_row("a", 1 + (i % 120), i, temp=20.004) for i in range(300)]
    bad = [_log_row("a", 1 + (i % 120), 300 + i, value=b"\x01\x02\x03\x04") for i in range(2700)]
    spark.createDataFrame(good + bad, LOG_ROW).coalesce(1).write.parquet(f"{root}/log/f0")
    spark.createDataFrame([_log_row("b", 900.0, 9000)], LOG_ROW).coalesce(1).write.parquet(f"{root}/log/f1")
    table = jobs.agg_table(spark, root)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        _run(spark, jobs.start_window_job, "log", root, "window", table, max_files_per_trigger=1)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    got = {r.window_start.minute: (r.reading_count, round(r.avg_temperature_c, 9)) for r in table.read().filter("device_id = 'a'").collect()}
    assert {m: n for m, (n, _) in got.items()} == {0: sum((1 + i % 120) < 60 for i in range(300)), 1: sum(60 <= (1 + i % 120) < 120 for i in range(300)),
                                                   2: sum((1 + i % 120) >= 120 for i in range(300))}
    assert {a for _, a in got.values()} == {20.004}
    assert jobs.read_dead_letters(spark, f"{root}/dlq").count() == 2700


def test_random_batches_equal_a_model(spark):
    """Readings in random order over random micro-batches, against a plain model of the late rule."""
    import random

    from quillstream.plans.stream_queries import write_log_files
    from quillstream.session import warehouse_root
    from quillstream.streaming import jobs

    rng = random.Random(11)
    root = f"{warehouse_root(spark)}/test-random-{uuid.uuid4().hex[:8]}"
    batches, offset = [], 0
    for b in range(6):
        batch = []
        for _ in range(rng.randint(1, 25)):
            batch.append((rng.choice("abc"), max(1.0, 40.0 * b + rng.uniform(-150, 60)), offset))
            offset += 1
        batches.append(batch)
    rows = [(*_log_row(d, s, o), b) for b, batch in enumerate(batches) for d, s, o in batch]
    from pyspark.sql import types as T
    log = spark.createDataFrame(rows, T.StructType([*LOG_ROW.fields, T.StructField("_batch", T.LongType())]))
    assert write_log_files(log, "_batch", f"{root}/log") == 6
    table = jobs.agg_table(spark, root)
    _run(spark, jobs.start_window_job, "log", root, "window", table, max_files_per_trigger=1)

    seen, late, counts = 0, [], {}
    for batch in batches:
        wm = seen - 5000
        for d, s, _ in batch:
            ms = int(s * 1000)
            if ms // 60000 * 60000 + 60000 <= wm:
                late.append((d, ms))
            else:
                counts[d, ms // 60000] = counts.get((d, ms // 60000), 0) + 1
        seen = max([seen, *(int(s * 1000) for _, s, _ in batch)])
    closed = {k: n for k, n in counts.items() if (k[1] + 1) * 60000 <= seen - 5000}
    got = {(r.device_id, int(r.m)): r.reading_count for r in table.read().selectExpr("*", "unix_millis(window_start) div 60000 AS m").collect()}
    assert got == closed
    import json
    dlq = [json.loads(r.value) for r in jobs.read_dead_letters(spark, f"{root}/dlq").collect()]
    assert sorted((x["device_id"], x["event_ts"]) for x in dlq) == sorted(late)
