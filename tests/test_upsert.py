"""Keyed upsert and corrections."""
from pyspark.sql import functions as F

from quillstream.operators.upsert import latest_by_key, make_corrections


def _log(spark, shift=0):
    rows = [(0, shift + i, "d", i % 4, float(i), "1.0") for i in range(8)]
    return spark.createDataFrame(rows, "partition int, offset long, device_id string, ts long, temperature_c double, firmware_version string")


def test_corrections_follow_the_whole_log(spark):
    for shift in (0, 5_000_000):
        log = _log(spark, shift)
        fixed = make_corrections(log, 3)
        assert [r.offset - shift for r in fixed.orderBy("offset").collect()] == [8 + shift, 9 + shift, 10 + shift]
        current = latest_by_key(log.unionByName(fixed), key=("device_id", "ts"))
        got = {r.ts: (r.temperature_c, r.firmware_version) for r in current.collect()}
        assert got == {0: (2.0, None), 1: (3.0, None), 2: (4.0, None), 3: (7.0, "1.0")}


def test_more_corrections_than_records(spark):
    assert make_corrections(_log(spark), 100).agg(F.count("*")).first()[0] == 8


def test_merge_reads_and_writes_touched_days_only(spark):
    import datetime as dt
    import uuid

    from quillstream.plans.merged import current, merge_batch
    from quillstream.plans.tables import Table
    from quillstream.schema import UPSERT_TABLE
    from quillstream.session import warehouse_root

    t = Table(spark, "u", UPSERT_TABLE, "ts", root=f"{warehouse_root(spark)}/test-merge-{uuid.uuid4().hex[:8]}")
    day = lambda d, off, temp: ("d", "s", dt.datetime(2024, 1, d), temp, 50.0, 1000.0, 0.1, None, 0, off)
    batches = [[day(1, 0, 1.0), day(2, 1, 2.0)], [day(2, 2, 20.0), day(3, 3, 3.0)], [day(2, 1, 99.0)]]
    for n, rows in enumerate(batches):
        assert merge_batch(t, spark.createDataFrame(rows, UPSERT_TABLE), n)
    assert not merge_batch(t, spark.createDataFrame(batches[0], UPSERT_TABLE), 0)  # again: nothing changes
    assert {r.ts.day: r.temperature_c for r in current(t).collect()} == {1: 1.0, 2: 20.0, 3: 3.0}
    parts = {(r.day.day, r.part_key[-1]) for r in t.files().selectExpr("ts_day AS day", "part_key").distinct().collect()}
    assert parts == {(1, "0"), (2, "0"), (2, "1"), (3, "1"), (2, "2")}
    only = current(t).filter(F.col("ts_day").isin([dt.date(2024, 1, 3)]))
    assert "ts_day" in [x for x in only._jdf.queryExecution().executedPlan().toString().splitlines() if "PartitionFilters" in x][0]


def _merged_table(spark):
    import uuid

    from quillstream.plans.tables import Table
    from quillstream.schema import UPSERT_TABLE
    from quillstream.session import warehouse_root

    return Table(spark, "u", UPSERT_TABLE, "ts", root=f"{warehouse_root(spark)}/test-merge-{uuid.uuid4().hex[:8]}")


def _reading(device, off, temp):
    import datetime as dt

    return (device, "s", dt.datetime(2024, 1, 1), temp, 50.0, 1000.0, 0.1, None, 0, off)


def test_any_writer_names_and_a_new_checkpoint(spark):
    """What counts is the newest commit, however the writers are called; batches of a new name start at zero."""
    from quillstream.plans.merged import current, merge_batch
    from quillstream.schema import UPSERT_TABLE

    t = _merged_table(spark)
    for n, (writer, batch) in enumerate([("z", 0), ("merge", 0), ("append2", 0), ("append2", 1), ("a", 0)]):
        assert merge_batch(t, spark.createDataFrame([_reading(f"d{n}", n, float(n))], UPSERT_TABLE), batch, writer=writer)
    assert {r.device_id: r.temperature_c for r in current(t).collect()} == {f"d{n}": float(n) for n in range(5)}
    assert current(t, as_of=1).count() == 2


def test_two_mergers_lose_nothing(spark, monkeypatch):
    """A merge that is committed between another's read and its commit is merged into."""
    from quillstream.plans import merged
    from quillstream.schema import UPSERT_TABLE

    t = _merged_table(spark)
    frame = lambda *rows: spark.createDataFrame(list(rows), UPSERT_TABLE)
    merged.merge_batch(t, frame(_reading("a", 0, 1.0)), 0, writer="one")
    real, other = merged.latest_by_key, []

    def interrupted(df, **options):
        if not other:
            other.append(True)
            assert merged.merge_batch(t, frame(_reading("b", 1, 2.0), _reading("a", 3, 4.0)), 0, writer="two")
        return real(df, **options)

    monkeypatch.setattr(merged, "latest_by_key", interrupted)
    assert merged.merge_batch(t, frame(_reading("c", 2, 3.0), _reading("a", 1, 9.0)), 1, writer="one")
    assert {r.device_id: r.temperature_c for r in merged.current(t).collect()} == {"a": 4.0, "b": 2.0, "c": 3.0}


def test_job_with_a_new_checkpoint_goes_on(spark):
    """The upsert job from a new checkpoint, under a new name: its first batch is merged, too."""
    import datetime as dt

    from quillstream.functions.codec import encode_one
    from quillstream.plans.merged import current
    from quillstream.schema import LOG_ROW
    from quillstream.sources.log import read_log_stream
    from quillstream.streaming import jobs

    state = _merged_table(spark)
    changes = jobs.upsert_table(spark, state.root)
    for n, name in enumerate(("upsert", "upsert_again")):
        value = encode_one(dict(device_id=f"d{n}", site_id="s", ts=1000, temperature_c=20.0, humidity_pct=50.0, pressure_hpa=1000.0, vibration_g=0.1))
        row = (b"d", value, "iot.telemetry", 0, n, dt.datetime(2024, 1, 1))
        spark.createDataFrame([row], LOG_ROW).write.parquet(f"{state.root}/log{n}/f")
        q = jobs.start_upsert_job(read_log_stream(spark, f"{state.root}/log{n}/*"), changes, f"{state.root}/dlq", f"{state.root}/ckpt{n}",
                                  trigger={"availableNow": True}, name=name, merged=state)
        q.awaitTermination()
        assert q.exception() is None
    assert sorted(r.device_id for r in current(state).collect()) == ["d0", "d1"]
