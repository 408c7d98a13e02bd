"""Restarts after failures, and reports that outlive a failed job."""
import datetime as dt
import uuid

import pytest

from quillstream.functions.codec import encode_one
from quillstream.operators.health import ProgressLog, health_summary, stored_progress
from quillstream.schema import LOG_ROW
from quillstream.session import warehouse_root
from quillstream.sources.log import read_log_stream
from quillstream.streaming import jobs
from quillstream.streaming.supervise import run_supervised


def _log(spark, files):
    root = f"{warehouse_root(spark)}/test-supervise-{uuid.uuid4().hex[:8]}"
    for i in range(files):
        rows = []
        for n in range(3):
            fields = dict(device_id="d", site_id="s", ts=1000 * (10 * i + n + 1), temperature_c=20.0, humidity_pct=50.0, pressure_hpa=1000.0, vibration_g=0.1)
            rows.append((b"d", encode_one(fields), "iot.telemetry", 0, 10 * i + n, dt.datetime(2024, 1, 1)))
        spark.createDataFrame(rows, LOG_ROW).coalesce(1).write.parquet(f"{root}/log/f{i:03d}")
    return root


def _job(spark, root, table, trigger=None, name="supervised"):
    source = read_log_stream(spark, f"{root}/log/*", max_files_per_trigger=1)
    return jobs.start_append_job(source, table, f"{root}/dlq", f"{root}/ckpt", trigger=trigger or {"availableNow": True}, name=name)


@pytest.fixture
def crashing(monkeypatch):
    """Commits of the batches in the list fail after the data is written, once per mention."""
    from quillstream.plans.tables import Table

    crashes, real = [], Table.publish

    def publish(self, after, new):
        if new[0][2] in crashes:
            crashes.remove(new[0][2])
            raise RuntimeError("crash between data and commit")
        real(self, after, new)

    monkeypatch.setattr(Table, "publish", publish)
    return crashes


def test_crashes_change_nothing(spark, crashing):
    root = _log(spark, 5)
    table = jobs.telemetry_table(spark, root)
    crashing += [0, 0, 2, 4, 4, 4]
    assert run_supervised(lambda: _job(spark, root, table), pause_s=0) == 6
    assert not crashing and table.read().count() == 15 and table.commits().count() == 5
    assert len({r.part_key for r in table.files().select("part_key").collect()}) == 5


def test_gives_up_after_tolerated_failures(spark, crashing):
    root = _log(spark, 2)
    table = jobs.telemetry_table(spark, root)
    crashing += [1] * 9
    with pytest.raises(Exception, match="crash between"):
        run_supervised(lambda: _job(spark, root, table), pause_s=0)
    assert len(crashing) == 5 and table.read().count() == 3     # the first try and three restarts


def test_processing_time_trigger(spark):
    root = _log(spark, 3)
    table = jobs.telemetry_table(spark, root)
    query = _job(spark, root, table, trigger={"processingTime": "1 second"})
    query.processAllAvailable()
    query.stop()
    assert table.read().count() == 9 and table.commits().count() == 3


def test_reports_of_a_failed_job_stay(spark, crashing):
    root = _log(spark, 4)
    table = jobs.telemetry_table(spark, root)
    crashing.append(2)
    with pytest.raises(Exception, match="crash between"), ProgressLog(spark, "reported", f"{root}/progress"):
        _job(spark, root, table, name="reported").awaitTermination()
    row = health_summary(stored_progress(spark, f"{root}/progress")).first()
    assert (row["query"], row["completed_batches"], row["input_rows"], row["records_valid"]) == ("reported", 2, 6, 6)
    with ProgressLog(spark, "reported", f"{root}/progress", waiting=1):
        _job(spark, root, table, name="reported").awaitTermination()
    row = health_summary(stored_progress(spark, f"{root}/progress")).first()
    assert (row["completed_batches"], row["input_rows"], row["records_valid"]) == (4, 12, 12)
