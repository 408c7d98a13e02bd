"""Tables with a commit log: replay-safe commits, conflicts, time travel, rewrites."""
import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from quillstream.functions.timefn import ts_between
from quillstream.plans.tables import CommitConflict, Table, days_between, list_tables, previous_snapshot
from quillstream.schema import TELEMETRY_TABLE
from quillstream.session import warehouse_root


def _rows(spark, n, start_s=0):
    base = dt.datetime(2024, 1, 1)
    data = [("d", "s", base + dt.timedelta(hours=(start_s + i) * 5), 20.0, 50.0, 1000.0, 0.1, None)
            for i in range(n)]
    return spark.createDataFrame(data, TELEMETRY_TABLE)


def _root(spark):
    return f"{warehouse_root(spark)}/test-tables-{uuid.uuid4().hex[:8]}"


def _table(spark):
    return Table(spark, "telemetry", TELEMETRY_TABLE, "ts", root=_root(spark)).create_if_absent()


def test_replayed_batch_is_not_duplicated(spark):
    t = _table(spark)
    assert t.read().count() == 0
    assert t.commit_batch(_rows(spark, 10), "w", 1)
    assert not t.commit_batch(_rows(spark, 10), "w", 1)     # same batch again
    assert t.commit_batch(_rows(spark, 5, 100), "w", 2)
    assert t.commit_batch(_rows(spark, 0), "w", 3)          # an empty batch is a commit too
    assert t.read().count() == 15
    h = t.history().orderBy("commit_id").collect()
    assert [r.total_records for r in h] == [10, 15, 15]


def test_time_travel(spark):
    t = _table(spark)
    t.commit_batch(_rows(spark, 4), "w", 0)
    t.commit_batch(_rows(spark, 6, 10), "w", 1)
    t.commit_batch(_rows(spark, 3, 30), "w", 2)
    assert [t.read(as_of=i).count() for i in range(3)] == [4, 10, 13]
    assert {r.commit_id for r in t.history().collect()} == {0, 1, 2}


def test_two_handles_see_each_others_commits(spark):
    a = _table(spark)
    b = Table(spark, "telemetry", TELEMETRY_TABLE, "ts", root=a.root)
    a.commit_batch(_rows(spark, 3), "a", 0)
    b.commit_batch(_rows(spark, 4, 10), "b", 0)
    a.commit_batch(_rows(spark, 5, 20), "a", 1)
    assert a.read().count() == b.read().count() == 12
    assert [r.total_records for r in a.history().orderBy("commit_id").collect()] == [3, 7, 12]


def test_stale_writer_raises(spark):
    a = _table(spark)
    b = Table(spark, "telemetry", TELEMETRY_TABLE, "ts", root=a.root)
    stale = a.head()
    b.commit_batch(_rows(spark, 4), "b", 0)
    with pytest.raises(CommitConflict):
        a.publish(stale, [(0, "a", 0, "a-000000000000", 1)])
    assert a.read().count() == 4 and a.commits().count() == 1


def test_uncommitted_files_are_not_read(spark):
    t = _table(spark)
    t.commit_batch(_rows(spark, 3), "w", 0)
    t.write_parts(t.with_day(_rows(spark, 2, 40)).withColumn("part_key", F.lit("crashed-1")))
    assert t.read().count() == 3
    assert {r.part_key for r in t.orphans().collect()} == {"crashed-1"}


def test_previous_snapshot_needs_two(spark):
    t = _table(spark)
    t.commit_batch(_rows(spark, 3), "w", 0)
    with pytest.raises(ValueError, match="no earlier snapshot"):
        previous_snapshot(t.commits())
    t.commit_batch(_rows(spark, 3, 9), "w", 1)
    assert previous_snapshot(t.commits()).count() == 1


def test_backfill_skips_committed_batches(spark):
    t = _table(spark)
    rows = _rows(spark, 12).withColumn("b", F.floor(F.hour("ts") / 12).cast("long"))
    t.append_batches(rows.filter("b = 0"), "b", writer="fill")
    t.append_batches(rows, "b", writer="fill")
    t.append_batches(rows, "b", writer="fill")
    assert t.read().count() == 12 and t.commits().count() == 2


def test_rewrite_keeps_rows_with_fewer_files(spark):
    t = _table(spark)
    for b in range(4):
        t.commit_batch(_rows(spark, 6, b * 6).repartition(3), "w", b)
    new = t.rewritten(_root(spark))
    drop = ("part_key",)
    assert sorted(map(tuple, new.read().drop(*drop).collect())) == sorted(map(tuple, t.read().drop(*drop).collect()))
    assert new.file_stats().count() < t.file_stats().count()
    t.commit_batch(_rows(spark, 2, 50), "w", 9)              # the source goes on as before
    assert t.read().count() == 26 and new.read().count() == 24


def test_time_range_prunes_in_the_scan(spark):
    t = _table(spark)
    t.commit_batch(_rows(spark, 20), "w", 0)
    df = ts_between(t.read(), "2024-01-02 00:00:00", "2024-01-03 00:00:00", "ts", t.day_col)
    plan = df._jdf.queryExecution().executedPlan().toString()
    filters = [line for line in plan.splitlines() if "PartitionFilters" in line]
    assert any("ts_day" in line for line in filters)
    assert df.count() == 5


def test_commits_cost_the_same_however_long_the_log(spark, monkeypatch):
    """A commit opens a few files of the log, not all of them."""
    from quillstream.plans import tables

    t = _table(spark)
    for b in range(12):
        assert t.commit_batch(_rows(spark, 1, b), "w", b)
    opened = []
    real = tables.read_file
    monkeypatch.setattr(tables, "read_file", lambda s, p: opened.append(p) or real(s, p))
    assert t.commit_batch(_rows(spark, 1, 50), "w", 12) and not t.commit_batch(_rows(spark, 1, 50), "w", 12)
    assert len(opened) <= 12 and t.history().count() == 13


def test_lost_or_broken_notes_change_nothing(spark):
    t = _table(spark)
    for b in range(3):
        t.commit_batch(_rows(spark, 2, b * 9), "a/b w", b)
    from quillstream.plans.tables import replace_file

    replace_file(spark, f"{t.path}/_notes/head", "{half")
    replace_file(spark, f"{t.path}/_notes/writer-a%2Fb%20w", "")
    assert t.head() == (2, 6) and t.committed("a/b w", 2) and not t.committed("a/b w", 3) and not t.committed("other", 0)


def test_rewrite_counts_once(spark):
    t = _table(spark)
    t.commit_batch(_rows(spark, 40), "w", 0)
    assert t.rewritten(_root(spark)).head() == (0, 40)


def test_days_that_are_read_are_the_only_ones_listed(spark):
    t = _table(spark)
    t.commit_batch(_rows(spark, 20), "w", 0)                 # five days
    days = days_between("2024-01-02 22:00:00", "2024-01-03 04:00:00")
    assert days == ["2024-01-02", "2024-01-03"]
    some = t.read(days=days)
    places = [x for x in some._jdf.queryExecution().executedPlan().toString().splitlines() if "InMemoryFileIndex" in x and "ts_day" in x]
    assert places and "2 paths" in places[0] and "2024-01-01" not in places[0]
    assert sorted({str(r.ts_day) for r in some.collect()}) == days
    assert some.schema == t.read().schema and t.read(days=["2030-01-01"]).count() == 0
    assert t.read(days=days).count() == t.read().filter(F.col("ts_day").isin(days)).count()


def test_counts_come_from_footers(spark):
    t = _table(spark)
    for b in range(3):
        t.commit_batch(_rows(spark, 7, b * 11).repartition(2), "w", b)
    t.write_parts(t.with_day(_rows(spark, 2, 40)).withColumn("part_key", F.lit("crashed-1")))
    counts = t.part_counts()
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)]" in plan and "temperature_c" not in plan
    want = t.read().groupBy(t.day_col, "part_key").count()
    assert sorted(map(tuple, counts.select("day", "part_key", "records").collect())) == sorted(map(tuple, want.collect()))
    assert t.part_counts(as_of=0).agg(F.sum("records")).first()[0] == 7


def test_list_tables(spark):
    t = _table(spark)
    Table(spark, "telemetry_upsert", TELEMETRY_TABLE, "ts", root=t.root).create_if_absent()
    assert [r.tableName for r in list_tables(spark, t.root).collect()] == ["telemetry", "telemetry_upsert"]
