"""Segment log source: positions, limits, restarts, lag; reconciliation by offsets."""
import json
import random
import uuid

import pytest
from pyspark.sql import functions as F

from quillstream.operators.reconcile import reconcile_offsets
from quillstream.schema import LOG_ROW
from quillstream.session import warehouse_root
from quillstream.sources.offset_log import OffsetLogReader, log_ends, read_offset_stream, read_segments, write_segments


def _log(spark, low, high, partitions=(0, 1)):
    rows = spark.range(low, high).select(F.explode(F.array(*[F.lit(p) for p in partitions])).alias("partition"), F.col("id").alias("offset"))
    return rows.select(F.lit(b"k").alias("key"), F.col("offset").cast("string").cast("binary").alias("value"), F.lit("t").alias("topic"),
                       F.col("partition").cast("int").alias("partition"), "offset", F.timestamp_millis(F.col("offset") * 1000).alias("timestamp"))


def _root(spark):
    return f"{warehouse_root(spark)}/test-offsets-{uuid.uuid4().hex[:8]}"


def _drain(spark, root, name, limit=None):
    """One run over what there is; rows of each micro-batch as (partition, first, last, count)."""
    seen = []

    def sink(batch, batch_id):
        seen.append((batch_id, sorted(map(tuple, batch.groupBy("partition").agg(F.min("offset"), F.max("offset"), F.count("*")).collect()))))

    stream = read_offset_stream(spark, f"{root}/log", limit, f"{root}/positions.json" if limit else None)
    q = stream.writeStream.queryName(name).option("checkpointLocation", f"{root}/ckpt").foreachBatch(sink).trigger(availableNow=True).start()
    q.awaitTermination()
    assert q.exception() is None
    return seen


def test_restarts_resume_at_the_position(spark):
    root = _root(spark)
    write_segments(_log(spark, 0, 100), f"{root}/log", segment=32)
    assert _drain(spark, root, "resume", 40) == [(0, [(0, 0, 39, 40), (1, 0, 39, 40)])]
    assert _drain(spark, root, "resume", 40) == [(1, [(0, 40, 79, 40), (1, 40, 79, 40)])]
    write_segments(_log(spark, 100, 130, (1, 2)), f"{root}/log", segment=32)          # more records, and a new log partition
    assert _drain(spark, root, "resume", 40) == [(2, [(0, 80, 99, 20), (1, 80, 119, 40), (2, 100, 129, 30)])]
    assert _drain(spark, root, "resume") == [(3, [(1, 120, 129, 10)])]
    assert _drain(spark, root, "resume") == []


def test_failed_batch_is_read_again(spark):
    """A batch that was planned and failed is planned again at the same offsets, limit or not."""
    root = _root(spark)
    write_segments(_log(spark, 0, 50, (0,)), f"{root}/log", segment=16)

    def broken(batch, batch_id):
        raise RuntimeError("crash between reading and commit")

    stream = read_offset_stream(spark, f"{root}/log", 30, f"{root}/positions.json")
    q = stream.writeStream.queryName("broken").option("checkpointLocation", f"{root}/ckpt").foreachBatch(broken).trigger(availableNow=True).start()
    with pytest.raises(Exception, match="crash between"):
        q.awaitTermination()
    seen = _drain(spark, root, "broken", 30)
    assert seen[0] == (0, [(0, 0, 29, 30)]) and [r for _, rows in seen[1:] for r in rows] in ([], [(0, 30, 49, 20)])
    rest = seen[1:] or _drain(spark, root, "broken", 30)
    assert rest == [(1, [(0, 30, 49, 20)])]


def test_slices_cover_a_range_once(spark):
    root = _root(spark)
    write_segments(_log(spark, 5, 75), f"{root}/log", segment=16)
    reader = OffsetLogReader(LOG_ROW, {"path": f"{root}/log"})
    assert reader.initialOffset() == {"0": 0, "1": 0} and reader.latestOffset() == {"0": 75, "1": 75}
    slices = reader.partitions({"0": 10, "1": 64}, {"0": 70, "1": 75})
    assert sorted((s.partition, s.low, s.high) for s in slices) == [(0, 10, 16), (0, 16, 32), (0, 32, 48), (0, 48, 64), (0, 64, 70), (1, 64, 75)]
    offsets = [(s.partition, o) for s in slices for b in reader.read(s) for o in b["offset"].to_pylist()]
    assert sorted(offsets) == [(0, o) for o in range(10, 70)] + [(1, o) for o in range(64, 75)]
    with pytest.raises(ValueError, match="positions"):
        OffsetLogReader(LOG_ROW, {"path": root, "records_per_partition": "5"})


def test_columns_and_values_as_written(spark):
    root = _root(spark)
    log = _log(spark, 0, 20)
    write_segments(log, f"{root}/log", segment=8)
    q = read_offset_stream(spark, f"{root}/log").writeStream.queryName(f"m{uuid.uuid4().hex[:6]}").format("memory").trigger(availableNow=True).start()
    q.awaitTermination()
    got = spark.table(q.name)
    assert got.schema.fieldNames() == LOG_ROW.fieldNames()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, read_segments(spark, f"{root}/log").collect())) == sorted(map(tuple, log.collect()))
    ends = json.loads(q.lastProgress.json)["sources"][0]["endOffset"]
    assert {p: int(o) for p, o in ends.items()} == {str(r.partition): r.end for r in log_ends(spark, f"{root}/log").collect()}


def test_reconciliation_equals_counting(spark):
    rng = random.Random(4)
    log = [(p, o) for p in range(3) for o in range(100) if rng.random() > 0.05]
    sent = [x for x in log if rng.random() > 0.1] + rng.sample(log, 30) + [(1, 500), (1, 501), (9, 3), (0, None)]
    frame = lambda rows: spark.createDataFrame(rows, "partition int, offset long")
    kinds = {}
    for x in set(log) | {s for s in sent if s[1] is not None}:
        n = sent.count(x)
        for kind, is_so in (("log", x in log), ("unknown", x not in log), ("missing", x in log and not n), ("duplicate", n > 1)):
            if is_so:
                kinds.setdefault((x[0], kind), []).append(x[1])
    want = []
    for (p, kind), offsets in kinds.items():
        for o in sorted(offsets):
            if want and want[-1][:2] == (p, kind) and want[-1][3] == o - 1:
                want[-1] = (p, kind, want[-1][2], o, want[-1][4] + 1)
            else:
                want.append((p, kind, o, o, 1))
    for chunk in (7, 1 << 16):
        assert sorted(map(tuple, reconcile_offsets(frame(log), frame(sent), chunk).collect())) == sorted(want)
    assert reconcile_offsets(frame([]), frame([]), 8).count() == 0
