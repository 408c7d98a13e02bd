"""Transactional keyed writer: order per key, epochs that fail, batches that are repeated."""
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillstream.session import warehouse_root
from quillstream.sources import epoch_log
from quillstream.sources.epoch_log import EpochWriter, Written, read_epochs, write_keyed_stream


def _input(spark, root, n, rows):
    spark.createDataFrame(rows, "key string, value string, order long").repartition(4).write.parquet(f"{root}/in/f{n:03d}")


def _stream(spark, root):
    return spark.readStream.schema("key string, value string, order long").option("maxFilesPerTrigger", 100).parquet(f"{root}/in/*")


def _drain(spark, root, rows=None):
    q = write_keyed_stream(rows if rows is not None else _stream(spark, root), f"{root}/log", f"{root}/ckpt", 3, "keyed", {"availableNow": True})
    q.awaitTermination()
    assert q.exception() is None


def _root(spark):
    return f"{warehouse_root(spark)}/test-epochs-{uuid.uuid4().hex[:8]}"


def _check(spark, root, want):
    got = read_epochs(spark, f"{root}/log").collect()
    assert sorted((r.key.decode(), r.order) for r in got) == sorted((k, o) for k, _, o in want)
    for p in {r.partition for r in got}:
        assert sorted(r.offset for r in got if r.partition == p) == list(range(sum(r.partition == p for r in got)))
    for k in {r.key for r in got}:
        own = sorted((r for r in got if r.key == k), key=lambda r: r.offset)
        assert len({r.partition for r in own}) == 1 and [(r.epoch, r.order) for r in own] == sorted((r.epoch, r.order) for r in own)
    return got


def test_keyed_rows_keep_their_order(spark):
    root = _root(spark)
    first = [(f"k{i % 7}", f"v{i}", i) for i in range(200)]
    _input(spark, root, 0, first)
    _drain(spark, root)
    second = [(f"k{i % 9}", f"v{i}", i) for i in range(200, 260)]
    _input(spark, root, 1, second)
    _drain(spark, root)
    assert {r.epoch for r in _check(spark, root, first + second)} == {0, 1}


def test_failed_epoch_leaves_nothing_to_be_seen(spark):
    root = _root(spark)
    first = [(f"k{i % 5}", f"v{i}", i) for i in range(40)]
    _input(spark, root, 0, first)
    _drain(spark, root)
    second = [(f"k{i % 5}", f"v{i}", i) for i in range(40, 90)]
    _input(spark, root, 1, second)

    @F.udf(T.StringType())
    def breaks(value):
        if value == "v77":
            raise ValueError("a task fails")
        return value

    with pytest.raises(Exception, match="a task fails"):
        _drain(spark, root, _stream(spark, root).withColumn("value", breaks("value")))
    assert {r.epoch for r in _check(spark, root, first)} == {0}
    _drain(spark, root)
    _check(spark, root, first + second)


def test_repeated_and_aborted_commits(spark, tmp_path):
    import pyarrow as pa

    writer = EpochWriter(str(tmp_path), "w")
    batch = lambda *o: pa.RecordBatch.from_arrays([pa.array([0] * len(o), pa.int32()), pa.array([b"k"] * len(o)), pa.array([b"v"] * len(o)),
                                                   pa.array(o, pa.int64())], ["partition", "key", "value", "order"])
    one = writer.write(iter([batch(2, 1)]))
    writer.commit([one, None, Written([])], 0)
    writer.commit([writer.write(iter([batch(1, 2)]))], 0)      # repeated after a crash
    lost = writer.write(iter([batch(9)]))
    writer.abort([lost], 1)
    writer.commit([], 1)                                       # an epoch of no rows
    writer.commit([writer.write(iter([batch(3)]))], 2)
    assert [(r.offset, r.order, r.epoch) for r in read_epochs(spark, str(tmp_path)).orderBy("offset").collect()] == [(0, 1, 0), (1, 2, 0), (2, 3, 2)]


def _wire_batches(n, size, seen=None):
    """Arrow batches of two log partitions with orders from all over the range."""
    rng = np.random.default_rng(3)
    orders = rng.permutation(n * size) // 2  # every order twice
    for i in range(n):
        if seen is not None:
            seen.append(pa.total_allocated_bytes())
        own = orders[i * size:(i + 1) * size]
        yield pa.RecordBatch.from_pydict({"partition": pa.array(own % 2, pa.int32()), "key": pa.array([b"k%d" % (o % 5) for o in own], pa.binary()),
                                          "value": pa.array([b"%d" % o * 150 for o in own], pa.binary()), "order": pa.array(own, pa.int64())})


def test_task_holds_a_bounded_part_of_its_rows(tmp_path):
    seen = []
    before = pa.total_allocated_bytes()
    written = EpochWriter(f"file://{tmp_path}/log", "w").write(_wire_batches(60, 4000, seen))  # about 200 MB
    assert max(seen) - before < 100e6
    assert sorted((p, records) for p, _, records in written.files) == [(0, 120_000), (1, 120_000)]
    for p, name, _ in written.files:
        order = pq.read_table(f"{tmp_path}/log/data/{name}").column("order").to_numpy()
        assert (np.diff(order) >= 0).all() and (np.bincount(order, minlength=120_000)[p::2] == 2).all()


def test_merged_runs_equal_a_sort(tmp_path, monkeypatch):
    monkeypatch.setattr(epoch_log, "RUN_BYTES", 20_000)
    monkeypatch.setattr(epoch_log, "BLOCK_BYTES", 3_000)
    batches = [*_wire_batches(6, 50), pa.RecordBatch.from_pydict({
        "partition": pa.array([0, 0], pa.int32()), "key": pa.array([None, b"x"], pa.binary()), "value": pa.array([b"v", None], pa.binary()), "order": pa.array([None, 7], pa.int64())})]
    written = EpochWriter(f"file://{tmp_path}/log", "w").write(iter(batches))
    every = pa.Table.from_batches(batches)
    for p, name, records in written.files:
        rows = pq.read_table(f"{tmp_path}/log/data/{name}")
        own = every.filter(pa.compute.equal(every.column("partition"), p)).sort_by("order")
        assert records == rows.num_rows and rows.column("order").to_pylist() == own.column("order").to_pylist()
        as_set = lambda t: sorted(map(repr, t.select(["key", "value", "order"]).to_pylist()))
        assert as_set(rows) == as_set(own)
