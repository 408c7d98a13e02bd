"""Micro-batches are divided by their size and states by the cluster's cores."""
import glob
import uuid

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from quillstream.functions.codec import encode_one
from quillstream.plans.stream_queries import write_log_files
from quillstream.schema import LOG_ROW
from quillstream.session import warehouse_root
from quillstream.sources.log import read_log_stream
from quillstream.streaming import jobs
from quillstream.streaming.native_windows import start_native_window_job


def _rows(spark, n, value):
    return spark.range(n, numPartitions=1).select(
        F.lit(b"a").alias("key"), value.alias("value"), F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"),
        F.timestamp_seconds(F.lit(1_700_000_000)).alias("timestamp"), F.lit(3).cast("long").alias("_batch"))


def test_large_batch_is_one_file_of_many_row_groups(spark):
    root = f"{warehouse_root(spark)}/test-groups-{uuid.uuid4().hex[:8]}"
    log = _rows(spark, 200_000, F.unhex(F.sha2(F.col("id").cast("string"), 512)))
    assert write_log_files(log, "_batch", root) == 1
    files = glob.glob(f"{root.removeprefix('file://')}/_batch=3/*.parquet")
    assert len(files) == 1
    meta = pq.read_metadata(files[0])
    assert meta.num_rows == 200_000 and meta.num_row_groups >= 4
    assert spark.read.schema(LOG_ROW).parquet(f"{root}/*").distinct().count() == 200_000


def test_state_has_no_more_partitions_than_the_cluster_has_cores(spark):
    root = f"{warehouse_root(spark)}/test-state-{uuid.uuid4().hex[:8]}"
    base = dict(device_id="d", site_id="s", ts=1_700_000_000_000, temperature_c=20.0, humidity_pct=50.0, pressure_hpa=1000.0, vibration_g=0.0, firmware_version=None)
    write_log_files(_rows(spark, 3, F.lit(encode_one(base))), "_batch", f"{root}/log")
    cores, key = spark.sparkContext.defaultParallelism, "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(4 * cores))
    try:
        q = start_native_window_job(read_log_stream(spark, f"{root}/log/*"), jobs.agg_table(spark, root), f"{root}/ckpt", {"availableNow": True})
        q.awaitTermination()
        assert spark.conf.get(key) == str(4 * cores)
    finally:
        spark.conf.set(key, before)
    states = [p for p in glob.glob(f"{root.removeprefix('file://')}/ckpt/state/0/*") if p.rsplit("/", 1)[1].isdigit()]
    assert len(states) == max(2, cores)
