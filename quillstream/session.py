"""Spark session helpers.

``get_session`` is for scripts, tests and the bench; library code works on the
caller's session. ``warehouse_root`` resolves the shared folder where tables,
commit logs and stream checkpoints live: it is always taken from the session
(``spark.checkpoint.dir``). Only a local master may leave that unset, and then
gets a private scratch folder; elsewhere it is an error, as executors would
each write to a disk of their own.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

# Runtime settings every job relies on (UTC event time, AQE, RocksDB state).
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.aggregatePushdown": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}
BASE_CONF = RUNTIME_CONF | {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "quillstream") -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    builder = SparkSession.builder.master(master).appName(app_name)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    builder = (builder
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
               .config("spark.driver.memory", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_conf(spark)
    return spark


def apply_conf(spark: SparkSession) -> None:
    """Apply the runtime settings to an existing session and ship the package."""
    for k, v in RUNTIME_CONF.items():
        spark.conf.set(k, v)
    ship_package(spark)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application: Python workers
    import the functions they run by module name."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    # the zip is read on the driver only; executors fetch it from there
    target = os.path.join(tempfile.mkdtemp(prefix="quillstream-pkg-"), "quillstream.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(package):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                out.write(path, os.path.relpath(path, os.path.dirname(package)))
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(app)


_LOCAL_ROOTS: dict[str, str] = {}


def warehouse_root(spark: SparkSession) -> str:
    """Shared folder for tables and checkpoints, from ``spark.checkpoint.dir``."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        root = _LOCAL_ROOTS.get(app)
        if root is None:
            root = _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="quillstream-wh-")
            spark.sparkContext.setCheckpointDir(os.path.join(root, "_rdd_checkpoints"))
    return root.rstrip("/")
