"""Parquet tables with a commit log (SNK1, SNK2, SNK5, SRC5-SRC9, T1, T3, T5, P10).

Layout of a table ``<root>/<name>``::

    data/<day_col>=YYYY-MM-DD/part_key=<writer>-<batch>/part-*.parquet
    _commits/<first commit id>.json    one line per commit (small)

A write puts its rows under a part key of its own (dynamic partition overwrite,
so a repeated batch replaces its own files and nothing else) and then publishes
a commit. A commit file is named by the id after the newest one and never
overwritten: of two writers that saw the same newest commit, the later one
fails with ``CommitConflict`` and loses nothing but its turn. Readers join the
data with the part keys of the commits they want, so files of a batch that was
never committed are not seen, and Spark's own partition filters prune days and
parts in the scan.
"""

from __future__ import annotations

import datetime as dt
import json
import time
import urllib.parse
import uuid
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import day_partition_field
from ..session import warehouse_root

COMMITS_SCHEMA = T.StructType([
    T.StructField("commit_id", T.LongType(), False),
    T.StructField("parent_id", T.LongType(), True),
    T.StructField("committed_at_ms", T.LongType(), False),
    T.StructField("operation", T.StringType(), False),
    T.StructField("writer", T.StringType(), True),
    T.StructField("batch_id", T.LongType(), True),
    T.StructField("part_key", T.StringType(), True),
    T.StructField("added_records", T.LongType(), False),
    T.StructField("total_records", T.LongType(), False),
])
APPEND = "append"


class CommitConflict(RuntimeError):
    """Another writer published a commit in between."""


# ----------------------------------------------------------------- file system

def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]


def create_file(spark: SparkSession, path: str, text: str) -> None:
    """Create a small file; ``CommitConflict`` when it exists."""
    fs, p = _fs(spark, path)
    try:
        out = fs.create(p, False)
    except Exception as e:
        if fs.exists(p):
            raise CommitConflict(f"{path} exists: another writer committed first") from e
        raise
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_file(spark: SparkSession, path: str) -> str:
    """Text of a small file."""
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def replace_file(spark: SparkSession, path: str, text: str) -> None:
    """Create a small file or put a new one in its place."""
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file or folder if it is there."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


# ------------------------------------------------------------------- the table

class Table:
    """Handle on one table (paths + schema); holds no data and remembers no state."""

    def __init__(self, spark: SparkSession, name: str, schema: T.StructType, time_col: str,
                 root: str | None = None):
        self.spark = spark
        self.name = name
        self.schema = schema
        self.time_col = time_col
        self.day_col = day_partition_field(schema, time_col)
        self.root = (root or f"{warehouse_root(spark)}/tables").rstrip("/")
        self.path = f"{self.root}/{name}"
        self.data_path = f"{self.path}/data"
        self.commits_path = f"{self.path}/_commits"

    # SNK5: create if absent; never alters an existing table.
    def create_if_absent(self) -> Table:
        for path in (self.commits_path, self.data_path):
            fs, p = _fs(self.spark, path)
            fs.mkdirs(p)
        return self

    def commits(self) -> DataFrame:
        """Commit log (SRC7)."""
        return self.spark.read.schema(COMMITS_SCHEMA).json(self.commits_path)

    # ------------------------------------------------------------------ writes

    def with_day(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.day_col, F.to_date(F.col(self.time_col).cast("timestamp")))

    def write_parts(self, df: DataFrame) -> None:
        """Write rows that carry a day and a part key; they are seen once committed."""
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy(self.day_col, "part_key").parquet(self.data_path))

    def _stored_schema(self) -> T.StructType:
        return T.StructType(list(self.schema.fields) + [
            T.StructField(self.day_col, T.DateType()), T.StructField("part_key", T.StringType())])

    # The log is looked up by file name, so that a commit costs the same however long the
    # log is: a note of a recent place is followed forwards. A note may be lost or stale,
    # as it only says where to begin.

    def _commit_file(self, first: int) -> str:
        return f"{self.commits_path}/{first:012d}.json"

    def _note_path(self, name: str) -> str:
        return f"{self.path}/_notes/{name}"

    def _note(self, name: str) -> dict | None:
        path = self._note_path(name)
        try:
            return json.loads(read_file(self.spark, path)) if path_exists(self.spark, path) else None
        except ValueError:  # half written
            return None

    def _followed(self, first: int) -> Iterator[list[dict]]:
        """Commits of the log's files from the one named ``first`` on."""
        while path_exists(self.spark, self._commit_file(first)):
            found = [json.loads(line) for line in read_file(self.spark, self._commit_file(first)).splitlines()]
            yield found
            first = found[-1]["commit_id"] + 1

    def head(self) -> tuple[int | None, int]:
        """(id, total rows) of the newest commit, from the log as it is now."""
        note = self._note("head") or {"first": 0}
        newest = None
        for found in self._followed(note["first"]):
            newest = found
        if newest is None:
            return None, 0
        if newest[0]["commit_id"] != note["first"]:
            replace_file(self.spark, self._note_path("head"), json.dumps({"first": newest[0]["commit_id"]}))
        return newest[-1]["commit_id"], newest[-1]["total_records"]

    def publish(self, after: tuple[int | None, int], new: list[tuple]) -> None:
        """Publish commits (committed_at_ms, writer, batch_id, part_key, added rows)
        that follow the commit ``after``; ``CommitConflict`` if that is no longer the newest."""
        parent, total = after
        lines, first = [], 0 if parent is None else parent + 1
        for stamp, writer, batch, part_key, added in new:
            total += added
            cid = first + len(lines)
            lines.append(json.dumps({"commit_id": cid, "parent_id": parent, "committed_at_ms": stamp, "operation": APPEND, "writer": writer,
                                     "batch_id": batch, "part_key": part_key, "added_records": added, "total_records": total}))
            parent = cid
        create_file(self.spark, self._commit_file(first), "\n".join(lines) + "\n")

    def _committed(self, writer: str) -> DataFrame:
        return self.commits().filter(F.col("writer") == writer).select("batch_id")

    def committed(self, writer: str, batch_id: int) -> bool:
        """Whether a writer that commits its batches one after the other has committed this one.

        The writer's note says up to which file of the log its commits were looked through."""
        name = "writer-" + urllib.parse.quote(writer, safe="")
        note = self._note(name) or {"first": 0, "batch": None}
        at, last = note["first"], note["batch"]
        for found in self._followed(note["first"]):
            at = found[0]["commit_id"]
            own = [c["batch_id"] for c in found if c["writer"] == writer]
            last = max([*own, *([] if last is None else [last])], default=None)
        if (at, last) != (note["first"], note["batch"]):
            replace_file(self.spark, self._note_path(name), json.dumps({"first": at, "batch": last}))
        return last is not None and batch_id <= last

    def append_batches(self, df: DataFrame, batch_col: str, writer: str = "append", committed_at_col: str | None = None) -> None:
        """Write many batches in one distributed job, one commit per batch (backfill).

        Batches already committed by ``writer`` are skipped. ``committed_at_col``
        (epoch ms, the largest of a batch, not stored) stamps commits; default is
        the wall clock. One row per batch comes to the driver, as the log holds."""
        self.create_if_absent()
        after = self.head()
        todo = df.join(self._committed(writer).withColumnRenamed("batch_id", batch_col), on=batch_col, how="left_anti")
        stamp = F.max(committed_at_col) if committed_at_col else F.lit(int(time.time() * 1000))
        tag = F.format_string("%s-%012d", F.lit(writer), F.col(batch_col).cast("long"))
        rows = self.with_day(todo.drop(*([committed_at_col] if committed_at_col else []))).withColumn("part_key", tag)
        self.write_parts(rows.drop(batch_col))
        counts = todo.groupBy(batch_col).agg(F.count(F.lit(1)).alias("n"), stamp.cast("long").alias("at"), F.first(tag).alias("tag"))
        new = [(r["at"], writer, int(r[batch_col]), r["tag"], r["n"]) for r in counts.orderBy(batch_col).collect()]
        if new:
            self.publish(after, new)

    def commit_batch(self, df: DataFrame, writer: str, batch_id: int, committed_at_ms: int | None = None,
                     after: tuple[int | None, int] | None = None) -> bool:
        """Stream sink step (SNK1): write one micro-batch and commit it; the row
        count is observed while writing. False when it was committed before.

        ``after`` is the head that the rows were made from; ``CommitConflict`` if
        it is no longer the newest. Without it the rows follow whatever is newest."""
        self.create_if_absent()
        if self.committed(writer, batch_id):
            return False
        key = f"{writer}-{batch_id:012d}"
        seen = Observation()
        rows = df.observe(seen, F.count(F.lit(1)).alias("n"))
        self.write_parts(self.with_day(rows).withColumn("part_key", F.lit(key)))
        stamp = committed_at_ms if committed_at_ms is not None else int(time.time() * 1000)
        self.publish(after or self.head(), [(stamp, writer, int(batch_id), key, int(seen.get["n"]))])
        return True

    # ------------------------------------------------------------------- reads

    def files(self, days: Iterable[str] | None = None) -> DataFrame:
        """Stored rows, committed or not, with day and part key; of ``days`` (ISO dates)
        only, if given, and then no other day's folders are listed."""
        reader = self.spark.read.schema(self._stored_schema())
        if days is None:
            return reader.parquet(self.data_path)
        wanted = [f"{self.data_path}/{self.day_col}={d}" for d in sorted({str(d) for d in days})]
        found = [path for path in wanted if path_exists(self.spark, path)]
        if not found:
            return self.spark.createDataFrame([], self._stored_schema())
        return reader.option("basePath", self.data_path).parquet(*found)

    def read(self, as_of: int | None = None, days: Iterable[str] | None = None) -> DataFrame:
        """Table as of a commit (T3; default the newest), of some days or all; ``<day_col>`` and ``part_key`` are kept."""
        return self._live(self.files(days), as_of)

    def _live(self, stored: DataFrame, as_of: int | None) -> DataFrame:
        commits = self.commits()
        if as_of is not None:
            commits = commits.filter(F.col("commit_id") <= as_of)
        return stored.join(commits.select("part_key"), "part_key", "left_semi")

    def history(self) -> DataFrame:
        """Snapshot history (T1): every commit with operation, added and total rows."""
        return self.commits().select("commit_id", "parent_id", "committed_at_ms", "operation", "writer",
                                     "batch_id", "added_records", "total_records")

    def file_stats(self, as_of: int | None = None) -> DataFrame:
        """Data files of a snapshot with their rows (SRC8)."""
        stored = self.files().select("part_key", F.col(self.day_col).alias("day"), F.col("_metadata.file_path").alias("file"))
        return self._live(stored, as_of).groupBy("day", "file").agg(F.count(F.lit(1)).alias("records"))

    def part_counts(self, as_of: int | None = None) -> DataFrame:
        """(day, part_key, records) of a snapshot from the footers of its files (SRC8, M4):
        the count is pushed into the scan, which opens no column."""
        conf, v1 = self.spark.conf, "spark.sql.sources.useV1SourceList"
        before = conf.get(v1)
        conf.set(v1, ",".join(x for x in before.split(",") if x != "parquet"))
        try:
            stored = self.files()
        finally:
            conf.set(v1, before)
        counts = stored.groupBy(F.col(self.day_col).alias("day"), "part_key").agg(F.count(F.lit(1)).alias("records"))
        commits = self.commits() if as_of is None else self.commits().filter(F.col("commit_id") <= as_of)
        # an inner join: a semi join would be moved between the count and the scan
        return counts.join(commits.select("part_key").distinct(), "part_key").select("day", "part_key", "records")

    def orphans(self) -> DataFrame:
        """(day, part_key) of stored parts that no commit names (M3)."""
        stored = self.files().select(F.col(self.day_col).alias("day"), "part_key").distinct()
        return stored.join(self.commits().select("part_key"), "part_key", "left_anti").select("day", "part_key")

    def rewritten(self, root: str, rows_per_file: int = 5_000_000) -> Table:
        """The current rows in a new table with few files per day (M1, M2): a plain
        job that leaves this table, its snapshots and its writers alone."""
        out = Table(self.spark, self.name, self.schema, self.time_col, root=root).create_if_absent()
        rows = self.read().drop("part_key", self.day_col)
        days = out.with_day(rows).withColumn("part_key", F.lit("rewrite-000000000000"))
        seen = Observation()
        # counted after the shuffle, whose sampling runs what comes before it twice
        ranged = days.repartitionByRange(self.day_col, self.time_col).observe(seen, F.count(F.lit(1)).alias("n"))
        (ranged.sortWithinPartitions(self.day_col, self.time_col).write.mode("overwrite").option("maxRecordsPerFile", rows_per_file)
         .option("partitionOverwriteMode", "dynamic").partitionBy(self.day_col, "part_key").parquet(out.data_path))
        out.publish(out.head(), [(int(time.time() * 1000), "rewrite", 0, "rewrite-000000000000", int(seen.get["n"]))])
        return out


def days_between(start: str, end: str) -> list[str]:
    """ISO dates of the days that a range of timestamps (ISO text, UTC) touches."""
    low, high = (dt.date.fromisoformat(x[:10]) for x in (start, end))
    return [str(low + dt.timedelta(days=i)) for i in range((high - low).days + 1)]


def previous_snapshot(commits: DataFrame) -> DataFrame:
    """Second newest commit by time (L3), ties by id; an error when there is none."""
    newest = commits.orderBy(F.col("committed_at_ms").desc(), F.col("commit_id").desc())
    if len(newest.limit(2).collect()) < 2:
        raise ValueError("no earlier snapshot")
    return newest.offset(1).limit(1)


def latest_snapshots(commits: DataFrame, n: int = 5) -> DataFrame:
    """Newest ``n`` commits (L2)."""
    return commits.orderBy(F.col("committed_at_ms").desc(), F.col("commit_id").desc()).limit(n)


def list_tables(spark: SparkSession, root: str | None = None) -> DataFrame:
    """Tables under a root (SRC9): directories holding a commit log."""
    root = (root or f"{warehouse_root(spark)}/tables").rstrip("/")
    names = [n for n in list_dirs(spark, root) if path_exists(spark, f"{root}/{n}/_commits")]
    return spark.createDataFrame([(n,) for n in sorted(names)], "tableName string")


def new_root(spark: SparkSession, label: str) -> str:
    """A fresh table root in the shared warehouse (one per run of a registered query)."""
    return f"{warehouse_root(spark)}/runs/{label}-{uuid.uuid4().hex[:12]}"
