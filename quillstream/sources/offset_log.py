"""Log source with a position per partition, over segment files (SRC1, MET1).

Layout: ``<path>/partition=<p>/base=<offset>/*.parquet``; a segment holds the
records of its log partition from its base offset on, below the next base.
``write_segments`` lays a log out so, and further records may be appended.

``OffsetLog`` is a streaming data source over it. A stream's position is
``{partition: next offset}``, which Spark keeps in the checkpoint:

* it starts at the earliest records and looks no further than the newest ones;
* ``records_per_partition`` limits how many offsets of each log partition a
  micro-batch takes. The source has to know its position for that, also when it
  is started again: every planned batch notes its end in the ``positions`` file.
  Spark plans a batch (again, after a failure) before it asks for the next one,
  so the note is never behind the checkpoint;
* a micro-batch is read in one task per segment that it touches, so one busy log
  partition is no single task, and only the files and columns wanted are opened.

Files are reached through pyarrow's file systems (local, HDFS, S3, GCS by URI).
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..schema import LOG_ROW
from ..session import ship_package

SEGMENT = 1 << 20


def write_segments(log: DataFrame, path: str, segment: int = SEGMENT) -> None:
    """Append log rows as segment files; a segment is written by one task."""
    based = log.select(*LOG_ROW.fieldNames()).withColumn("base", F.expr(f"`offset` div {segment} * {segment}"))
    (based.repartition("partition", "base").sortWithinPartitions("partition", "base", "offset")
     .write.mode("append").partitionBy("partition", "base").parquet(path))


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """The whole log as a table."""
    return spark.read.schema(LOG_ROW).parquet(path).select(*LOG_ROW.fieldNames())


def _resolve(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(path)


class Slice(InputPartition):
    """Offsets [low, high) of one segment of a log partition."""

    def __init__(self, partition: int, folder: str, low: int, high: int):
        self.partition, self.folder, self.low, self.high = partition, folder, low, high


class OffsetLogReader(DataSourceStreamReader):
    def __init__(self, schema: StructType, options: dict[str, str]):
        self.schema = schema
        self.path = options["path"].rstrip("/")
        self.limit = int(options.get("records_per_partition", 0))
        self.positions = options.get("positions")
        if self.limit and not self.positions:
            raise ValueError("a limit needs a positions file, from which a restart goes on")
        self.at = self._noted()

    # ------------------------------------------------------------- the log

    def _folders(self, folder: str, name: str) -> dict[int, str]:
        files, at = _resolve(folder)
        found = files.get_file_info(pafs.FileSelector(at, allow_not_found=True))
        return {int(i.base_name.partition("=")[2]): f"{folder}/{i.base_name}" for i in found
                if i.type == pafs.FileType.Directory and i.base_name.startswith(f"{name}=")}

    @staticmethod
    def _files(folder: str) -> tuple[pafs.FileSystem, list[str]]:
        files, at = _resolve(folder)
        return files, sorted(i.path for i in files.get_file_info(pafs.FileSelector(at)) if i.is_file and i.path.endswith(".parquet"))

    def _segments(self) -> dict[int, dict[int, str]]:
        return {p: self._folders(folder, "base") for p, folder in self._folders(self.path, "partition").items()}

    def _end(self, segments: dict[int, str]) -> int:
        """Offset after the last record, from the footers of the last segment."""
        base = max(segments)
        files, names = self._files(segments[base])
        end = base
        for name in names:
            meta = pq.read_metadata(name, filesystem=files)
            column = meta.schema.names.index("offset")
            for g in range(meta.num_row_groups):
                end = max(end, meta.row_group(g).column(column).statistics.max + 1)
        return end

    # ------------------------------------------------------------ positions

    def _noted(self) -> dict[str, int]:
        if not self.positions:
            return {}
        files, at = _resolve(self.positions)
        if files.get_file_info(at).type != pafs.FileType.File:
            return {}
        with files.open_input_stream(at) as source:
            return json.loads(source.read())

    def _note(self, end: dict[str, int]) -> None:
        self.at = dict(end)
        if self.positions:
            files, at = _resolve(self.positions)
            files.create_dir(at.rsplit("/", 1)[0], recursive=True)
            with files.open_output_stream(at + ".new") as out:
                out.write(json.dumps(end).encode())
            files.move(at + ".new", at)

    def initialOffset(self) -> dict:
        return {str(p): min(s) for p, s in self._segments().items() if s}

    def latestOffset(self) -> dict:
        out = {}
        for p, segments in self._segments().items():
            if segments:
                end = self._end(segments)
                out[str(p)] = min(end, self.at.get(str(p), min(segments)) + self.limit) if self.limit else end
        return out

    def partitions(self, start: dict, end: dict) -> list[Slice]:
        self._note(end)
        out = []
        for p, segments in self._segments().items():
            bases = sorted(segments)
            low, high = start.get(str(p), bases[0] if bases else 0), end.get(str(p), 0)
            for base, following in zip(bases, [*bases[1:], high]):
                first, last = max(low, base), min(high, following if following > base else high)
                if first < last:
                    out.append(Slice(p, segments[base], first, last))
        return out

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        names = [f.name for f in self.schema.fields]
        target = to_arrow_schema(self.schema)
        stored = [n for n in dict.fromkeys([*names, "offset"]) if n != "partition"]
        files, paths = self._files(partition.folder)
        for path in paths:
            with files.open_input_file(path) as source:
                for batch in pq.ParquetFile(source).iter_batches(batch_size=8192, columns=stored):
                    own = batch.filter(pc.and_(pc.greater_equal(batch["offset"], partition.low), pc.less(batch["offset"], partition.high)))
                    if own.num_rows:
                        columns = {"partition": pa.array([partition.partition] * own.num_rows, pa.int32()), **dict(zip(own.schema.names, own.columns))}
                        yield pa.RecordBatch.from_arrays([columns[n].cast(target.field(n).type) for n in names], schema=target)

    def commit(self, end: dict) -> None:
        pass

    def stop(self) -> None:
        pass


class OffsetLog(DataSource):
    """``spark.readStream.format("offset_log")`` with options path, records_per_partition and positions."""

    @classmethod
    def name(cls) -> str:
        return "offset_log"

    def schema(self) -> StructType:
        return LOG_ROW

    def streamReader(self, schema: StructType) -> OffsetLogReader:
        return OffsetLogReader(schema, dict(self.options))


def read_offset_stream(spark: SparkSession, path: str, records_per_partition: int | None = None, positions: str | None = None) -> DataFrame:
    """Stream over a segment log from its earliest record, or from the checkpoint's position."""
    ship_package(spark)
    spark.dataSource.register(OffsetLog)
    reader = spark.readStream.format("offset_log").option("path", path)
    if records_per_partition:
        reader = reader.option("records_per_partition", str(records_per_partition))
    if positions:
        reader = reader.option("positions", positions)
    return reader.load()


def log_ends(spark: SparkSession, path: str) -> DataFrame:
    """(partition, first, end): earliest offset and the offset after the last record."""
    return read_segments(spark, path).groupBy("partition").agg(F.min("offset").alias("first"), (F.max("offset") + 1).alias("end"))
