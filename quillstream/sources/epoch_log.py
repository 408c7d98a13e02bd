"""Transactional keyed log writer for streams (SNK3, SNK4).

Every task writes the rows of each log partition that it holds, in their order,
to a file of its own and reports it; it sorts them in runs on its disk, so its
memory does not grow with the micro-batch. When all tasks of a micro-batch are done the
driver publishes the epoch: one small file that names the batch's files and the
first offset of each. Readers take only files that an epoch names, so an epoch
that failed or was given up leaves nothing to be seen, and a batch that is
repeated after it was published is not published again.

Layout: ``<path>/data/*.parquet`` (key, value, order), ``<path>/epochs/<n>.json``
with a line per file (epoch, writer, batch, file, partition, base, records). A
record's offset is its file's base and its row number, so offsets of a log
partition follow each other without gaps, as epochs do.

A key always goes to the same log partition and its rows keep their order there.
Files are reached through pyarrow's file systems; a log has one writer at a time.
"""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..session import ship_package
from .offset_log import _resolve

RUN_BYTES = 1 << 25     # rows that a task holds at once
BLOCK_BYTES = 1 << 18   # of a run, read at once when runs are merged
DATA = "key binary, value binary, `order` long"
EPOCHS = "epoch long, writer string, batch long, file string, partition int, base long, records long, next string"


@dataclass
class Written(WriterCommitMessage):
    """Files of one task: (log partition, file name, records)."""

    files: list[tuple[int, str, int]]


def _sorted(batches: list[pa.RecordBatch]) -> pa.Table:
    return pa.Table.from_batches(batches).sort_by("order")


def _places(batch: pa.RecordBatch) -> np.ndarray:
    """Sort keys of rows in order; rows without one come last."""
    return batch.column("order").fill_null(np.iinfo(np.int64).max).to_numpy()


class Runs:
    """A task's rows of one log partition: what came last in memory, earlier rows in
    sorted runs on the task's own disk, which are merged block by block."""

    def __init__(self, name: str):
        self.name, self.schema = name, None
        self.pending: list[pa.RecordBatch] = []
        self.paths: list[str] = []
        self.size = self.rows = 0

    def add(self, batch: pa.RecordBatch) -> None:
        self.schema = self.schema or batch.schema
        self.pending.append(batch)
        self.size += batch.nbytes
        self.rows += batch.num_rows

    def spill(self) -> None:
        rows = _sorted(self.pending)
        block = max(1, rows.num_rows * BLOCK_BYTES // max(1, self.size))
        self.paths.append(f"{self.name}-{len(self.paths)}.arrow")
        with pa.OSFile(self.paths[-1], "wb") as sink, pa.ipc.new_file(sink, self.schema) as file:
            file.write_table(rows, max_chunksize=block)
        self.pending, self.size = [], 0

    def _blocks(self, path: str) -> Iterator[pa.RecordBatch]:
        with pa.OSFile(path) as source, pa.ipc.open_file(source) as file:
            for i in range(file.num_record_batches):
                yield file.get_batch(i)

    def merged(self) -> Iterator[pa.Table]:
        """All rows in order, in pieces of about RUN_BYTES at most."""
        if not self.paths:
            yield _sorted(self.pending)
            return
        if self.pending:
            self.spill()
        runs = [self._blocks(path) for path in self.paths]
        heads = [next(run, None) for run in runs]
        ready, size = [], 0
        while any(h is not None for h in heads):
            # no run has a later block with rows in front of this place
            bound = min(_places(h)[-1] for h in heads if h is not None)
            taken = []
            for i, head in enumerate(heads):
                if head is None:
                    continue
                n = int(np.searchsorted(_places(head), bound, "right"))
                taken.append(head.slice(0, n))
                heads[i] = head.slice(n) if n < head.num_rows else next(runs[i], None)
            ready.append(_sorted(taken))
            size += ready[-1].nbytes
            if size >= RUN_BYTES:
                yield pa.concat_tables(ready)
                ready, size = [], 0
        if ready:
            yield pa.concat_tables(ready)


class EpochWriter(DataSourceStreamArrowWriter):
    def __init__(self, path: str, writer: str):
        self.path, self.writer = path.rstrip("/"), writer

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        held: dict[int, Runs] = {}
        files, at = _resolve(f"{self.path}/data")
        files.create_dir(at, recursive=True)
        out = []
        with tempfile.TemporaryDirectory(prefix="epoch-runs-") as folder:
            for batch in iterator:
                for p in batch.column("partition").unique().to_pylist():
                    own = batch.filter(pc.equal(batch.column("partition"), p)).select(["key", "value", "order"])
                    held.setdefault(p, Runs(f"{folder}/{p}")).add(own)
                if sum(r.size for r in held.values()) >= RUN_BYTES:
                    max(held.values(), key=lambda r: r.size).spill()
            for p in sorted(held):
                name = f"{uuid.uuid4().hex}.parquet"
                with pq.ParquetWriter(f"{at}/{name}", held[p].schema, filesystem=files, compression="zstd") as file:
                    for rows in held[p].merged():
                        file.write_table(rows)
                out.append((p, name, held[p].rows))
        return Written(out)

    def _newest(self, files: pafs.FileSystem, at: str) -> tuple[int, list[dict]]:
        names = sorted(i.base_name for i in files.get_file_info(pafs.FileSelector(at, allow_not_found=True)) if i.base_name.endswith(".json"))
        if not names:
            return -1, []
        with files.open_input_stream(f"{at}/{names[-1]}") as source:
            return int(names[-1].partition(".")[0]), [json.loads(line) for line in source.read().decode().splitlines()]

    def commit(self, messages: list[Written | None], batchId: int) -> None:  # noqa: N803
        files, at = _resolve(f"{self.path}/epochs")
        files.create_dir(at, recursive=True)
        newest, lines = self._newest(files, at)
        if lines and lines[0]["writer"] == self.writer and lines[0]["batch"] >= batchId:
            return  # published before; the new files stay unnamed
        following = json.loads(lines[0]["next"]) if lines else {}
        new = []
        for p, name, records in sorted(f for m in messages if m is not None for f in m.files):
            base = following.get(str(p), 0)
            new.append({"file": name, "partition": p, "base": base, "records": records})
            following[str(p)] = base + records
        head = {"epoch": newest + 1, "writer": self.writer, "batch": batchId, "next": json.dumps(following)}
        text = "\n".join(json.dumps({**head, **x}) for x in new or [{}])
        with files.open_output_stream(f"{at}/.{newest + 1:012d}.new") as out:
            out.write(text.encode())
        files.move(f"{at}/.{newest + 1:012d}.new", f"{at}/{newest + 1:012d}.json")

    def abort(self, messages: list[Written | None], batchId: int) -> None:  # noqa: N803
        files, at = _resolve(f"{self.path}/data")
        for _, name, _ in (f for m in messages if m is not None for f in m.files):
            files.delete_file(f"{at}/{name}")


class EpochLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return "epoch_log"

    def streamWriter(self, schema: StructType, overwrite: bool) -> EpochWriter:
        return EpochWriter(self.options["path"], self.options["writer"])


def write_keyed_stream(rows: DataFrame, path: str, checkpoint: str, partitions: int, name: str, trigger: dict | None = None) -> StreamingQuery:
    """Start writing a stream of (key, value, order) to a log; ``name`` names the query and the writer."""
    spark = rows.sparkSession
    ship_package(spark)
    spark.dataSource.register(EpochLog)
    placed = rows.select(F.pmod(F.xxhash64("key"), F.lit(partitions)).cast("int").alias("partition"), F.col("key").cast("binary").alias("key"),
                         F.col("value").cast("binary").alias("value"), F.col("order").cast("long").alias("order")).repartition(partitions, "partition")
    writer = placed.writeStream.format("epoch_log").queryName(name).option("path", path).option("writer", name).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "30 seconds"})).start()


def read_epochs(spark: SparkSession, path: str) -> DataFrame:
    """(partition, offset, key, value, order, epoch) of all published records."""
    named = spark.read.schema(EPOCHS).json(f"{path}/epochs").filter("file IS NOT NULL").select("epoch", "file", "partition", "base")
    stored = spark.read.schema(DATA).parquet(f"{path}/data").select("*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    return stored.join(named, "file").select("partition", (F.col("base") + F.col("row")).alias("offset"), "key", "value", "order", "epoch")
