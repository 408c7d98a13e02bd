"""Operator 11: uniform shuffle into shards by a hypergeometric communication matrix.

The law is ``rows``: row counts of any two shards differ by one at most, and
every arrangement of the rows over shards and slots is equally likely.

* Rows are identified by (file, row number in the file), which no re-run and no
  other split of the files changes. BLOCK_ROWS consecutive rows of a file are a
  block; shards are cut into cells of consecutive slots, so that a shard of any
  size is worked on by many tasks.
* The communication matrix holds how many rows of each block go to each cell.
  Its margins are fixed: block sizes and cell sizes. It is drawn by halving: of
  a range of blocks, the rows that the left half sends to each cell follow a
  multivariate hypergeometric law. Every node of that tree of ranges has its own
  seed, so a task draws the row of its own block on the path from the root, and
  all tasks agree on the parts they share; the whole matrix is nowhere.
* Permute locally: a block's rows get the cells of its matrix row in a random
  order. Exchange: one shuffle by cell. Permute again: a cell's rows are sorted
  by a seeded hash of their identity, and their places are the slots.

The driver sees one count per file. Sizes follow from row counts alone, so
groups of copies, hot sources or long texts skew nothing; texts cross the
network once.

Defined cases: a null text has no bytes; null and repeated ids and repeated
rows are rows like any other; fewer rows than shards leave shards of no rows;
an empty table gives no rows; other columns travel along, whatever their names.
The arrangement depends on the seed, the order and sizes of the files and the
number of cells.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillstream.llm.common import session, shared, written

SHARDS = 24
SEED = 11
#: Rows of a block; one number of four bytes for each is held while a block is read.
BLOCK_ROWS = 1 << 20
#: Rows of a cell at most.
CELL_ROWS = 1 << 16
#: numpy draws from populations below this size
SMALL = 10**9


def even_sizes(rows: int, parts: int) -> np.ndarray:
    """Sizes of ``parts`` parts of ``rows`` rows that differ by one at most."""
    return np.full(parts, rows // parts, np.int64) + (np.arange(parts) < rows % parts)


def hypergeometric(rng: np.random.Generator, good: int, bad: int, drawn: int) -> int:
    """Good ones among ``drawn`` of ``good + bad``, for populations of any size."""
    if good + bad < SMALL:
        return int(rng.hypergeometric(good, bad, drawn))
    total = good + bad
    low, high = max(0, drawn - bad), min(good, drawn)
    # probabilities around the mode, each from its neighbour; further ones are below 1e-30
    mode = min(max((drawn + 1) * (good + 1) // (total + 2), low), high)
    spread = 12 * int(math.sqrt(drawn * (good / total) * (bad / total) * ((total - drawn) / max(1, total - 1))) + 2)
    up = np.arange(mode, min(high, mode + spread), dtype=np.float64)
    down = np.arange(mode, max(low, mode - spread), -1, dtype=np.float64)
    rise = np.cumprod((good - up) * (drawn - up) / ((up + 1) * (bad - drawn + up + 1)))
    fall = np.cumprod(down * (bad - drawn + down) / ((good - down + 1) * (drawn - down + 1)))
    weight = np.concatenate([fall[::-1], [1.0], rise])
    at = np.searchsorted(np.cumsum(weight), rng.random() * weight.sum(), "right")
    return mode - len(fall) + int(min(at, len(weight) - 1))


def split(rng: np.random.Generator, columns: np.ndarray, drawn: int) -> np.ndarray:
    """How many of each column's rows are among ``drawn`` of all, without replacement."""
    if int(columns.sum()) < SMALL:
        return rng.multivariate_hypergeometric(columns, drawn, method="marginals")
    out, rest = np.zeros(len(columns), np.int64), int(columns.sum())
    for i, size in enumerate(columns.tolist()):
        rest -= size
        out[i] = hypergeometric(rng, size, rest, drawn)
        drawn -= int(out[i])
    return out


def matrix_row(before: np.ndarray, cells: np.ndarray, block: int, seed: int) -> np.ndarray:
    """Rows that ``block`` sends to each cell. ``before``: rows before each block
    and, at the end, all rows; ``cells``: size of each cell."""
    low, high, columns = 0, len(before) - 1, cells
    while high - low > 1:
        middle = (low + high) // 2
        left = split(np.random.default_rng([seed, 0, low, high]), columns, int(before[middle] - before[low]))
        if block < middle:
            high, columns = middle, left
        else:
            low, columns = middle, columns - left
    return columns


def block_cells(before: np.ndarray, cells: np.ndarray, block: int, seed: int) -> np.ndarray:
    """Cell of each row of a block: its matrix row in a random order."""
    row = matrix_row(before, cells, block, seed)
    return np.random.default_rng([seed, 1, block]).permutation(np.repeat(np.arange(len(cells), dtype=np.int32), row))


def cell_sizes(rows: int, shards: int, tasks: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shard, first slot, size) of every cell; a shard has enough cells for
    CELL_ROWS rows each, and all shards together about ``tasks``, never an empty one."""
    shard, first, size = [], [], []
    for s, n in enumerate(even_sizes(rows, shards).tolist()):
        own = even_sizes(n, max(1, min(n, max(-(-n // CELL_ROWS), -(-tasks // shards)))))
        shard.append(np.full(len(own), s))
        first.append(np.cumsum(own) - own)
        size.append(own)
    return np.concatenate(shard), np.concatenate(first), np.concatenate(size)


PLACE = T.StructType([T.StructField("cell", T.IntegerType(), False), T.StructField("shard", T.IntegerType(), False),
                      T.StructField("first", T.LongType(), False)])


class _Deal:
    """Cells of rows by (file, row number), with the block at hand kept per worker."""

    def __init__(self, files: np.ndarray, rows: np.ndarray, cells: np.ndarray, seed: int):
        self.block_rows = BLOCK_ROWS
        blocks = -(-rows // self.block_rows)
        self.files, self.first, self.cells, self.seed = files, np.cumsum(blocks) - blocks, cells, seed
        sizes = [min(BLOCK_ROWS, n - at) for n in rows.tolist() for at in range(0, n, BLOCK_ROWS)]
        self.before = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])

    def __call__(self, file: np.ndarray, row: np.ndarray, kept: dict[int, np.ndarray]) -> np.ndarray:
        block = self.first[np.searchsorted(self.files, file)] + row // self.block_rows
        out = np.zeros(len(row), np.int32)
        for b in np.unique(block).tolist():
            if b not in kept:
                kept.clear()
                kept[b] = block_cells(self.before, self.cells, b, self.seed)
            mine = block == b
            out[mine] = kept[b][row[mine] % self.block_rows]
        return out


def _counts(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(hash, rows) of every file, by hash; one small row per file comes to the driver."""
    found = rows.groupBy("__file").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("__path").alias("paths")).collect()
    if any(r["paths"] > 1 for r in found):
        raise ValueError("two file paths have the same 64-bit hash")
    found.sort(key=lambda r: r["__file"])
    return np.array([r["__file"] for r in found], np.int64), np.array([r["n"] for r in found], np.int64)


def shuffled(stored: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``row`` (a struct of all columns), ``shard`` and ``slot`` of every row of a
    plain Parquet table, each cell in the order of its slots.

    ``stored`` must be the table as read, one row per stored row; ``shuffle`` takes any rows."""
    spark = session(stored)
    place = stored.select(F.struct(*[F.col(f"`{c}`") for c in stored.columns]).alias("row"), F.col("_metadata.file_path").alias("__path"),
                          F.col("_metadata.row_index").alias("__at")).withColumn("__file", F.xxhash64("__path"))
    files, counts = _counts(place.select("__file", "__path"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shard, first, size = cell_sizes(int(counts.sum()), shards, tasks)
    deal = spark.sparkContext.broadcast(_Deal(files, counts, size, seed))  # two numbers a file, one a block and a cell
    kept: dict[int, np.ndarray] = {}

    @F.arrow_udf(returnType=PLACE)
    def place_of(file: pa.Array, at: pa.Array) -> pa.Array:
        cell = deal.value(file.to_numpy(zero_copy_only=False), at.to_numpy(zero_copy_only=False), kept)
        return pa.StructArray.from_arrays([pa.array(cell), pa.array(shard[cell], pa.int32()), pa.array(first[cell], pa.int64())], names=PLACE.fieldNames())

    dealt = place.withColumn("__to", place_of("__file", "__at")).select("row", "__file", "__at", "__to.*")
    keyed = dealt.withColumn("__key", F.xxhash64(F.lit(seed), "cell", "__file", "__at"))
    exchanged = keyed.repartitionById(len(size), F.col("cell"))
    order = Window.partitionBy("shard", "cell").orderBy("__key", "__file", "__at")
    return exchanged.select("row", "shard", (F.col("first") + F.row_number().over(order) - 1).alias("slot"))


def write_shards(stored: DataFrame, path: str, shards: int = SHARDS, seed: int = SEED) -> None:
    """Write ``row`` and ``slot`` below ``path/shard=<n>``, each file in the order of its slots."""
    (shuffled(stored, shards, seed).write.option("compression", "zstd").partitionBy("shard").parquet(path))


def shuffle(docs: DataFrame, path: str, shards: int = SHARDS, seed: int = SEED) -> None:
    """``write_shards`` for rows of any source: they are written once to be numbered."""
    session(docs)
    write_shards(written(docs, "unsharded"), path, shards, seed)


def read_shards(spark, path: str, schema: T.StructType) -> DataFrame:
    """``row``, ``slot`` and ``shard`` of written shards; ``schema`` is that of the rows."""
    return spark.read.schema(T.StructType([T.StructField("row", schema), T.StructField("slot", T.LongType()), T.StructField("shard", T.IntegerType())])).parquet(path)


def shard_report(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every row, from written shards.

    ``docs`` must be a stored Parquet table as read."""
    spark = session(docs)
    path = shared(spark, "shards")
    write_shards(docs, path)
    rows = read_shards(spark, path, docs.schema)
    text = F.col("row.text")
    return rows.select(F.col("row.doc_id").alias("doc_id"), (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
                       F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"))
