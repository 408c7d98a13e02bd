"""Running values over long series, in two levels.

A plain window partitioned by a key sorts each key in one task, which a key
with a third of all rows does not survive. Here a key's axis (time, offsets) is
cut into chunks: chunks are worked on by themselves, one row per chunk is
accumulated over the key, and the chunk's rows take up what came before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _earlier(keys: Sequence[str], order: str):
    return Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def running_max(df: DataFrame, keys: Sequence[str], order: str, values: dict[str, str], chunk: int) -> DataFrame:
    """``df`` with, for each (column: name) of ``values``, the largest value of the
    column in the earlier rows of the same keys; NULL where there is none.

    ``order`` is an integer column without ties within the keys; ``chunk`` is the
    length of a chunk on it."""
    keys = list(keys)
    cut = df.withColumn("_chunk", F.floor(F.col(order) / F.lit(chunk)))
    own = cut.groupBy(*keys, "_chunk").agg(*[F.max(c).alias(f"_max_{c}") for c in values])
    before = own.select(*keys, "_chunk", *[F.max(f"_max_{c}").over(_earlier(keys, "_chunk")).alias(f"_before_{c}") for c in values])
    inside = _earlier([*keys, "_chunk"], order)
    out = cut.select("*", *[F.max(c).over(inside).alias(f"_inside_{c}") for c in values]).join(before, [*keys, "_chunk"])
    for c, name in values.items():
        out = out.withColumn(name, F.greatest(f"_inside_{c}", f"_before_{c}"))
    return out.drop("_chunk", *[f"_{p}_{c}" for p in ("before", "inside") for c in values])


def previous(df: DataFrame, keys: Sequence[str], order: str, value: str, name: str, chunk: int) -> DataFrame:
    """``df`` with the value of the row before it in the same keys, NULL for the first one.

    ``order`` is an integer column without ties within the keys."""
    keys = list(keys)
    cut = df.withColumn("_chunk", F.floor(F.col(order) / F.lit(chunk)))
    ends = cut.groupBy(*keys, "_chunk").agg(F.max_by(value, order).alias("_end"))
    carried = ends.select(*keys, "_chunk", F.lag("_end").over(Window.partitionBy(*keys).orderBy("_chunk")).alias("_carried"))
    inside = Window.partitionBy(*keys, "_chunk").orderBy(order)
    told = cut.withColumn("_inside", F.lag(value).over(inside)).withColumn("_first", F.row_number().over(inside) == 1).join(carried, [*keys, "_chunk"])
    return told.withColumn(name, F.when(F.col("_first"), F.col("_carried")).otherwise(F.col("_inside"))).drop("_chunk", "_inside", "_first", "_carried")


def numbered(df: DataFrame, keys: Sequence[str], order: str, name: str, chunk: int) -> DataFrame:
    """``df`` with the place of each row among the rows of its keys, from 0, by ``order``
    (an integer column without ties within the keys)."""
    keys = list(keys)
    cut = df.withColumn("_chunk", F.floor(F.col(order) / F.lit(chunk)))
    own = cut.groupBy(*keys, "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    before = own.select(*keys, "_chunk", F.coalesce(F.sum("_n").over(_earlier(keys, "_chunk")), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy(*keys, "_chunk").orderBy(order)) - 1
    return (cut.withColumn("_place", place).join(before, [*keys, "_chunk"])
            .withColumn(name, (F.col("_before") + F.col("_place")).cast("long")).drop("_chunk", "_place", "_before"))


def _islands(df: DataFrame, keys: list[str], start: str, end: Column) -> DataFrame:
    """Rows (start, end) merged where one begins just after another ends."""
    w = Window.partitionBy(*keys).orderBy(start)
    marked = df.withColumn("_new", F.when(F.col(start) == F.lag(end).over(w) + 1, 0).otherwise(1))
    return (marked.withColumn("_island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
            .groupBy(*keys, "_island").agg(F.min(start).alias("first"), F.max(end).alias("last")).drop("_island"))


def ranges(df: DataFrame, keys: Sequence[str], position: str, chunk: int) -> DataFrame:
    """(keys, first, last) of every maximal run of consecutive positions; repeated rows count once.

    Runs are found within chunks and then merged over their ends, so that a
    key's work is divided and what is sorted per key is a row for each run of a chunk."""
    keys = list(keys)
    cut = df.select(*keys, F.col(position).cast("long").alias("_at"), F.floor(F.col(position) / F.lit(chunk)).alias("_chunk")).distinct()
    parts = _islands(cut, [*keys, "_chunk"], "_at", F.col("_at"))
    return _islands(parts.select(*keys, F.col("first").alias("_first"), F.col("last").alias("_last")), keys, "_first", F.col("_last"))
