"""Keyed upsert (T2) and corrections.

Latest-wins on ``(device_id, ts)``: the record with the highest log offset
replaces earlier ones, including within one commit. One device always maps to
one log partition, so its offsets are its arrival order. The whole winning row
is kept with ``max_by(struct(...), offset)`` - a partial/final aggregate, so
the shuffle carries at most one row per key and map task; a NULL firmware in
the winning record is preserved.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.log import replay_first

DEFAULT_TEMP_OFFSET = 2.0  # recalibration offset of the corrections tool


def latest_by_key(df: DataFrame, key: Sequence[str] = ("device_id", "ts"),
                  order_col: str = "offset") -> DataFrame:
    """One row per key: the row with the largest ``order_col``."""
    key = list(key)
    others = [c for c in df.columns if c not in key]
    winner = F.max_by(F.struct(*[F.col(c) for c in others]), F.col(order_col)).alias("_w")
    return df.groupBy(*key).agg(winner).select(*key, *[F.col(f"_w.{c}").alias(c) for c in others])


def make_corrections(log: DataFrame, count: int, temp_offset: float = DEFAULT_TEMP_OFFSET,
                     offset_col: str = "offset") -> DataFrame:
    """Correction records (T6): the first ``count`` records of the log again, same
    key and ts, temperature plus ``temp_offset``, firmware omitted (so NULL after
    the upsert), at new offsets after the last one of the whole log."""
    end = log.agg((F.max(offset_col) + 1).alias("_end"))  # one row
    return (replay_first(log, count).join(end)
            .withColumn("temperature_c", F.col("temperature_c") + F.lit(temp_offset))
            .withColumn("firmware_version", F.lit(None).cast("string"))
            .withColumn(offset_col, F.col(offset_col) + F.col("_end")).drop("_end"))
