"""Reconciliation by log coordinates.

Every offset of the log must arrive exactly once, as a table row or as a dead
letter. Log and deliveries are counted per (partition, offset) in one shuffle,
and what is out of order is reported as ranges of offsets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .running import ranges


def reconcile_offsets(log: DataFrame, delivered: DataFrame, chunk: int = 1 << 16) -> DataFrame:
    """(partition, kind, first, last, records) for ranges of offsets of these kinds:

    ``log``: offsets that the log holds; a log without gaps has one range per partition;
    ``missing``: in the log and never delivered; ``duplicate``: delivered more than
    once; ``unknown``: delivered and not in the log. Both inputs have ``partition``
    and ``offset``; rows without an offset are ignored."""
    flags = lambda df, here: df.select("partition", "offset", F.lit(here).alias("in_log"), F.lit(1 - here).alias("sent"))
    counts = (flags(log, 1).unionByName(flags(delivered, 0)).filter("offset IS NOT NULL").groupBy("partition", "offset")
              .agg(F.max("in_log").alias("in_log"), F.sum("sent").alias("sent")))
    kinds = F.array_compact(F.array(
        F.when(F.col("in_log") == 1, F.lit("log")).otherwise(F.lit("unknown")),
        F.when((F.col("in_log") == 1) & (F.col("sent") == 0), F.lit("missing")),
        F.when(F.col("sent") > 1, F.lit("duplicate"))))
    found = ranges(counts.select("partition", "offset", F.explode(kinds).alias("kind")), ["partition", "kind"], "offset", chunk)
    return found.select("partition", "kind", "first", "last", (F.col("last") - F.col("first") + 1).alias("records"))
