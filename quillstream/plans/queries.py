"""The registered queries, name to builder ``(spark, sf_dir) -> DataFrame``, and what
several of them start from. Imports no module of queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.quality import classify, plausible, reject_field
from ..operators.windows import classify_late
from ..sources.events import batch_of, telemetry_view

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


# ---------------------------------------------------------------- shared parts

def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every reading with ``stage``/``reject_reason``/``reject_field``."""
    return classify(telemetry_view(spark, sf_dir), ts_col="ts_ms").withColumn("reject_field", reject_field(ts_col="ts_ms"))


def valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plausible readings only (boolean gate, no reason text built)."""
    return telemetry_view(spark, sf_dir).filter(plausible(ts_col="ts_ms"))


def late_flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid readings with the W6 late flag; the watermark is computed from
    every decoded reading (it is attached before the gate)."""
    every = telemetry_view(spark, sf_dir).withColumn("batch_id", F.expr(batch_of()))
    return classify_late(every.filter(plausible(ts_col="ts_ms")), "batch_id", "ts_ms", watermark_source=every)


#: Decimals of averages in query results: the last bits of a sum depend on the
#: order of its terms, so the comparison rounds results, never readings.
DECIMALS = 9
