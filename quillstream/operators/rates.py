"""Rates of sampled counters that may restart (F8, MET2): ``rate(x[range])`` and ``sum by``.

A counter is known by samples (series, time, value). The increase between two
neighbouring samples is their difference, or the later value where it fell, as
the counter then began again at zero. At an evaluation time the samples of the
range behind it (its left end excluded) give the increase, which is carried on
to the ends of the range: up to an end that is nearer than 1.1 mean distances of
samples, else by half such a distance, and never to before the counter was zero.
Fewer than two samples give no rate.

Neighbouring samples are found within chunks of time; a chunk's first sample
takes the last one before it from a table of a row per chunk, so that a long
series is no single group. The rest is one aggregation with partial sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .running import previous

SCRAPE_MS = 15_000
RANGE_MS = 60_000
#: time per chunk of a series
CHUNK_MS = 24 * 3_600_000


def increases(samples: DataFrame, series: list[str], time_col: str = "sample_ms", value_col: str = "value", chunk_ms: int = CHUNK_MS) -> DataFrame:
    """``samples`` with ``increase`` since the sample before; 0 for a series' first sample."""
    grown = F.col(value_col) - F.col("_before")
    told = previous(samples, series, time_col, value_col, "_before", chunk_ms)
    return told.withColumn("increase", F.when(F.col("_before").isNull(), 0).when(grown >= 0, grown).otherwise(F.col(value_col))).drop("_before")


def sampled_rate(samples: DataFrame, *series: str, time_col: str = "sample_ms", value_col: str = "value",
                 scrape_ms: int = SCRAPE_MS, range_ms: int = RANGE_MS, chunk_ms: int = CHUNK_MS) -> DataFrame:
    """(series, scrape_ms, increase, rate_per_sec) at every multiple of ``scrape_ms`` with two samples in range.

    ``increase`` is that between the samples, ``rate_per_sec`` carries it on to the whole range."""
    names = list(series)
    rows = increases(samples, names, time_col, value_col, chunk_ms).select(*names, F.col(time_col).alias("t"), F.col(value_col).alias("v"), "increase")
    first_scrape = F.ceil(F.col("t") / F.lit(scrape_ms))
    last_scrape = F.ceil((F.col("t") + range_ms) / F.lit(scrape_ms)) - 1
    seen = rows.withColumn("_k", F.explode(F.sequence(first_scrape, last_scrape))).withColumn("scrape_ms", F.col("_k") * scrape_ms)
    agg = seen.groupBy(*names, "scrape_ms").agg(
        F.count(F.lit(1)).alias("n"), F.min("t").alias("t0"), F.max("t").alias("t1"), F.sum("increase").alias("all"),
        F.min_by(F.struct("v", "increase"), "t").alias("first")).filter("n > 1")
    agg = agg.select(*names, "scrape_ms", "n", "t0", "t1", (F.col("all") - F.col("first.increase")).alias("increase"), F.col("first.v").alias("v0"))
    sampled = (F.col("t1") - F.col("t0")) / F.lit(1000.0)
    mean = sampled / (F.col("n") - 1)
    near = lambda gap: F.when(gap < 1.1 * mean, gap).otherwise(mean / 2)
    to_start = near((F.col("t0") - F.col("scrape_ms") + range_ms) / F.lit(1000.0))
    to_end = near((F.col("scrape_ms") - F.col("t1")) / F.lit(1000.0))
    to_zero = F.when(F.col("increase") > 0, sampled * F.col("v0") / F.col("increase"))
    whole = F.col("increase") * (sampled + F.least(to_start, to_zero) + to_end) / sampled
    return agg.select(*names, "scrape_ms", "increase", (whole / F.lit(range_ms / 1000.0)).alias("rate_per_sec"))
