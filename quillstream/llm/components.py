"""Connected components of a link table, by alternating star steps.

Every step is a minimum per node (combined before the shuffle) and a join, so a
node with a third of all links is no group in one task. Nothing is collected;
each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstream.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the smallest node near it."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them; v < u in ``edges``."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) of every node of ``links``: the smallest node it reaches.

    A link of a node with itself, a repeated link and either direction are
    allowed; links with a null end are ignored."""
    edges = written(links.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    state = _state(edges)
    while state[0]:
        edges = written(_small_star(_large_star(edges)), "edges")
        after = _state(edges)
        if after == state:
            break
        state = after
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return written(edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots), "components")
