"""Small shared helpers for operators."""

from __future__ import annotations

from pyspark.sql import DataFrame


def materialize_small(df: DataFrame) -> DataFrame:
    """Cut the lineage of a small derived table by writing it to the shared
    checkpoint folder (survives executor loss, unlike a local cache). Joins with
    it carry no hint: its measured size decides the plan."""
    from ..session import warehouse_root

    warehouse_root(df.sparkSession)  # ensures a checkpoint dir is registered
    return df.checkpoint(eager=True)
