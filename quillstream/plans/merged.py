"""Materialised keyed upsert by touched day (SNK2, T2).

A merge reads the current rows of the days that a batch touches, keeps the
latest record per key, and commits these days anew; other days are not read or
written. The current state of a day is its part of the newest commit that wrote
it, whoever wrote it. A merge is published only after the commit that it read:
of two merges that read the same commit the later one starts again from the
other's result. Merging a batch again changes nothing, as the record with the
largest offset wins.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.upsert import latest_by_key
from .tables import CommitConflict, Table

#: Merges that may come in between before one gives up.
ATTEMPTS = 20


def current(table: Table, as_of: int | None = None, days: Collection[str] | None = None) -> DataFrame:
    """Rows of each day's newest part, as of a commit (default the newest), of some days or all."""
    commits = table.commits().select("part_key", "commit_id")
    if as_of is not None:
        commits = commits.filter(F.col("commit_id") <= as_of)
    parts = table.files(days).select(table.day_col, "part_key").distinct().join(commits, "part_key")
    newest = parts.groupBy(table.day_col).agg(F.max_by("part_key", "commit_id").alias("part_key"))
    return table.files(days).join(newest, [table.day_col, "part_key"], "left_semi")


def merge_batch(table: Table, rows: DataFrame, batch_id: int, writer: str = "merge",
                key: Sequence[str] = ("device_id", "ts"), order_col: str = "_offset") -> bool:
    """Merge one batch; False when the writer merged it before. A writer that counts
    its batches from zero again (a new checkpoint) needs a new name."""
    table.create_if_absent()
    days = [str(r[0]) for r in table.with_day(rows).select(table.day_col).distinct().collect()]  # days of one batch
    for attempt in range(ATTEMPTS):
        if table.committed(writer, batch_id):
            return False
        head = table.head()
        old = current(table, -1 if head[0] is None else head[0], days).select(*table.schema.fieldNames())
        merged = latest_by_key(old.unionByName(rows), key=key, order_col=order_col)
        try:
            return table.commit_batch(merged, writer=writer, batch_id=batch_id, after=head)
        except CommitConflict:
            if attempt + 1 == ATTEMPTS:
                raise
    return False
