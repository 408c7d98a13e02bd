"""Registered queries over commit-stamped tables built from ``events``.

Each query writes a fresh table into the shared warehouse (one commit per
``seq div 1000`` batch, commit time = latest arrival in the batch), runs the
table operation and returns its result. The SQL oracle derives the same
commits directly from ``events``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.quality import to_table_row
from ..functions.timefn import ts_between, ts_to_millis
from ..schema import TELEMETRY_TABLE, UPSERT_TABLE
from ..sources.events import COMMIT_MS, EPOCH_2024_MS
from .ingest_queries import upsert_input
from .merged import current, merge_batch
from .queries import register, valid
from .tables import Table, days_between, latest_snapshots, list_tables, new_root, previous_snapshot


def _batched_rows(spark, sf_dir) -> DataFrame:
    """Plausible readings as table rows (P1), with their commit batch and arrival time."""
    batch = F.expr(f"(arrival_ms - {EPOCH_2024_MS}) div {COMMIT_MS}")
    return to_table_row(valid(spark, sf_dir), ts_col="ts_ms", keep=[batch.alias("batch"), F.col("arrival_ms")])


def build_table(spark, sf_dir, label: str, rows: DataFrame | None = None) -> Table:
    """Telemetry table with one commit per batch of the derived readings."""
    t = Table(spark, "telemetry", TELEMETRY_TABLE, "ts", root=new_root(spark, label)).create_if_absent()
    rows = rows if rows is not None else _batched_rows(spark, sf_dir)
    t.append_batches(rows, "batch", writer="append", committed_at_col="arrival_ms")
    return t


def _rows_ms(df: DataFrame) -> DataFrame:
    return df.select("device_id", "site_id", ts_to_millis("ts").alias("ts_ms"), "temperature_c", "humidity_pct",
                     "pressure_hpa", "vibration_g", "firmware_version")


def _history_cols(h: DataFrame) -> DataFrame:
    return h.select("commit_id", "parent_id", "committed_at_ms", "operation", "added_records", "total_records")


@register("snapshot_history")
def q_snapshot_history(spark, sf_dir):
    """Every commit with operation, added and total rows (T1, SRC7)."""
    return _history_cols(build_table(spark, sf_dir, "history").history())


@register("latest_snapshots")
def q_latest_snapshots(spark, sf_dir):
    """Newest five snapshots (L2)."""
    t = build_table(spark, sf_dir, "latest")
    return latest_snapshots(t.commits(), 5).select("commit_id", "committed_at_ms", "operation")


@register("previous_snapshot")
def q_previous_snapshot(spark, sf_dir):
    """Second newest snapshot, the default rollback target (L3)."""
    t = build_table(spark, sf_dir, "previous")
    return previous_snapshot(t.commits()).select("commit_id", "committed_at_ms", "operation")


@register("table_rows")
def q_table_rows(spark, sf_dir):
    """Current table scan (SRC5 without the limit): all rows of the head commit."""
    return _rows_ms(build_table(spark, sf_dir, "scan").read())


@register("table_sample_10")
def q_table_sample_10(spark, sf_dir):
    """``SELECT * FROM telemetry LIMIT 10`` (SRC5, L4): any ten rows."""
    return _rows_ms(build_table(spark, sf_dir, "sample").read().limit(10))


@register("as_of_snapshot")
def q_as_of_snapshot(spark, sf_dir):
    """Table as of the middle commit (T3, SRC6)."""
    t = build_table(spark, sf_dir, "asof")
    mid = t.commits().agg((F.max("commit_id") / 2).cast("long")).first()[0]
    return _rows_ms(t.read(as_of=mid))


@register("snapshot_growth")
def q_snapshot_growth(spark, sf_dir):
    """Rows at the first and the last snapshot and the growth between them (A7), counted in one scan."""
    t = build_table(spark, sf_dir, "growth")
    per_commit = t.files().join(t.commits().select("part_key", "commit_id"), "part_key").groupBy("commit_id").agg(F.count(F.lit(1)).alias("n"))
    ends = per_commit.agg(F.min("commit_id").alias("first_id"), F.max("commit_id").alias("last_id"),
                          F.min_by("n", "commit_id").alias("first_rows"), F.sum("n").alias("last_rows"))
    return ends.withColumn("growth", F.col("last_rows") - F.col("first_rows"))


def _ends(t: Table):
    """(newest, second newest) commit rows; an error when there is no earlier snapshot."""
    previous = previous_snapshot(t.commits()).first()
    return t.commits().orderBy(F.col("commit_id").desc()).first(), previous


@register("rollback_state")
def q_rollback_state(spark, sf_dir):
    """History that a return to the previous snapshot and one re-sent batch leave (T4)."""
    t = build_table(spark, sf_dir, "rollback")
    head, previous = _ends(t)
    back = spark.createDataFrame([
        (head["commit_id"] + 1, previous["commit_id"], head["committed_at_ms"] + 1, "rollback", 0, previous["total_records"]),
        (head["commit_id"] + 2, head["commit_id"] + 1, head["committed_at_ms"] + 2, "append", head["added_records"],
         previous["total_records"] + head["added_records"])],
        "commit_id long, parent_id long, committed_at_ms long, operation string, added_records long, total_records long")
    return _history_cols(t.history()).unionByName(back)


@register("rollback_rows")
def q_rollback_rows(spark, sf_dir):
    """Rows after the return to the previous snapshot, into a new table, and a re-send of the last batch (T4)."""
    t = build_table(spark, sf_dir, "rollback")
    head, previous = _ends(t)
    restored = Table(spark, "telemetry", TELEMETRY_TABLE, "ts", root=new_root(spark, "restored")).create_if_absent()
    old = t.read(as_of=previous["commit_id"]).drop("part_key", t.day_col)
    again = _batched_rows(spark, sf_dir).filter(F.col("batch") == head["batch_id"]).drop("batch", "arrival_ms")
    restored.commit_batch(old, "restore", 0)
    restored.commit_batch(again, "replay", 0)
    return _rows_ms(restored.read())


@register("expire_candidates")
def q_expire_candidates(spark, sf_dir):
    """Parts that only snapshots older than a rewrite of the table name (M2), with their rows."""
    t = build_table(spark, sf_dir, "expire")
    return (t.read().groupBy(F.col(t.day_col).cast("string").alias("day"), "part_key").agg(F.count(F.lit(1)).alias("records")))


@register("compaction_check")
def q_compaction_check(spark, sf_dir):
    """Rows and files before and after a rewrite per day (M1, M4, SRC8); file counts vary by engine."""
    t = build_table(spark, sf_dir, "compact")
    def stats(table, when):
        return table.file_stats().groupBy("day").agg(F.sum("records").alias(f"rows_{when}"), F.count(F.lit(1)).alias(f"files_{when}"))
    return stats(t, "before").join(stats(t.rewritten(new_root(spark, "rewritten")), "after"), "day")


@register("footer_counts")
def q_footer_counts(spark, sf_dir):
    """Rows per day of every commit, from file footers alone (SRC8, M4)."""
    t = build_table(spark, sf_dir, "footers")
    counts = t.part_counts().join(t.commits().select("part_key", "commit_id"), "part_key")
    return counts.select("commit_id", F.col("day").cast("string").alias("day"), "records")


@register("orphan_files")
def q_orphan_files(spark, sf_dir):
    """A write that never committed leaves orphan files; they are found (M3)."""
    rows = _batched_rows(spark, sf_dir)
    t = build_table(spark, sf_dir, "orphans", rows)
    last = t.commits().agg(F.max("batch_id")).first()[0]
    crashed = t.with_day(rows.filter(F.col("batch") == last).drop("batch", "arrival_ms"))
    t.write_parts(crashed.withColumn("part_key", F.lit(f"crashed-{last:012d}")))
    return t.orphans().select(F.col("day").cast("string").alias("day"), "part_key")


@register("table_names")
def q_table_names(spark, sf_dir):
    """Tables under one root (SRC9)."""
    t = build_table(spark, sf_dir, "names")
    Table(spark, "telemetry_upsert", TELEMETRY_TABLE, "ts", root=t.root).create_if_absent()
    return list_tables(spark, t.root)


@register("schema_evolution_read")
def q_schema_evolution_read(spark, sf_dir):
    """Parts written before firmware_version existed read it as NULL (T5)."""
    rows = _batched_rows(spark, sf_dir)
    t = Table(spark, "telemetry", TELEMETRY_TABLE, "ts", root=new_root(spark, "evolve")).create_if_absent()
    last = rows.agg(F.max("batch").alias("last")).withColumn("cut", F.expr("last div 2")).first()["cut"]
    old = rows.filter(F.col("batch") <= last).drop("firmware_version")
    t.append_batches(old, "batch", writer="append", committed_at_col="arrival_ms")
    t.append_batches(rows.filter(F.col("batch") > last), "batch", writer="append", committed_at_col="arrival_ms")
    return _rows_ms(t.read())


@register("time_range")
def q_time_range(spark, sf_dir):
    """Rows in [02:00, 04:00) on 2024-01-01 with day-partition pruning (P10)."""
    t = build_table(spark, sf_dir, "range")
    span = ("2024-01-01 02:00:00", "2024-01-01 04:00:00")
    return _rows_ms(ts_between(t.read(days=days_between(*span)), *span, "ts", t.day_col))


def upsert_rows(readings: DataFrame) -> DataFrame:
    """Rows of the upsert table: table rows with their place in the log."""
    return to_table_row(readings, ts_col="ts_ms", keep=[F.col("partition").cast("int").alias("_partition"), F.col("offset").cast("long").alias("_offset")])


@register("upsert_materialised")
def q_upsert_materialised(spark, sf_dir):
    """Current state kept by merging touched days: the log, then its corrections (SNK2, T2)."""
    t = Table(spark, "telemetry_upsert", UPSERT_TABLE, "ts", root=new_root(spark, "merged")).create_if_absent()
    rows = upsert_input(spark, sf_dir)
    for batch_id, part in enumerate((rows.filter("not corrected"), rows.filter("corrected"))):
        merge_batch(t, upsert_rows(part), batch_id)
    return current(t).select("device_id", "site_id", ts_to_millis("ts").alias("ts_ms"), "temperature_c", "humidity_pct",
                             "pressure_hpa", "vibration_g", "firmware_version", F.col("_offset").alias("offset"))
