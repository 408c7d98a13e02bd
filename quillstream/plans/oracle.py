"""DuckDB SQL for each registered query (the independent oracle).

Every statement starts from the pre-registered ``events`` view and re-derives
the telemetry readings with the same fixed rule as ``sources.events``. These
strings are hand-written SQL, not generated from the Spark plans.
"""

from __future__ import annotations

from ..functions.quality import RANGE_RULES
from ..sources.events import CORRECTIONS, DUCKDB_VIEW


def _reason_sql() -> str:
    parts = ["WHEN coalesce(device_id, '') = '' THEN 'empty device_id'",
             "WHEN ts_ms <= 0 THEN 'non-positive ts: ' || CAST(ts_ms AS VARCHAR)"]
    for f, lo, hi in RANGE_RULES:
        parts.append(f"WHEN NOT isfinite({f}) THEN '{f} not finite: ' || CAST({f} AS VARCHAR)")
        parts.append(f"WHEN {f} < {lo} OR {f} > {hi} THEN "
                     f"'{f} out of range [{lo!r}, {hi!r}]: ' || CAST({f} AS VARCHAR)")
    return "CASE " + " ".join(parts) + " END"


def _field_sql() -> str:
    parts = ["WHEN coalesce(device_id, '') = '' THEN 'device_id'", "WHEN ts_ms <= 0 THEN 'ts'"]
    for f, lo, hi in RANGE_RULES:
        parts.append(f"WHEN NOT isfinite({f}) OR {f} < {lo} OR {f} > {hi} THEN '{f}'")
    return "CASE " + " ".join(parts) + " END"


BASE = f"""WITH {DUCKDB_VIEW},
cls AS (SELECT *, {_reason_sql()} AS reject_reason, {_field_sql()} AS reject_field FROM tv),
v AS (SELECT * FROM cls WHERE reject_reason IS NULL)"""

# Per-batch watermark (max event time of all earlier batches - 5 s) over all
# decoded rows, and the late flag of each valid row.
LATE_CTES = """,
b AS (SELECT *, arrival_ms // 30000 AS batch_id FROM cls),
m AS (SELECT batch_id, max(ts_ms) AS bmax FROM b GROUP BY batch_id),
wm AS (SELECT batch_id, max(bmax) OVER (ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 5000
              AS watermark_ms FROM m),
lv AS (SELECT b.*, wm.watermark_ms, (b.ts_ms // 60000 + 1) * 60000 AS window_end_ms,
              coalesce((b.ts_ms // 60000 + 1) * 60000 <= wm.watermark_ms, false) AS is_late
       FROM b LEFT JOIN wm USING (batch_id) WHERE b.reject_reason IS NULL)"""


def _win_stats(src: str) -> str:
    return f"""SELECT device_id,
       ts_ms - ts_ms % 60000 AS window_start_ms,
       ts_ms - ts_ms % 60000 + 60000 AS window_end_ms,
       count(*) AS reading_count,
       round(avg(temperature_c), 9) AS avg_temperature_c,
       min(temperature_c) AS min_temperature_c,
       max(temperature_c) AS max_temperature_c,
       round(avg(humidity_pct), 9) AS avg_humidity_pct,
       round(avg(pressure_hpa), 9) AS avg_pressure_hpa
FROM {src}
GROUP BY device_id, ts_ms - ts_ms % 60000"""


SQL: dict[str, str] = {}

SQL["window_1m_device"] = BASE + "\n" + _win_stats("v")

SQL["telemetry_rows"] = BASE + """
SELECT device_id, site_id, ts_ms, temperature_c, humidity_pct, pressure_hpa, vibration_g, firmware_version FROM v"""

SQL["quality_route"] = BASE + """
SELECT seq, device_id, coalesce(CASE WHEN reject_reason IS NOT NULL THEN 'validate' END, 'table') AS route,
       reject_field, reject_reason
FROM cls"""

SQL["quality_reason_counts"] = BASE + """
SELECT CASE WHEN reject_reason IS NOT NULL THEN 'validate' ELSE 'table' END AS route,
       coalesce(reject_field, '') AS reject_field, count(*) AS records
FROM cls GROUP BY ALL"""

SQL["quality_counters"] = BASE + """
SELECT count(*) FILTER (WHERE reject_reason IS NULL) AS records_valid,
       CAST(0 AS BIGINT) AS records_parse_failed,
       count(*) FILTER (WHERE reject_reason IS NOT NULL) AS records_validation_failed
FROM cls"""

SQL["late_events"] = BASE + LATE_CTES + """
SELECT seq, device_id, ts_ms AS event_ts, batch_id, watermark_ms, window_end_ms FROM lv WHERE is_late"""

SQL["window_1m_on_time"] = BASE + LATE_CTES + "\n" + _win_stats("(SELECT * FROM lv WHERE NOT is_late)")

SQL["dead_letters"] = BASE + LATE_CTES + """
SELECT 'validate' AS stage, device_id, reject_reason AS reason, CAST(NULL AS BIGINT) AS payload_len,
       CAST(NULL AS BIGINT) AS event_ts, reject_field AS reason_field
FROM cls WHERE reject_reason IS NOT NULL
UNION ALL
SELECT 'late', device_id, NULL, NULL, ts_ms, NULL FROM lv WHERE is_late"""

SQL["dlq_triage"] = BASE + LATE_CTES + """
SELECT stage, reason_field, count(*) AS records FROM (
  SELECT 'validate' AS stage, reject_field AS reason_field FROM cls WHERE reject_reason IS NOT NULL
  UNION ALL SELECT 'late', '' FROM lv WHERE is_late) GROUP BY ALL"""

SQL["total_rows"] = BASE + "\nSELECT count(*) AS total_rows FROM v"

SQL["count_by_device"] = BASE + "\nSELECT device_id, count(*) AS readings FROM v GROUP BY device_id"

SQL["device_stats"] = BASE + """
SELECT device_id, count(*) AS readings,
       round(avg(temperature_c), 2) AS avg_temp,
       round(min(temperature_c), 2) AS min_temp,
       round(max(temperature_c), 2) AS max_temp
FROM v GROUP BY device_id ORDER BY device_id"""

SQL["latest_10"] = BASE + """
SELECT device_id, ts_ms, temperature_c, humidity_pct, firmware_version
FROM v ORDER BY ts_ms DESC, device_id, seq LIMIT 10"""

# --- ingest side ------------------------------------------------------------------

_CORRUPT = """CASE WHEN seq % 73 = 0 THEN 'null' WHEN seq % 79 = 0 THEN 'header'
                   WHEN seq % 83 = 0 THEN 'body' WHEN seq % 89 = 0 THEN 'short' END"""

SQL["decode_wire"] = BASE + f""",
w AS (SELECT *, {_CORRUPT} AS damage FROM cls)
SELECT seq,
       CASE WHEN damage IS NOT NULL THEN 'deserialize' WHEN reject_reason IS NOT NULL THEN 'validate'
            ELSE 'table' END AS route,
       CASE WHEN damage IN ('null', 'short') THEN 'null payload or too short'
            WHEN damage = 'header' THEN 'null' WHEN damage = 'body' THEN 'corrupt'
            ELSE reject_reason END AS reason,
       CAST(CASE damage WHEN 'null' THEN 0 WHEN 'short' THEN 5 WHEN 'header' THEN 6 WHEN 'body' THEN 8 END
            AS BIGINT) AS payload_len,
       CASE WHEN damage IS NULL THEN device_id END AS device_id,
       CASE WHEN damage IS NULL THEN ts_ms END AS ts_ms,
       CASE WHEN damage IS NULL THEN temperature_c END AS temperature_c,
       CASE WHEN damage IS NULL THEN humidity_pct END AS humidity_pct,
       CASE WHEN damage IS NULL THEN pressure_hpa END AS pressure_hpa,
       CASE WHEN damage IS NULL THEN vibration_g END AS vibration_g,
       CASE WHEN damage IS NULL THEN firmware_version END AS firmware_version
FROM w"""

SQL["wire_counters"] = BASE + f""",
w AS (SELECT *, {_CORRUPT} AS damage FROM cls)
SELECT count(*) FILTER (WHERE damage IS NULL AND reject_reason IS NULL) AS records_valid,
       count(*) FILTER (WHERE damage IS NOT NULL) AS records_parse_failed,
       count(*) FILTER (WHERE damage IS NULL AND reject_reason IS NOT NULL) AS records_validation_failed
FROM w"""

SQL["encode_roundtrip"] = BASE + """
SELECT seq, true AS decoded, device_id, site_id, ts_ms, temperature_c, humidity_pct, pressure_hpa, vibration_g,
       firmware_version
FROM tv"""

_BRIDGE_OK = ("NOT (seq % 101 = 0 OR seq % 103 = 1 OR seq % 107 = 2 OR seq % 109 = 2 OR seq % 113 = 2"
              " OR seq % 131 = 2)")

SQL["json_normalise"] = BASE + f"""
SELECT seq, {_BRIDGE_OK} AS parse_ok,
       CASE WHEN {_BRIDGE_OK} THEN device_id END AS device_id,
       CASE WHEN {_BRIDGE_OK} THEN site_id END AS site_id,
       CASE WHEN {_BRIDGE_OK} THEN ts_ms END AS ts_ms,
       CASE WHEN {_BRIDGE_OK} THEN CASE WHEN seq % 127 = 2 THEN 1.0 ELSE temperature_c END END AS temperature_c,
       CASE WHEN {_BRIDGE_OK} THEN humidity_pct END AS humidity_pct,
       CASE WHEN {_BRIDGE_OK} THEN pressure_hpa END AS pressure_hpa,
       CASE WHEN {_BRIDGE_OK} THEN vibration_g END AS vibration_g,
       CASE WHEN {_BRIDGE_OK} THEN coalesce(firmware_version, '') END AS firmware_version
FROM tv"""

SQL["bridge_counts"] = BASE + f"""
SELECT count(*) FILTER (WHERE {_BRIDGE_OK}) AS forwarded, count(*) FILTER (WHERE NOT ({_BRIDGE_OK})) AS errors
FROM tv"""

SQL["topic_filter"] = BASE + """
SELECT seq, site_id AS topic_site, device_id AS topic_device FROM tv
WHERE NOT (seq % 17 = 0 OR seq % 19 = 0 OR seq % 23 = 0)"""

_CORR = f"""corr AS (SELECT seq, "partition", "offset" + (SELECT max("offset") + 1 FROM tv) AS "offset", device_id, site_id, ts_ms,
                      temperature_c + 2.0 AS temperature_c, humidity_pct, pressure_hpa, vibration_g,
                      CAST(NULL AS VARCHAR) AS firmware_version, arrival_ms
               FROM (SELECT * FROM tv ORDER BY "partition", "offset" LIMIT {CORRECTIONS}))"""

SQL["corrections"] = BASE + f""",
{_CORR}
SELECT seq, "offset", device_id, ts_ms, temperature_c, firmware_version FROM corr"""

_UPSERT = BASE + f""",
{_CORR},
u AS (SELECT * FROM (SELECT seq, "partition", "offset", device_id, site_id, ts_ms, temperature_c, humidity_pct,
                            pressure_hpa, vibration_g, firmware_version, arrival_ms FROM tv
                     UNION ALL SELECT * FROM corr)
      WHERE device_id <> '' AND ts_ms > 0
        AND isfinite(temperature_c) AND temperature_c BETWEEN -60.0 AND 150.0
        AND isfinite(humidity_pct) AND humidity_pct BETWEEN 0.0 AND 100.0
        AND isfinite(pressure_hpa) AND pressure_hpa BETWEEN 800.0 AND 1100.0
        AND isfinite(vibration_g) AND vibration_g BETWEEN 0.0 AND 50.0),
cur AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY device_id, ts_ms ORDER BY "offset" DESC) = 1)"""

SQL["upsert_current"] = _UPSERT + """
SELECT device_id, site_id, ts_ms, temperature_c, humidity_pct, pressure_hpa, vibration_g, firmware_version, "offset"
FROM cur"""

SQL["upsert_materialised"] = SQL["upsert_current"]

SQL["upsert_summary"] = _UPSERT + """
SELECT count(*) AS current_rows, count(*) FILTER (WHERE "offset" > (SELECT max("offset") FROM tv)) AS corrected_rows,
       count(*) FILTER (WHERE firmware_version IS NULL) AS null_firmware_rows
FROM cur"""

SQL["replay_first_10"] = BASE + """
SELECT "partition", "offset", device_id, ts_ms FROM tv ORDER BY "partition", "offset" LIMIT 10"""

# --- commit-stamped tables ------------------------------------------------------------

_COMMITS = BASE + """,
cb AS (SELECT (arrival_ms - 1704067200000) // 3600000 AS batch, count(*) AS added_records, max(arrival_ms) AS committed_at_ms
       FROM v GROUP BY 1),
h AS (SELECT CAST(dense_rank() OVER (ORDER BY batch) - 1 AS BIGINT) AS commit_id, batch, added_records,
             committed_at_ms FROM cb),
hist AS (SELECT commit_id, CASE WHEN commit_id = 0 THEN NULL ELSE commit_id - 1 END AS parent_id,
                committed_at_ms, 'append' AS operation, added_records,
                CAST(sum(added_records) OVER (ORDER BY commit_id) AS BIGINT) AS total_records, batch
         FROM h),
vb AS (SELECT v.*, h.commit_id, h.batch FROM v JOIN h ON (v.arrival_ms - 1704067200000) // 3600000 = h.batch)"""

_ROWS = "device_id, site_id, ts_ms, temperature_c, humidity_pct, pressure_hpa, vibration_g, firmware_version"

SQL["snapshot_history"] = _COMMITS + """
SELECT commit_id, parent_id, committed_at_ms, operation, added_records, total_records FROM hist"""

SQL["latest_snapshots"] = _COMMITS + """
SELECT commit_id, committed_at_ms, operation FROM hist ORDER BY committed_at_ms DESC, commit_id DESC LIMIT 5"""

SQL["previous_snapshot"] = _COMMITS + """
SELECT commit_id, committed_at_ms, operation FROM hist ORDER BY committed_at_ms DESC, commit_id DESC
LIMIT 1 OFFSET 1"""

SQL["table_rows"] = _COMMITS + f"\nSELECT {_ROWS} FROM vb"

SQL["as_of_snapshot"] = _COMMITS + f"""
SELECT {_ROWS} FROM vb WHERE commit_id <= (SELECT max(commit_id) // 2 FROM hist)"""

SQL["snapshot_growth"] = _COMMITS + """
SELECT min(commit_id) AS first_id, max(commit_id) AS last_id,
       CAST(min(total_records) AS BIGINT) AS first_rows, CAST(max(total_records) AS BIGINT) AS last_rows,
       CAST(max(total_records) - min(total_records) AS BIGINT) AS growth
FROM hist"""

_ROLLBACK = _COMMITS + """,
hd AS (SELECT * FROM hist ORDER BY commit_id DESC LIMIT 1),
pv AS (SELECT * FROM hist ORDER BY committed_at_ms DESC, commit_id DESC LIMIT 1 OFFSET 1),
rb AS (SELECT hd.commit_id + 1 AS commit_id, pv.commit_id AS parent_id, hd.committed_at_ms + 1 AS committed_at_ms,
              'rollback' AS operation, CAST(0 AS BIGINT) AS added_records, pv.total_records
       FROM hd, pv),
rp AS (SELECT hd.commit_id + 2 AS commit_id, hd.commit_id + 1 AS parent_id, hd.committed_at_ms + 2 AS committed_at_ms,
              'append' AS operation, hd.added_records, pv.total_records + hd.added_records AS total_records
       FROM hd, pv)"""

SQL["rollback_state"] = _ROLLBACK + """
SELECT commit_id, parent_id, committed_at_ms, operation, added_records, total_records FROM hist
UNION ALL SELECT * FROM rb
UNION ALL SELECT * FROM rp"""

SQL["rollback_rows"] = _ROLLBACK + f"""
SELECT {_ROWS} FROM vb WHERE commit_id <= (SELECT commit_id FROM pv) OR batch = (SELECT batch FROM hd)"""

_DAY = "CAST(CAST(make_timestamp(ts_ms * 1000) AS DATE) AS VARCHAR)"

SQL["expire_candidates"] = _COMMITS + f"""
SELECT {_DAY} AS day, 'append-' || lpad(CAST(batch AS VARCHAR), 12, '0') AS part_key, count(*) AS records
FROM vb GROUP BY ALL"""

SQL["orphan_files"] = _COMMITS + f"""
SELECT DISTINCT {_DAY} AS day, 'crashed-' || lpad(CAST(batch AS VARCHAR), 12, '0') AS part_key
FROM vb WHERE batch = (SELECT max(batch) FROM hist)"""

SQL["schema_evolution_read"] = _COMMITS + """
SELECT device_id, site_id, ts_ms, temperature_c, humidity_pct, pressure_hpa, vibration_g,
       CASE WHEN batch <= (SELECT max(batch) // 2 FROM hist) THEN NULL ELSE firmware_version END AS firmware_version
FROM vb"""

SQL["table_names"] = """
SELECT unnest(['telemetry', 'telemetry_upsert']) AS "tableName" FROM (SELECT count(*) FROM events)"""

SQL["time_range"] = _COMMITS + f"""
SELECT {_ROWS} FROM vb WHERE ts_ms >= 1704074400000 AND ts_ms < 1704081600000"""

# --- streaming jobs over the replayed log (one micro-batch per arrival hour) -----------

_STREAM = BASE + f""",
w AS (SELECT *, {_CORRUPT} AS damage,
             (arrival_ms - 1704067200000) // 3600000 AS sbatch FROM cls),
sw AS (SELECT *, CASE WHEN damage IS NULL THEN ts_ms ELSE arrival_ms END AS event_ms FROM w),
sm AS (SELECT sbatch, max(event_ms) AS bmax FROM sw GROUP BY sbatch),
swm AS (SELECT sbatch, max(bmax) OVER (ORDER BY sbatch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 5000
               AS watermark_ms FROM sm),
sv AS (SELECT sw.*, (sw.ts_ms // 60000 + 1) * 60000 AS window_end_ms,
              coalesce((sw.ts_ms // 60000 + 1) * 60000 <= swm.watermark_ms, false) AS is_late
       FROM sw LEFT JOIN swm USING (sbatch) WHERE sw.damage IS NULL AND sw.reject_reason IS NULL),
final_wm AS (SELECT max(event_ms) - 5000 AS wm FROM sw)"""

SQL["stream_append"] = _STREAM + f"\nSELECT {_ROWS} FROM sv"

SQL["stream_dead_letters"] = _STREAM + """
SELECT 'deserialize' AS stage, CAST(NULL AS VARCHAR) AS device_id,
       CAST(CASE damage WHEN 'null' THEN 0 WHEN 'short' THEN 5 WHEN 'header' THEN 6 WHEN 'body' THEN 8 END AS BIGINT)
         AS payload_len,
       CASE WHEN damage = 'header' THEN NULL ELSE '' END AS reason_field
FROM sw WHERE damage IS NOT NULL
UNION ALL
SELECT 'validate', device_id, NULL, reject_field FROM sw WHERE damage IS NULL AND reject_reason IS NOT NULL"""

SQL["stream_window"] = _STREAM + "\n" + _win_stats(
    "(SELECT * FROM sv WHERE NOT is_late AND window_end_ms <= (SELECT wm FROM final_wm))")

SQL["stream_window_dead_letters"] = _STREAM + """
SELECT 'deserialize' AS stage, CAST(NULL AS VARCHAR) AS device_id, CAST(NULL AS BIGINT) AS event_ts,
       CAST(CASE damage WHEN 'null' THEN 0 WHEN 'short' THEN 5 WHEN 'header' THEN 6 WHEN 'body' THEN 8 END AS BIGINT)
         AS payload_len,
       CASE WHEN damage = 'header' THEN NULL ELSE '' END AS reason_field
FROM sw WHERE damage IS NOT NULL
UNION ALL
SELECT 'validate', device_id, NULL, NULL, reject_field FROM sw WHERE damage IS NULL AND reject_reason IS NOT NULL
UNION ALL
SELECT 'late', device_id, ts_ms, NULL, NULL FROM sv WHERE is_late"""

SQL["stream_upsert"] = _STREAM + f""",
{_CORR},
su AS (SELECT * FROM (SELECT "offset", device_id, site_id, ts_ms, temperature_c, humidity_pct, pressure_hpa,
                             vibration_g, firmware_version FROM sw WHERE damage IS NULL
                      UNION ALL SELECT "offset", device_id, site_id, ts_ms, temperature_c, humidity_pct,
                             pressure_hpa, vibration_g, firmware_version FROM corr)
       WHERE device_id <> '' AND ts_ms > 0
         AND isfinite(temperature_c) AND temperature_c BETWEEN -60.0 AND 150.0
         AND isfinite(humidity_pct) AND humidity_pct BETWEEN 0.0 AND 100.0
         AND isfinite(pressure_hpa) AND pressure_hpa BETWEEN 800.0 AND 1100.0
         AND isfinite(vibration_g) AND vibration_g BETWEEN 0.0 AND 50.0)
SELECT {_ROWS} FROM su
QUALIFY row_number() OVER (PARTITION BY device_id, ts_ms ORDER BY "offset" DESC) = 1"""

SQL["reconcile"] = _STREAM + """
SELECT count(*) AS log_records,
       count(*) FILTER (WHERE damage IS NULL AND reject_reason IS NULL) AS table_rows,
       count(*) FILTER (WHERE damage IS NULL AND reject_reason IS NULL) AS snapshot_total,
       count(*) FILTER (WHERE damage IS NOT NULL OR reject_reason IS NOT NULL) AS dead_letters,
       true AS balanced
FROM sw"""

_COUNTS = """count(*) AS input_rows,
       count(*) FILTER (WHERE damage IS NULL AND reject_reason IS NULL) AS records_valid,
       count(*) FILTER (WHERE damage IS NOT NULL) AS records_parse_failed,
       count(*) FILTER (WHERE damage IS NULL AND reject_reason IS NOT NULL) AS records_validation_failed"""

# the upsert job also sees the corrections, in a batch of their own
SQL["stream_progress"] = _STREAM + f""",
{_CORR.replace("temperature_c + 2.0 AS temperature_c", "temperature_c + 2.0 AS temperature_c, device_id = '' OR ts_ms <= 0 AS bad_key")},
cc AS (SELECT count(*) AS n, count(*) FILTER (WHERE NOT bad_key
        AND isfinite(temperature_c) AND temperature_c BETWEEN -60.0 AND 150.0 AND isfinite(humidity_pct) AND humidity_pct BETWEEN 0.0 AND 100.0
        AND isfinite(pressure_hpa) AND pressure_hpa BETWEEN 800.0 AND 1100.0 AND isfinite(vibration_g) AND vibration_g BETWEEN 0.0 AND 50.0) AS ok
       FROM corr),
base AS (SELECT count(DISTINCT sbatch) AS input_batches, {_COUNTS} FROM sw)
SELECT 'append' AS query, * FROM base UNION ALL SELECT 'window', * FROM base
UNION ALL SELECT 'upsert', input_batches + 1, input_rows + n, records_valid + ok, records_parse_failed, records_validation_failed + n - ok
FROM base, cc"""

_RATES = BASE + """,
per AS (SELECT site_id, device_id, CAST(floor(ts_ms / 15000) AS BIGINT) AS bucket, count(*) AS n FROM tv GROUP BY ALL),
seen AS (SELECT site_id, device_id, (bucket + a) * 15000 AS scrape_ms, n FROM per, (SELECT unnest([1, 2, 3, 4]) AS a))"""

SQL["counter_rate"] = _RATES + """
SELECT device_id, scrape_ms, sum(n) / 60.0 AS rate_per_sec FROM seen GROUP BY ALL"""

SQL["counter_rate_by_site"] = _RATES + """
SELECT site_id, scrape_ms, round(sum(n) / 60.0, 9) AS rate_per_sec FROM seen GROUP BY ALL"""

# --- watermark per log partition ---------------------------------------------------------

# one look per micro-batch with rows, and one where a partition falls silent
_PARTITION_MARKS = BASE + """,
b AS (SELECT *, arrival_ms // 30000 AS batch_id FROM cls),
pb AS (SELECT batch_id, "partition" AS p, max(ts_ms) AS event, max(arrival_ms) AS arrival FROM b GROUP BY ALL),
lim AS (SELECT min(batch_id) AS lo, max(batch_id) AS hi FROM pb),
looks AS (SELECT x.batch_id, lim.lo FROM (
            SELECT batch_id FROM pb UNION SELECT (arrival + 60000) // 30000 + 1 FROM pb UNION SELECT (lo * 30000 + 60000) // 30000 + 1 FROM lim) x, lim
          WHERE x.batch_id <= lim.hi),
grid AS (SELECT batch_id, lo, p FROM looks, (VALUES (0), (1), (2)) AS v(p)),
seen AS (SELECT g.batch_id, g.lo, g.p, max(event) OVER w AS event, max(arrival) OVER w AS arrival
         FROM grid g LEFT JOIN pb ON pb.batch_id = g.batch_id AND pb.p = g.p
         WINDOW w AS (PARTITION BY g.p ORDER BY g.batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
states AS (SELECT batch_id, p, event - 5000 AS partition_ms, batch_id * 30000 - coalesce(arrival, lo * 30000) <= 60000 AS active FROM seen),
least_of AS (SELECT batch_id, CASE WHEN count(*) FILTER (WHERE active AND partition_ms IS NULL) = 0 THEN min(partition_ms) FILTER (WHERE active) END AS c
             FROM states GROUP BY batch_id),
marks AS (SELECT batch_id, max(c) OVER (ORDER BY batch_id) AS watermark_ms FROM least_of)"""

SQL["partition_watermarks"] = _PARTITION_MARKS + """
SELECT batch_id, p AS "partition", partition_ms, active, watermark_ms FROM states JOIN marks USING (batch_id)"""

SQL["late_events_by_partition"] = _PARTITION_MARKS + """
SELECT seq, device_id, ts_ms AS event_ts, batch_id, watermark_ms, (ts_ms // 60000 + 1) * 60000 AS window_end_ms
FROM b JOIN marks USING (batch_id) WHERE reject_reason IS NULL AND (ts_ms // 60000 + 1) * 60000 <= watermark_ms"""

SQL["stream_window_by_partition"] = _STREAM + """,
pb AS (SELECT sbatch, "partition" AS p, max(event_ms) AS event, max(arrival_ms) AS arrival FROM sw GROUP BY ALL),
grid AS (SELECT sbatch, p FROM (SELECT DISTINCT sbatch FROM sw), (VALUES (0), (1), (2)) AS v(p)),
seen AS (SELECT g.sbatch, g.p, 1704067200000 + g.sbatch * 3600000 AS now, max(event) OVER w AS event,
                coalesce(max(arrival) OVER w, 1704067200000 + (SELECT min(sbatch) FROM sw) * 3600000) AS since
         FROM grid g LEFT JOIN pb ON pb.sbatch = g.sbatch AND pb.p = g.p
         WINDOW w AS (PARTITION BY g.p ORDER BY g.sbatch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
least_of AS (SELECT sbatch, CASE WHEN count(*) FILTER (WHERE now - since <= 60000 AND event IS NULL) = 0
                                 THEN min(event - 5000) FILTER (WHERE now - since <= 60000) END AS c FROM seen GROUP BY sbatch),
pm AS (SELECT sbatch, max(c) OVER (ORDER BY sbatch) AS wm FROM least_of),
ok AS (SELECT sv.* FROM sv JOIN pm USING (sbatch)
       WHERE NOT coalesce(window_end_ms <= pm.wm, false) AND window_end_ms <= (SELECT max(wm) FROM pm))
""" + _win_stats("ok")

# --- offsets within each log partition -----------------------------------------------------

_OFFSETS = _STREAM + """,
ow AS (SELECT *, row_number() OVER (PARTITION BY "partition" ORDER BY "offset") - 1 AS place FROM sw),
n AS (SELECT "partition" AS p, count(*) AS n FROM ow GROUP BY 1)"""

SQL["stream_append_offsets"] = SQL["stream_append"]

SQL["consumer_lag"] = _OFFSETS + """
SELECT 'append_offsets' AS query, p AS "partition", least(n, 200) AS position, n AS log_end, n - least(n, 200) AS lag FROM n"""

SQL["offset_reconciliation"] = _OFFSETS + """,
twice AS (SELECT place, row_number() OVER (ORDER BY place) AS i FROM ow
          WHERE "partition" = 2 AND place BETWEEN 10 AND 29 AND damage IS NULL AND reject_reason IS NULL),
found AS (
  SELECT p AS "partition", 'log' AS kind, CAST(0 AS BIGINT) AS first, n - 1 AS last FROM n
  UNION ALL SELECT 1, 'missing', 40, least(59, n - 1) FROM n WHERE p = 1 AND n > 40
  UNION ALL SELECT 2, 'duplicate', min(place), max(place) FROM twice GROUP BY place - i)
SELECT "partition", kind, first, last, last - first + 1 AS records FROM found"""

# --- sampled counters ------------------------------------------------------------------------

_SAMPLED = BASE + """,
per AS (SELECT site_id, device_id, ts_ms // 15000 AS bucket, count(*) AS n FROM tv GROUP BY ALL),
every AS (SELECT site_id, device_id, unnest(range(min(bucket), max(bucket) + 1)) AS bucket FROM per GROUP BY site_id, device_id),
samples AS (SELECT site_id, device_id, (bucket + 1) * 15000 AS t,
                   sum(coalesce(n, 0)) OVER (PARTITION BY site_id, device_id, bucket * 15000 // 3600000 ORDER BY bucket) AS v
            FROM every LEFT JOIN per USING (site_id, device_id, bucket)),
kept AS (SELECT *, lag(v) OVER (PARTITION BY site_id, device_id ORDER BY t) AS pv FROM samples WHERE t // 15000 % 7 <> 0),
incs AS (SELECT *, CASE WHEN pv IS NULL THEN 0 WHEN v >= pv THEN v - pv ELSE v END AS inc FROM kept),
seen AS (SELECT *, t + 15000 * k AS scrape_ms FROM incs, (VALUES (0), (1), (2), (3)) AS o(k)),
agg AS (SELECT site_id, device_id, scrape_ms, count(*) AS n, min(t) AS t0, max(t) AS t1, (sum(inc) - min_by(inc, t))::BIGINT AS increase, min_by(v, t) AS v0
        FROM seen GROUP BY ALL HAVING count(*) > 1),
spans AS (SELECT *, (t1 - t0) / 1000.0 AS sampled, (t1 - t0) / 1000.0 / (n - 1) AS mean, (t0 - scrape_ms + 60000) / 1000.0 AS g0, (scrape_ms - t1) / 1000.0 AS g1 FROM agg),
rates AS (SELECT site_id, device_id, scrape_ms, increase,
                 increase * (sampled + least(CASE WHEN g0 < 1.1 * mean THEN g0 ELSE mean / 2 END, CASE WHEN increase > 0 THEN sampled * v0 / increase END)
                             + CASE WHEN g1 < 1.1 * mean THEN g1 ELSE mean / 2 END) / sampled / 60.0 AS r FROM spans)"""

SQL["sampled_rate"] = _SAMPLED + "\nSELECT site_id, device_id, scrape_ms, increase, round(r, 9) AS rate_per_sec FROM rates"

SQL["sampled_rate_by_site"] = _SAMPLED + """
SELECT site_id, scrape_ms, sum(increase)::BIGINT AS increase, round(sum(r), 9) AS rate_per_sec FROM rates GROUP BY ALL"""

# --- SQL text over the catalog -----------------------------------------------------------------

SQL["sql_total_rows"] = SQL["total_rows"]

SQL["sql_latest_10"] = BASE + """
SELECT device_id, ts_ms, temperature_c, humidity_pct, firmware_version
FROM v ORDER BY ts_ms DESC, device_id, temperature_c, pressure_hpa, vibration_g LIMIT 10"""

SQL["sql_device_stats"] = SQL["device_stats"]

SQL["sql_latest_snapshots"] = SQL["latest_snapshots"]

SQL["sql_sample_10"] = BASE + """
SELECT least(10, count(*)) AS sampled, least(10, count(*)) AS known FROM v"""

SQL["sql_rows_per_day"] = BASE + f"""
SELECT {_DAY} AS day, count(*) AS readings FROM v GROUP BY 1"""

SQL["catalog_tables"] = _UPSERT + """
SELECT 'telemetry' AS table_name, count(*) AS records, count(DISTINCT device_id) AS devices FROM v
UNION ALL SELECT 'telemetry_upsert', count(*), count(DISTINCT device_id) FROM u"""

# --- restarts and stored reports ---------------------------------------------------------------

SQL["stream_supervised"] = SQL["stream_append"]

SQL["stream_completed_batches"] = _STREAM + f""",
{_CORR},
base AS (SELECT count(DISTINCT sbatch) AS completed_batches, count(*) AS input_rows FROM sw)
SELECT 'append' AS query, * FROM base UNION ALL SELECT 'upsert', completed_batches + 1, input_rows + (SELECT count(*) FROM corr) FROM base"""

# rows are dropped under the watermark of the micro-batch before theirs
SQL["stream_window_native"] = _STREAM + """,
lwm AS (SELECT sbatch, max(bmax) OVER (ORDER BY sbatch ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING) - 5000 AS wm FROM sm),
ok AS (SELECT sv.* FROM sv JOIN lwm USING (sbatch)
       WHERE NOT coalesce(window_end_ms <= lwm.wm, false) AND window_end_ms <= (SELECT wm FROM final_wm))
""" + _win_stats("ok")

SQL["footer_counts"] = _COMMITS + f"""
SELECT commit_id, {_DAY} AS day, count(*) AS records FROM vb GROUP BY ALL"""

SQL["stream_keyed_log"] = _STREAM + """
SELECT device_id, row_number() OVER (PARTITION BY device_id ORDER BY sbatch, seq) - 1 AS place, seq FROM sw"""
