"""Equivalent SQL for each query, over the given tables only."""

from __future__ import annotations

_VE = """
ve AS (
  SELECT *, ['mobile', 'device', 'sensor'][event_id % 3 + 1] AS event_source,
         'V' || user_id AS vehicle_id, ts AS event_time,
         CAST(value AS VARCHAR) AS event_value, event_type AS note,
         CASE WHEN event_id % 3 = 1 THEN props::JSON ->> '$.k' END AS boot_time,
         strftime(ts, '%Y-%m-%d') AS day,
         CAST(ts AS DATE) + CAST(CASE WHEN event_id % 10 = 0 THEN 1
                                      WHEN event_id % 97 = 0 THEN 3 ELSE 0 END AS INTEGER) AS arrived
  FROM events
)"""

_STATUS_FILES = """
status_files AS (
  SELECT o_orderkey // 2000 AS chunk, CAST(CAST(max(o_orderdate) AS DATE) AS VARCHAR) AS date,
         count(*) AS rows
  FROM orders GROUP BY 1
)"""

# A status arrives with its file, whose stamp is the day of its newest report.
_VS = """
vs AS (
  SELECT 'V' || o_custkey AS vehicle_id, o_orderdate AS report_time, o_orderstatus AS status,
         o_orderpriority AS status_source, f.date AS date
  FROM orders o JOIN status_files f ON f.chunk = o.o_orderkey // 2000
)"""

_FN = """
fn AS (
  SELECT event_id, ts, CASE event_id % 8
    WHEN 0 THEN 'vehicles_events_' || strftime(ts, '%Y%m%d%H%M%S') || '.json'
    WHEN 1 THEN 'vehicle_events_' || strftime(ts, '%Y%m%d%H%M%S') || '.json'
    WHEN 2 THEN 'vehicles_status_' || strftime(ts, '%Y%m%d%H%M%S') || '.json'
    WHEN 3 THEN 'vehicle_status_' || strftime(ts, '%Y%m%d%H%M%S') || '.json'
    WHEN 4 THEN 'VEHICLES_EVENTS_' || strftime(ts, '%Y%m%d%H%M%S') || '.JSON'
    WHEN 5 THEN 'backup_vehicle_events_final.json'
    WHEN 6 THEN 'vehicles_events_latest.json'
    ELSE 'trips_' || strftime(ts, '%Y%m%d%H%M%S') || '.json' END AS fn
  FROM events
),
named AS (
  SELECT *, regexp_extract(lower(fn), '^([a-z_]+)_\\d{14}\\.json$', 1) AS prefix,
         regexp_extract(fn, '(\\d{14})', 1) AS stamp
  FROM fn
),
strict AS (
  SELECT *, CASE WHEN regexp_replace(prefix, '^vehicles_', 'vehicle_')
                      IN ('vehicle_events', 'vehicle_status')
                 THEN regexp_replace(prefix, '^vehicles_', 'vehicle_') END AS strict_type
  FROM named
),
typed AS (
  SELECT *, CASE WHEN strict_type IS NOT NULL THEN strict_type
                 WHEN contains(lower(fn), 'vehicle_events') THEN 'vehicle_events'
                 WHEN contains(lower(fn), 'vehicle_status') THEN 'vehicle_status'
                 ELSE 'unknown' END AS file_type,
         CASE WHEN strict_type IS NOT NULL THEN 'strict'
              WHEN contains(lower(fn), 'vehicle_events') OR contains(lower(fn), 'vehicle_status')
              THEN 'fallback' ELSE 'none' END AS match_kind
  FROM strict
)"""

# Each event with the reason its record is refused, and the state of the file it came in.
_TAGGED = """
tagged AS (
  SELECT CAST(arrived AS VARCHAR) AS date, event_id // 2000 AS chunk,
         CASE CAST(arrived AS VARCHAR)
           WHEN '2024-01-10' THEN 'corrupt_json'
           WHEN '2024-01-11' THEN 'missing_root_key'
           WHEN '2024-01-12' THEN 'bad_stamp' END AS file_reason,
         CASE WHEN value >= 1 AND value < 3 THEN 'null_required'
              WHEN value > 200 THEN 'null_required'
              WHEN value < 1 THEN 'bad_timestamp'
              ELSE 'ok' END AS record_reason,
         CASE WHEN value >= 1 AND value < 3 THEN 'vehicle_id'
              WHEN value > 200 THEN 'event_source'
              WHEN value < 1 THEN 'not a time' END AS record_detail
  FROM ve
),
refused AS (
  SELECT DISTINCT date, chunk, file_reason AS reason, NULL AS detail FROM tagged
  WHERE file_reason IS NOT NULL
  UNION ALL
  SELECT date, chunk, record_reason, record_detail FROM tagged WHERE file_reason IS NULL
)"""

_SUMMARY_COLUMNS = "vehicle_id, day, event_time AS last_event_time, event_type AS last_event_type"


def _last(columns: str, source: str = "ve", where: str = "true") -> str:
    return f"""
SELECT {columns} FROM (
  SELECT *, row_number() OVER (PARTITION BY vehicle_id, day
                               ORDER BY event_time DESC, event_id DESC) AS rn
  FROM {source} WHERE {where}
) WHERE rn = 1"""


_DAY = """arrived IN (DATE '2024-01-15', DATE '2024-01-16')
    AND event_time >= TIMESTAMP '2024-01-15 00:00:00'
    AND event_time < TIMESTAMP '2024-01-16 00:00:00'"""

_RANGE = """event_time >= TIMESTAMP '2024-01-05 00:00:00'
    AND event_time < TIMESTAMP '2024-01-13 00:00:00'"""

_ROWS_PER_DATE = "SELECT CAST(arrived AS VARCHAR) AS date, count(*) AS rows FROM ve GROUP BY 1"

_ALL_SUMMARIES = f"WITH {_VE} {_last(_SUMMARY_COLUMNS)}"

_DAY_SUMMARY = f"""WITH {_VE} {_last(
    _SUMMARY_COLUMNS, where=_DAY + " AND event_time >= TIMESTAMP '2024-01-14 01:00:00'"
)}"""

_REJECT_REASONS = f"""WITH {_VE}, {_TAGGED}
    SELECT reason, detail, count(*) AS rows FROM refused WHERE reason <> 'ok' GROUP BY 1, 2"""

ORACLE: dict[str, str] = {
    "daily_summary": _DAY_SUMMARY,
    "last_event_per_vehicle_day": f"WITH {_VE} {_last(_SUMMARY_COLUMNS + ', event_id')}",
    "backfill_daily_summary": f"WITH {_VE} {_last(_SUMMARY_COLUMNS, where=_RANGE)}",
    "backfill_with_lookback": f"""WITH {_VE} {_last(
        _SUMMARY_COLUMNS, where=_RANGE + " AND arrived < CAST(ts AS DATE) + 2"
    )}""",
    "event_day": f"WITH {_VE} SELECT event_id, day FROM ve",
    "late_window_filter": f"""WITH {_VE} SELECT event_id, event_time FROM ve
        WHERE {_DAY} AND event_time >= TIMESTAMP '2024-01-17 06:00:00' - INTERVAL 48 HOURS""",
    "scan_date_partitions": f"""WITH {_VE} SELECT * FROM ({_ROWS_PER_DATE})
        WHERE date IN ('2024-01-15', '2024-01-16', '2024-03-01')""",
    "classify_files": f"WITH {_FN} SELECT event_id, fn, file_type, match_kind FROM typed",
    "group_files_by_type": f"WITH {_FN} SELECT file_type, count(*) AS files FROM typed GROUP BY 1",
    "partition_date_from_name": f"""WITH {_FN} SELECT event_id,
        CASE WHEN stamp = '' THEN '2024-01-31'
             ELSE substr(stamp, 1, 4) || '-' || substr(stamp, 5, 2) || '-' || substr(stamp, 7, 2)
        END AS date FROM typed""",
    "list_incoming_files": f"""WITH {_VE}, {_STATUS_FILES}
        SELECT 'vehicle_events' AS file_type, CAST(arrived AS VARCHAR) AS date,
               count(DISTINCT event_id // 2000) AS files FROM ve GROUP BY 2
        UNION ALL SELECT 'vehicle_status', date, count(*) FROM status_files GROUP BY 2""",
    "unnest_envelope": f"""WITH {_VE} SELECT vehicle_id, event_time, event_source, event_type,
        event_value, note, boot_time, CAST(arrived AS VARCHAR) AS date FROM ve""",
    "envelope_root_key_alias": f"""WITH {_VE}
        SELECT CASE WHEN hour(ts) % 2 = 1 THEN 'vehicle_events' ELSE 'vehicles_events' END AS root_key,
               count(*) AS records FROM ve GROUP BY 1""",
    "required_columns_check": """
        SELECT 'vehicle_id' AS "column", count(user_id) > 0 AS present FROM events
        UNION ALL SELECT 'event_time', count(ts) > 0 FROM events
        UNION ALL SELECT 'event_source', false
        UNION ALL SELECT 'event_type', count(event_type) > 0 FROM events""",
    "null_counts": f"""WITH {_VE} SELECT
        count(*) FILTER (value >= 1 AND value < 3) AS vehicle_id,
        count(*) FILTER (event_time IS NULL) AS event_time,
        count(*) FILTER (value > 200) AS event_source,
        count(*) FILTER (event_type IS NULL) AS event_type FROM ve""",
    "parse_event_time": f"""WITH {_VE}
        SELECT event_id, CASE WHEN value >= 1 THEN event_time END AS event_time FROM ve""",
    "quarantine_records": f"""WITH {_VE}, {_TAGGED}
        SELECT reason, count(*) AS rows FROM refused GROUP BY 1""",
    "reject_reasons": _REJECT_REASONS,
    "append_partitioned_events": f"WITH {_VE} {_ROWS_PER_DATE}",
    "ingest_files": f"""WITH {_VE}, {_STATUS_FILES}
        SELECT 'vehicle_events' AS file_type, * FROM ({_ROWS_PER_DATE})
        UNION ALL SELECT 'vehicle_status', date, CAST(sum(rows) AS BIGINT) FROM status_files GROUP BY 2""",
    "ingest_new_files_only": f"""WITH {_FN} SELECT event_id, fn FROM typed t WHERE NOT EXISTS (
        SELECT 1 FROM typed l WHERE l.event_id = t.event_id AND l.ts < TIMESTAMP '2024-01-16 00:00:00')""",
    "summary_upsert": _ALL_SUMMARIES,
    "daily_summary_job": _DAY_SUMMARY,
    "event_time_sample": """SELECT event_id, ts AS event_time FROM events
        ORDER BY ts, event_id LIMIT 5""",
    "run_counters": f"""WITH {_VE}, {_TAGGED},
        per_file AS (
          SELECT date, chunk, count(*) FILTER (reason = 'ok') AS good,
                 count(*) FILTER (reason <> 'ok') AS bad FROM refused GROUP BY 1, 2
        )
        SELECT count(*) FILTER (failed = 0) AS batches_processed,
               CAST(sum(processed) AS BIGINT) AS total_processed,
               CAST(sum(failed) AS BIGINT) AS total_failed,
               (SELECT count(*) FROM refused WHERE reason IN
                 ('missing_root_key', 'null_required', 'bad_timestamp')) AS total_schema_errors,
               CAST(sum(good) AS BIGINT) AS rows_loaded, CAST(sum(bad) AS BIGINT) AS rows_rejected
        FROM (
          SELECT count(*) FILTER (good > 0) AS processed, count(*) FILTER (good = 0) AS failed,
                 sum(good) AS good, sum(bad) AS bad FROM per_file
        )""",
    "fail_batch_counters": f"""WITH {_VE}, {_TAGGED}
        SELECT CAST(0 AS BIGINT) AS batches_processed, CAST(0 AS BIGINT) AS total_processed,
               count(DISTINCT (date, chunk)) AS total_failed,
               count(*) FILTER (reason IN ('missing_root_key', 'null_required', 'bad_timestamp'))
                 AS total_schema_errors,
               CAST(0 AS BIGINT) AS rows_loaded, count(*) FILTER (reason <> 'ok') AS rows_rejected
        FROM refused""",
    "vehicle_events_view": f"""WITH {_VE} SELECT vehicle_id, event_time, event_type, event_source,
        event_value, note, CAST(boot_time AS INTEGER) AS boot_time,
        CAST(arrived AS VARCHAR) AS date FROM ve""",
    "vehicle_status_view": f"WITH {_STATUS_FILES}, {_VS} SELECT vehicle_id, report_time, status, status_source, date FROM vs",
    "daily_summary_for_day": f"SELECT * FROM ({_ALL_SUMMARIES}) WHERE day = '2024-01-15'",
    "catalog_listing": """
        SELECT 'raw_data' AS table_schema, 'vehicle_events' AS table_name, count(*) AS rows FROM events
        UNION ALL SELECT 'raw_data', 'vehicle_status', count(*) FROM orders
        UNION ALL SELECT 'reports', 'daily_summary', count(*)
        FROM (SELECT DISTINCT user_id, CAST(ts AS DATE) FROM events)""",
    "table_definitions": """
        SELECT 'raw_tables' AS table_schema, 'vehicle_events' AS table_name, count(*) AS rows FROM events
        UNION ALL SELECT 'raw_tables', 'vehicle_status', count(*) FROM orders
        UNION ALL SELECT 'report_tables', 'daily_summary', count(*)
        FROM (SELECT DISTINCT user_id, CAST(ts AS DATE) FROM events)""",
    "stream_ingest": f"WITH {_VE} {_ROWS_PER_DATE}",
    "stream_rejects": _REJECT_REASONS,
    "stream_daily_summary": _ALL_SUMMARIES,
    "ingest_redelivered_name": f"WITH {_VE} SELECT date, 2 * rows AS rows FROM ({_ROWS_PER_DATE})",
    "list_incoming_incremental": f"""WITH {_VE} SELECT 'vehicle_events' AS file_type, CAST(arrived AS VARCHAR) AS date,
        count(DISTINCT event_id // 2000) AS files FROM ve WHERE arrived > DATE '2024-01-15' GROUP BY 2""",
    "records_accounted_for": f"""WITH {_VE}, {_TAGGED} SELECT
        (SELECT count(*) FROM events) - (SELECT count(*) FROM tagged WHERE file_reason IS NOT NULL)
          - count(*) FILTER (detail IS NOT NULL) AS records_loaded,
        count(*) FILTER (detail IS NOT NULL) AS records_refused,
        count(*) FILTER (detail IS NULL) AS files_refused FROM refused WHERE reason <> 'ok'""",
    "schema_drift": f"""WITH {_VE}, new AS (
          SELECT arrived, 'driver' AS field, 'string' AS type FROM ve
          UNION ALL SELECT arrived, 'speed', 'number' FROM ve WHERE event_type = 'view'
          UNION ALL SELECT arrived, 'gear', 'integer' FROM ve WHERE event_source = 'device'
          UNION ALL SELECT arrived, 'position', 'object' FROM ve WHERE event_source = 'sensor'
        )
        SELECT CAST(arrived AS VARCHAR) AS date, field, type, count(*) AS records, count(*) AS kept FROM new GROUP BY ALL""",
    "replay_rejects": f"""WITH {_VE}, {_TAGGED}
        SELECT date, record_reason = 'ok' AS known, count(*) AS rows FROM tagged
        WHERE file_reason IS NULL AND (record_reason = 'ok' OR record_detail = 'event_source') GROUP BY ALL""",
    "unknown_file_rejects": f"""WITH {_VE} SELECT 'unknown_type' AS reason, 'failed' AS state,
        count(DISTINCT (arrived, event_id // 2000)) AS files FROM ve""",
    "no_events_reasons": f"""WITH {_VE} SELECT 'no table' AS "case", 'no_events' AS status, 'no_partitions' AS reason, 0 AS sample
        UNION ALL SELECT 'before all', 'no_events', CASE WHEN count(*) = 0 THEN 'no_partitions' ELSE 'outside_window' END, least(5, count(*))
          FROM ve WHERE arrived IN (DATE '2023-01-15', DATE '2023-01-16')
        UNION ALL SELECT 'after all', 'no_events', CASE WHEN count(*) = 0 THEN 'no_partitions' ELSE 'outside_window' END, least(5, count(*))
          FROM ve WHERE arrived IN (DATE '2024-02-02', DATE '2024-02-03')""",
    "stream_tie_break": f"""WITH {_VE} SELECT vehicle_id, day, hour AS last_event_time, event_type AS last_event_type FROM (
        SELECT *, row_number() OVER (PARTITION BY vehicle_id, day ORDER BY hour DESC, event_source DESC, event_type DESC) AS rn
        FROM (SELECT *, CAST(date_trunc('hour', event_time) AS TIMESTAMP) AS hour FROM ve)) WHERE rn = 1""",
    "stream_ingest_mixed_folder": f"WITH {_VE} {_ROWS_PER_DATE}",
    "envelope_encodings": f"WITH {_VE} {_ROWS_PER_DATE}",
}
ORACLE["fail_batch_any_size"] = ORACLE["fail_batch_counters"]
ORACLE["ingest_after_crash"] = ORACLE["view_before_first_load"] = ORACLE["append_partitioned_events"]
ORACLE["backfill_job"] = ORACLE["backfill_daily_summary"]
ORACLE["summary_over_streamed_table"] = ORACLE["daily_summary_job"]
