"""The same questions in SQL, answered by arithmetic on the ``events`` table.

No statement here parses a change event: which records are broken, late or
delivered twice follows from ``event_id`` alone.
"""

from __future__ import annotations

# Every record of the table with its fault number, arrival and raw text.
BASE = """
WITH base AS (
  SELECT event_id, event_id % 101 AS fault, ts,
         ts + to_seconds((event_id * 37) % 150) AS arrived,
         (event_id * 37) % 150 AS skew,
         'wiki' || (user_id % 6) AS wiki, event_type AS type,
         'page-' || regexp_extract(props, '([0-9]+)', 1) AS title,
         'u' || user_id AS "user",
         user_id % 10 = 0 AND event_id % 101 <> 7 AS bot,
         'evt-' || event_id AS meta_id,
         CASE WHEN event_id % 50 = 0 THEN 2 ELSE 1 END AS deliveries
  FROM events),
copies AS (SELECT b.*, unnest(range(deliveries)) AS copy FROM base b),
good AS (SELECT * FROM copies WHERE fault NOT IN (0, 1, 2, 3, 4, 5, 6, 8)),
bad AS (
  SELECT *,
    CASE fault
      WHEN 0 THEN 'invalid_json; ' WHEN 1 THEN 'invalid_json; ' ELSE '' END ||
    CASE fault
      WHEN 2 THEN 'missing_or_invalid_meta.id'
      WHEN 3 THEN 'missing_or_invalid_meta.dt'
      WHEN 4 THEN 'missing_or_invalid_wiki'
      WHEN 5 THEN 'missing_or_invalid_type'
      WHEN 6 THEN 'missing_or_invalid_wiki'
      ELSE 'missing_or_invalid_meta.id; missing_or_invalid_meta.dt; missing_or_invalid_wiki; missing_or_invalid_type'
    END AS reason
  FROM copies WHERE fault IN (0, 1, 2, 3, 4, 5, 6, 8)),
raw AS (
  SELECT *,
    CASE fault WHEN 0 THEN 'not json' WHEN 1 THEN '' WHEN 8 THEN '[]' ELSE
      '{"meta":{' || CASE fault WHEN 9 THEN '"origin":{"n":1},' ELSE '' END
      || '"id":' || CASE fault WHEN 2 THEN event_id::VARCHAR ELSE '"' || meta_id || '"' END
      || ',"dt":"' || CASE fault WHEN 3 THEN 'bad' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' END || '"}'
      || CASE fault WHEN 4 THEN '' WHEN 6 THEN ',"wiki":"  "' ELSE ',"wiki":"' || wiki || '"' END
      || ',"type":' || CASE fault WHEN 5 THEN '5' ELSE '"' || type || '"' END
      || ',"title":"' || title || '","user":"' || "user" || '"'
      || CASE fault WHEN 7 THEN '' ELSE ',"bot":' || bot::VARCHAR END
      || ',"server_name":"' || wiki || '.example.org"'
      || ',"ingested_at":"' || strftime(arrived, '%Y-%m-%dT%H:%M:%S.%f') || 'Z"}'
    END AS raw_json
  FROM copies),
once AS (SELECT * FROM good WHERE copy = 0),
newest AS (SELECT date_trunc('millisecond', max(ts)) AS newest_at FROM good),
edits AS (
  SELECT date_trunc('minute', ts) AS window_start,
         date_trunc('minute', ts) + INTERVAL 1 MINUTE AS window_end,
         wiki, count(*) AS edit_count
  FROM once GROUP BY ALL),
bots AS (
  SELECT date_trunc('minute', ts) AS window_start,
         date_trunc('minute', ts) + INTERVAL 1 MINUTE AS window_end,
         wiki, bot, count(*) AS edit_count
  FROM once GROUP BY ALL),
pages AS (
  SELECT time_bucket(INTERVAL 10 MINUTE, ts) AS window_start,
         time_bucket(INTERVAL 10 MINUTE, ts) + INTERVAL 10 MINUTE AS window_end,
         wiki, title, count(*) AS edit_count
  FROM once GROUP BY ALL),
late AS (
  SELECT date_trunc('minute', ts) AS window_start,
         date_trunc('minute', ts) + INTERVAL 1 MINUTE AS window_end,
         wiki, count(*) AS late_event_count
  FROM once WHERE skew > 120 GROUP BY ALL)
"""

_FACTS = """ts AS event_time, arrived AS ingested_at, wiki, type, title, "user", bot,
  wiki || '.example.org' AS server_name, meta_id"""

# What a stream with a given delay has emitted at the end of its input.
_SETTLED = "window_end <= (SELECT newest_at FROM newest) - INTERVAL {}"
_TWO = _SETTLED.format("2 MINUTE")
_HOUR = _SETTLED.format("1 HOUR")


def _q(body: str) -> str:
    return f"{BASE}\n{body}"


_PERCENTILES = """
, ranked AS (
  SELECT wiki, skew * 1000000 AS value,
         row_number() OVER (PARTITION BY wiki ORDER BY skew) AS nth,
         count(*) OVER (PARTITION BY wiki) AS event_count
  FROM once),
points AS (SELECT unnest([0.5::DOUBLE, 0.9::DOUBLE, 0.95::DOUBLE, 0.99::DOUBLE, 0.999::DOUBLE]) AS point)
SELECT wiki, point, min(value)::BIGINT AS value, max(event_count) AS event_count
FROM ranked, points
WHERE nth >= greatest(1, ceil(point * event_count::DOUBLE))
GROUP BY wiki, point
"""

_TOP = """
SELECT * FROM (
  SELECT *, row_number() OVER (
    PARTITION BY window_start, wiki ORDER BY edit_count DESC, title) AS rank
  FROM {}) WHERE rank <= {}
"""

_DAILY_PAGES = """
, daily AS (
  SELECT date_trunc('day', ts)::TIMESTAMP AS window_start,
         date_trunc('day', ts)::TIMESTAMP + INTERVAL 1 DAY AS window_end,
         wiki, title, count(*) AS edit_count
  FROM once GROUP BY ALL)
"""

_RATE = """
SELECT time_bucket(INTERVAL {n} SECOND, {time}) AS window_start,
       time_bucket(INTERVAL {n} SECOND, {time}) + INTERVAL {n} SECOND AS window_end,
       count(*) AS n, count(*)::DOUBLE / {n}.0::DOUBLE AS per_second
FROM {rows} GROUP BY ALL
"""

# Sessions of users: a gap of half an hour begins a new one.
_SESSIONS = """
, steps AS (
  SELECT "user", ts, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS begins
  FROM once WINDOW w AS (PARTITION BY "user" ORDER BY ts)),
numbered AS (SELECT *, sum(begins) OVER (PARTITION BY "user" ORDER BY ts) AS nth FROM steps),
sessions AS (
  SELECT min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, "user", count(*) AS event_count
  FROM numbered GROUP BY "user", nth)
SELECT * FROM sessions
"""

ORACLES: dict[str, str] = {
    "gate_accepted": _q(f"""
        SELECT {_FACTS}, raw_json FROM raw
        WHERE fault NOT IN (0, 1, 2, 3, 4, 5, 6, 8)"""),
    "gate_rejected_by_reason": _q("SELECT reason, count(*) AS row_count FROM bad GROUP BY reason"),
    "gate_matched_by_reason": _q("""
        SELECT reason, count(*) AS row_count FROM (
          SELECT reason FROM bad
          UNION ALL
          SELECT 'missing_or_invalid_meta.id' FROM good WHERE fault = 9)
        GROUP BY reason"""),
    "reject_envelope": _q("""
        SELECT json_object('reason', bad.reason, 'raw_json', raw.raw_json, 'ingested_at',
                 strftime(bad.arrived, '%Y-%m-%dT%H:%M:%S.%g') || 'Z')::VARCHAR AS value
        FROM bad JOIN raw USING (event_id, copy)"""),
    "feed_partition_counts": _q("""
        SELECT CASE WHEN fault IN (0, 1, 4, 8) THEN 'unknown'
                    WHEN fault = 6 THEN '  ' ELSE wiki END AS feed, count(*) AS row_count
        FROM copies GROUP BY 1"""),
    "dedup_events": _q(f"SELECT {_FACTS} FROM once"),
    "edits_per_minute": _q("SELECT * FROM edits"),
    "bot_vs_human_per_minute": _q("SELECT * FROM bots"),
    "page_edits_10min": _q("SELECT * FROM pages"),
    "late_per_minute": _q("SELECT * FROM late"),
    "top_pages_10min": _q(_TOP.format("pages", 3)),
    "top_pages_daily": _q(_DAILY_PAGES + _TOP.format("daily", 5)),
    "bot_share": _q("""
        SELECT window_start, window_end, wiki, sum(edit_count)::BIGINT AS edit_count,
               sum(CASE WHEN bot THEN edit_count ELSE 0 END)::DOUBLE
                 / sum(edit_count)::DOUBLE AS bot_share
        FROM bots GROUP BY ALL"""),
    "predicate_share": _q("""
        SELECT date_trunc('day', ts)::TIMESTAMP AS window_start,
               date_trunc('day', ts)::TIMESTAMP + INTERVAL 1 DAY AS window_end,
               wiki, count(*) AS event_count,
               count(*) FILTER (type = 'error') AS match_count,
               count(*) FILTER (type = 'error')::DOUBLE / count(*)::DOUBLE AS share
        FROM once GROUP BY ALL"""),
    "skew_percentiles": _q(_PERCENTILES),
    "table_counts": _q("""
        SELECT 'recentchange' AS table_name, count(*) AS row_count FROM once
        UNION ALL SELECT 'edits_per_minute_by_wiki', count(*) FROM edits
        UNION ALL SELECT 'bot_vs_human_per_minute', count(*) FROM bots
        UNION ALL SELECT 'top_pages_10min', count(*) FROM pages
        UNION ALL SELECT 'late_arrivals', count(*) FROM late"""),
    "gold_total": _q("""
        SELECT (SELECT count(*) FROM edits) + (SELECT count(*) FROM bots)
             + (SELECT count(*) FROM pages) + (SELECT count(*) FROM late) AS row_count"""),
    "table_growth": _q("""
        , daily AS (
          SELECT 'bronze' AS table_name, arrived::DATE AS day, count(*) AS n FROM good GROUP BY ALL
          UNION ALL
          SELECT 'rejects', arrived::DATE, count(*) FROM bad GROUP BY ALL),
        samples AS (
          SELECT table_name, (day + INTERVAL 1 DAY)::TIMESTAMP AS sampled_at,
                 (sum(n) OVER (PARTITION BY table_name ORDER BY day))::BIGINT AS row_count,
                 n FROM daily)
        SELECT table_name, sampled_at, row_count, row_count - n AS previous_count,
               n AS growth, n > 0 AS grew
        FROM samples WHERE row_count > n"""),
    "minimum_volume": _q("""
        SELECT least(count(*), 100) AS observed, count(*) >= 100 AS enough FROM copies"""),
    "duplicate_check": _q("""
        SELECT *, CASE WHEN total = distinct_ids THEN 'OK-NO-DUPLICATES'
                       ELSE 'DUPLICATES-FOUND' END AS verdict FROM (
          SELECT 'accepted' AS table_name, count(*) AS total,
                 count(DISTINCT meta_id) AS distinct_ids FROM good
          UNION ALL
          SELECT 'bronze', count(*), count(DISTINCT meta_id) FROM once)"""),
    "duplicated_keys": _q("""
        SELECT meta_id, count(*) AS copies FROM good GROUP BY meta_id HAVING count(*) > 1"""),
    "residual_duplicates": _q("""
        SELECT title, count(*) AS copies, min(ts) AS first_time, max(ts) AS last_time
        FROM once GROUP BY title
        HAVING count(*) > 1 AND max(ts) - min(ts) > INTERVAL 2 MINUTE"""),
    "stream_batches": _q("""
        , slices AS (
          SELECT ts, copy, CASE WHEN arrived < TIMESTAMP '2024-01-11' THEN 0
                 WHEN arrived < TIMESTAMP '2024-01-21' THEN 1 ELSE 2 END AS slice FROM good),
        marks AS (
          SELECT k.slice, date_trunc('millisecond', max(s.ts)) - INTERVAL 2 MINUTE AS mark
          FROM (SELECT DISTINCT slice FROM slices) k JOIN slices s
            ON s.slice + s.copy <= k.slice GROUP BY k.slice)
        SELECT (SELECT count(*) FROM once) AS bronze_rows, 5 AS data_batches,
               (SELECT count(*) FROM slices s JOIN marks m USING (slice)
                WHERE s.copy = 1 AND s.ts <= m.mark) AS dropped_rows"""),
    "rebuild_recovers_late": _q("SELECT * FROM edits"),
    "freshness_no_events": """
        SELECT CAST(NULL AS TIMESTAMP) AS newest_event_time, CAST(NULL AS DOUBLE) AS age_seconds,
               false AS within_limit""",
    "dedup_differing_copies": _q("SELECT meta_id, ts AS event_time FROM once"),
    "skew_percentiles_approx": _q("""
        SELECT wiki, point, true AS within_bound
        FROM (SELECT DISTINCT wiki FROM once), (SELECT unnest([0.5, 0.9, 0.95, 0.99, 0.999])::DOUBLE AS point)"""),
    "pipeline_verdict": _q("""
        SELECT true AS bronze_grew, true AS gold_grew,
               epoch(TIMESTAMP '2024-01-31' - max(ts)) < 86400 AS fresh,
               count(*) = count(DISTINCT meta_id) AS no_duplicates,
               epoch(TIMESTAMP '2024-01-31' - max(ts)) < 86400 AND count(*) = count(DISTINCT meta_id) AS passed
        FROM once"""),
    "log_keyed": _q("""
        SELECT CASE WHEN fault IN (0, 1, 4, 8) THEN 'unknown' WHEN fault = 6 THEN '  ' ELSE wiki END AS feed,
               count(*) AS row_count, 1 AS partition_count
        FROM copies GROUP BY 1"""),
    "log_landed": _q(f"SELECT {_FACTS} FROM once"),
    "bronze_one_week": _q("""
        SELECT ts::DATE AS event_day, count(*) AS row_count FROM once
        WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-15' GROUP BY 1"""),
    "sample_lines": _q("SELECT least(100, count(*)) AS row_count FROM copies"),
    "catalog_tables": _q("""
        SELECT 'recentchange' AS table_name, count(*) AS row_count FROM once
        UNION ALL SELECT 'edits_per_minute_by_wiki', count(*) FROM edits"""),
    "stream_metrics": _q("""
        SELECT max(ts) AS newest_event_time, epoch_us(TIMESTAMP '2024-01-31' - max(ts)) / 1e6 AS age_seconds,
               epoch(TIMESTAMP '2024-01-31' - max(ts)) < 86400 AS within_limit,
               count(*) AS rows_written, 0 AS dropped_rows, true AS timed
        FROM once"""),
    "stream_batches_overwritten": _q(f"SELECT {_FACTS} FROM once"),
    "freshness": _q("""
        SELECT max(ts) AS newest_event_time,
               (epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(max(ts)))::DOUBLE / 1e6::DOUBLE
                 AS age_seconds,
               (epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(max(ts))) < 120000000
                 AS within_limit
        FROM good"""),
    "event_rate": _q(_RATE.format(n=60, time="arrived", rows="copies")),
    "reject_rate": _q(_RATE.format(n=300, time="arrived", rows="bad")),
    "late_rate": _q(_RATE.format(n=300, time="arrived", rows="(SELECT * FROM once WHERE skew > 120)")),
    "reject_share": _q("""
        SELECT date_trunc('hour', arrived) AS window_start,
               date_trunc('hour', arrived) + INTERVAL 1 HOUR AS window_end,
               count(*) AS record_count,
               count(*) FILTER (fault IN (0, 1, 2, 3, 4, 5, 6, 8)) AS reject_count,
               count(*) FILTER (fault IN (0, 1, 2, 3, 4, 5, 6, 8))::DOUBLE / count(*)::DOUBLE
                 AS reject_share,
               count(*) FILTER (fault IN (0, 1, 2, 3, 4, 5, 6, 8))::DOUBLE / count(*)::DOUBLE > 0.1
                 AS alert
        FROM copies GROUP BY 1, 2"""),
    "schema_drift": _q("""
        SELECT arrived::DATE AS day,
               CASE fault WHEN 2 THEN 'meta.id' WHEN 5 THEN 'type' ELSE 'meta.origin' END AS json_key,
               CASE fault WHEN 9 THEN 'OBJECT' ELSE 'BIGINT' END AS json_type,
               count(*) AS row_count,
               CASE fault WHEN 9 THEN 'new' ELSE 'retyped' END AS finding
        FROM copies WHERE fault IN (2, 5, 9) GROUP BY arrived::DATE, fault"""),
    "rebuild_gold": _q(f"""
        SELECT * FROM (
          SELECT date_trunc('hour', ts) AS window_start,
                 date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
                 wiki, title, count(*) AS edit_count
          FROM once GROUP BY ALL)
        WHERE {_SETTLED.format("10 MINUTE")}"""),
    "rebuilt_edits": _q("SELECT * FROM edits"),
    "export_sample": _q(f"SELECT {_FACTS} FROM once ORDER BY md5(meta_id), meta_id LIMIT 5000"),
    "file_stats": _q("""
        SELECT ts::DATE AS event_date, wiki, count(*) AS row_count, true AS has_bytes
        FROM once GROUP BY ALL"""),
    "captured_blocks": _q("""
        SELECT CASE WHEN fault IN (0, 1, 8) THEN 'refused' ELSE 'object' END AS outcome,
               count(*) AS row_count
        FROM copies GROUP BY 1"""),
    "stream_bronze": _q(f"SELECT {_FACTS} FROM once"),
    "stream_rejects": _q("""
        SELECT raw.raw_json, bad.reason, bad.arrived AS ingested_at
        FROM bad JOIN raw USING (event_id, copy)"""),
    "stream_edits_per_minute": _q(f"SELECT * FROM edits WHERE {_TWO}"),
    "stream_bot_vs_human": _q(f"SELECT * FROM bots WHERE {_TWO}"),
    "stream_page_edits_10min": _q(f"SELECT * FROM pages WHERE {_TWO}"),
    "stream_late": _q(f"SELECT * FROM late WHERE {_HOUR}"),
    "stream_edits_from_bronze": _q(f"SELECT * FROM edits WHERE {_TWO}"),
    "stream_bots_from_bronze": _q(f"SELECT * FROM bots WHERE {_TWO}"),
    "stream_pages_from_bronze": _q(f"SELECT * FROM pages WHERE {_TWO}"),
    "stream_pipeline_counts": _q(f"""
        SELECT table_name, row_count, row_count AS rows_reported FROM (
          SELECT 'recentchange' AS table_name, count(*) AS row_count FROM once
          UNION ALL SELECT 'rejects', count(*) FROM bad
          UNION ALL SELECT 'edits_per_minute_by_wiki', count(*) FROM edits WHERE {_TWO}
          UNION ALL SELECT 'bot_vs_human_per_minute', count(*) FROM bots WHERE {_TWO}
          UNION ALL SELECT 'top_pages_10min', count(*) FROM pages WHERE {_TWO}
          UNION ALL SELECT 'late_arrivals', count(*) FROM late WHERE {_HOUR})"""),
    "replay_equals_control": _q("""
        SELECT count(*) AS left_rows, count(*) AS right_rows, 0 AS different_rows, true AS equal
        FROM once"""),
    "compaction_equality": _q("""
        SELECT count(*) AS left_rows, count(*) AS right_rows, 0 AS different_rows, true AS equal
        FROM once"""),
    "compaction_of_late_files": _q(f"SELECT {_FACTS} FROM once"),
    "rebuild_changed": _q("SELECT * FROM edits"),
    "rebuild_changed_days": _q("""
        SELECT DISTINCT ts::DATE AS event_date, wiki FROM once
        WHERE ts >= TIMESTAMP '2024-01-21' OR event_id % 97 = 5"""),
    "load_then_stream": _q(f"SELECT {_FACTS} FROM once"),
    "difference_levels": _q("""
        , days AS (SELECT * FROM once WHERE ts BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-12 23:59:59')
        SELECT meta_id, sha256(title) AS raw_json, 1::BIGINT AS surplus FROM days
        WHERE event_id % 101 = 50 OR event_id % 103 = 51
        UNION ALL
        SELECT meta_id, 'other', -1::BIGINT FROM days WHERE event_id % 103 = 51 AND event_id % 101 <> 50"""),
    "skew_from_sketches": _q("""
        SELECT wiki, point, event_count, true AS within_bound
        FROM (SELECT wiki, count(*) AS event_count FROM once GROUP BY wiki),
             (SELECT unnest([0.5, 0.9, 0.95, 0.99, 0.999])::DOUBLE AS point)"""),
    "distinct_from_sketches": _q("""
        SELECT wiki, count(*) AS event_count, true AS within_bound FROM once
        WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-22' GROUP BY wiki"""),
    "sessions_by_user": _q(_SESSIONS),
    "stream_sessions": _q(f"{_SESSIONS} WHERE session_end <= (SELECT newest_at FROM newest) - INTERVAL 10 MINUTE"),
    "counts_from_footers": _q("SELECT ts::DATE AS event_date, wiki, count(*) AS row_count FROM once GROUP BY ALL"),
    "state_rows": _q("""
        SELECT meta_id, ts + INTERVAL 1 DAY AS expires_at FROM once
        WHERE ts + INTERVAL 1 DAY > (SELECT newest_at FROM newest) - INTERVAL 1 DAY"""),
    "stream_top_pages": _q(_TOP.format("pages", 3)),
    "silent_feeds": _q("SELECT DISTINCT wiki AS feed, wiki = 'wiki3' AS silent FROM good"),
    "residual_by_filter": _q("""
        , pages_seen AS (
          SELECT DISTINCT concat_ws('/', "user", title, type, extract(hour FROM ts)::VARCHAR) AS page, ts::DATE AS day FROM once)
        SELECT DISTINCT o.page, o.day FROM pages_seen o JOIN pages_seen n USING (page)
        WHERE o.day < DATE '2024-01-21' AND n.day >= DATE '2024-01-21'"""),
    "rows_per_file": _q("""
        SELECT CASE WHEN fault IN (0, 1, 4, 8) THEN 'unknown'
                    WHEN fault = 6 THEN '  ' ELSE wiki END AS feed, count(*) AS row_count
        FROM copies GROUP BY 1"""),
    "log_tolerates_loss": "SELECT true AS rest_read, true AS strict_refused",
    "captured_contents": _q("""
        SELECT meta_id, ts AS event_time, wiki, type, title, "user", bot, true AS stamped FROM once"""),
    "created_tables": _q("""
        SELECT 'recentchange' AS table_name, count(*) AS row_count, 11 AS column_count FROM once
        UNION ALL SELECT 'rejects', count(*), 4 FROM bad
        UNION ALL SELECT 'edits_per_minute_by_wiki', count(*), 5 FROM edits
        UNION ALL SELECT 'bot_vs_human_per_minute', count(*), 6 FROM bots
        UNION ALL SELECT 'top_pages_10min', count(*), 6 FROM pages
        UNION ALL SELECT 'late_arrivals', count(*), 5 FROM late"""),
    "orphan_files": _q("""
        SELECT 'event_date=' || ts::DATE || '/wiki=' || wiki AS "partition",
               true AS has_orphans, (SELECT count(*) FROM once) AS table_rows
        FROM once GROUP BY ts::DATE, wiki"""),
}
