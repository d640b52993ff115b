"""SQL with the same result as each registered query, written independently of it."""

from __future__ import annotations

MUSIC = """
music_events AS (
  SELECT substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4)
           || '-' || substr(h, 21, 12) AS event_id,
         'user-' || lpad(CAST(user_id AS VARCHAR), 5, '0') AS user_id,
         'track-' || lpad(CAST(k AS VARCHAR), 6, '0') AS track_id,
         'Artist ' || CAST(k % 20 AS VARCHAR) AS artist_name,
         ts AS played_at,
         CAST(floor(value) AS INTEGER) AS duration_seconds,
         CASE event_type WHEN 'click' THEN 'web' WHEN 'view' THEN 'ios' WHEN 'purchase' THEN 'android'
                         WHEN 'signup' THEN 'desktop' ELSE 'smart_tv' END AS platform,
         CAST(ts AS DATE) AS ingest_date,
         src_id
  FROM (SELECT md5(CAST(event_id AS VARCHAR)) AS h, event_id AS src_id, user_id, ts, event_type, value,
               CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
        FROM events)
)"""

RAW = MUSIC + """,
raw_events AS (
  SELECT event_id, CASE WHEN src_id % 31 = 0 THEN repeat(user_id, 13) WHEN src_id % 17 <> 0 THEN user_id END AS user_id,
         CASE WHEN src_id % 19 = 0 THEN '  ' ELSE track_id END AS track_id, artist_name,
         CASE WHEN src_id % 23 = 0 THEN 'not-a-date' WHEN src_id % 29 = 0 THEN '10:00:00' ELSE strftime(played_at, '%Y-%m-%dT%H:%M:%SZ') END AS played_at,
         duration_seconds, platform, CAST(ingest_date AS VARCHAR) AS ingest_date, src_id, 0 AS seq
  FROM music_events
  UNION ALL
  SELECT event_id, user_id, track_id, artist_name, strftime(played_at, '%Y-%m-%dT%H:%M:%SZ'),
         duration_seconds + 1, platform, CAST(ingest_date AS VARCHAR), src_id, 1
  FROM music_events WHERE src_id % 10 = 0
)"""

# Time, then the contract fields: the order in which the first version of an event wins.
ORDER = "played_at, user_id, track_id, artist_name, duration_seconds, platform, ingest_date"

GATE = RAW + f""",
normal AS (
  SELECT * EXCLUDE (played_at), played_at AS played_at_raw,
         try_cast(replace(played_at, 'Z', '') AS TIMESTAMP) AS played_at,
         CASE WHEN src_id % 3 = 0 THEN 'batch' ELSE 'stream' END AS source
  FROM raw_events
),
judged AS (
  SELECT *, concat_ws(',',
      CASE WHEN user_id IS NULL THEN 'missing:user_id' END,
      CASE WHEN trim(track_id) = '' THEN 'missing:track_id' END,
      CASE WHEN played_at IS NULL THEN 'timestamp:played_at' END,
      CASE WHEN length(user_id) > 128 THEN 'length:user_id' END) AS reasons
  FROM normal
),
valid AS (
  SELECT event_id, user_id, track_id, artist_name, played_at, duration_seconds, platform, ingest_date,
         source, src_id, seq
  FROM judged WHERE reasons = ''
),
invalid AS (SELECT * FROM judged WHERE reasons <> ''),
ranked AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY {ORDER}, src_id, seq) AS rn,
                  row_number() OVER (PARTITION BY event_id, source, ingest_date ORDER BY {ORDER}) AS load_rn
           FROM valid),
firsts AS (SELECT * EXCLUDE (rn, load_rn) FROM ranked WHERE rn = 1),
loaded AS (SELECT * EXCLUDE (rn, load_rn) FROM ranked WHERE load_rn = 1)"""

FACT_COLUMNS = "event_id, user_id, track_id, artist_id, played_at, duration_seconds, platform, ingest_date"
FACT = MUSIC + f""",
keyed AS (SELECT *, sha256(artist_name) AS artist_id FROM music_events),
fact AS (SELECT {FACT_COLUMNS} FROM keyed),
one_each AS (
  SELECT * EXCLUDE (rn)
  FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY {ORDER}) AS rn FROM keyed)
  WHERE rn = 1)"""

FIRST_FACT = f"""
SELECT event_id, user_id, track_id, sha256(artist_name) AS artist_id, played_at, duration_seconds, platform,
       CAST(ingest_date AS DATE) AS ingest_date
FROM firsts"""

AUDITED = """
SELECT * EXCLUDE (source, played_at, duration_seconds, src_id, seq),
       CAST(duration_seconds AS VARCHAR) AS duration_seconds, CAST(src_id AS VARCHAR) AS src_id,
       CAST(seq AS VARCHAR) AS seq, 'run-0001' AS run_id, '2026-01-01T00:00:00+00:00' AS quarantined_at
FROM invalid"""

UPSERTED = FACT + f""",
target AS (SELECT {FACT_COLUMNS} FROM one_each WHERE src_id % 3 <> 0),
source AS (SELECT {FACT_COLUMNS.replace('duration_seconds', 'duration_seconds + 100 AS duration_seconds')}
           FROM one_each WHERE src_id % 2 = 0 OR src_id % 3 = 0)
SELECT {', '.join(f'CASE WHEN s.event_id IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}' for c in FACT_COLUMNS.split(', '))}
FROM target t FULL OUTER JOIN source s ON t.event_id = s.event_id"""

BROKEN = MUSIC + """,
broken AS (
  SELECT src_id, '{' || concat_ws(',',
    '"event_id":"' || CASE WHEN src_id % 41 = 0 THEN 'not-a-uuid' ELSE event_id END || '"',
    '"user_id":' || CASE WHEN src_id % 47 = 0 THEN '7' WHEN src_id % 59 = 0 THEN 'null' ELSE '"' || user_id || '"' END,
    '"track_id":"' || CASE WHEN src_id % 61 = 0 THEN '' ELSE track_id END || '"',
    '"artist_name":"' || artist_name || '"',
    '"played_at":"' || CASE WHEN src_id % 23 = 0 THEN '2024-01-01 10:00:00'
                            ELSE strftime(played_at, '%Y-%m-%dT%H:%M:%SZ') END || '"',
    '"duration_seconds":' || CASE WHEN src_id % 31 = 0 THEN '"' || CAST(duration_seconds AS VARCHAR) || '"'
                                  WHEN src_id % 37 = 0 THEN CAST(duration_seconds AS VARCHAR) || '.5'
                                  WHEN src_id % 67 = 0 THEN '"' || CAST(duration_seconds AS VARCHAR) || 'd"'
                                  WHEN src_id % 71 = 0 THEN '"0x1p3"'
                                  ELSE CAST(duration_seconds AS VARCHAR) END,
    '"platform":"' || platform || '"',
    '"ingest_date":"' || CASE WHEN src_id % 43 = 0 THEN '2024-13-45' ELSE CAST(ingest_date AS VARCHAR) END || '"',
    CASE WHEN src_id % 29 = 0 THEN '"extra":{"a":1}' END)
    || CASE WHEN src_id % 53 = 0 THEN '' ELSE '}' END AS raw_line
  FROM music_events
),
fields AS (
  SELECT src_id, raw_line, json_valid(raw_line) AS ok,
         CASE WHEN json_valid(raw_line) THEN raw_line ELSE '{}' END AS j
  FROM broken
)"""

ORDER_PLAYS = """
order_plays AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR) AS event_id,
         'user-' || CAST(o_custkey AS VARCHAR) AS user_id, p_brand AS artist_name, l_shipdate AS played_at,
         CAST(floor(l_quantity) AS INTEGER) AS duration_seconds, l_returnflag AS platform,
         CAST(l_shipdate AS DATE) AS ingest_date, l_suppkey, l_extendedprice
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
)"""

TOP = """
SELECT artist_name, count(*) AS event_count, CAST(sum(duration_seconds) AS DOUBLE) / 60 AS listening_minutes
FROM {source} GROUP BY artist_name"""

RULES = """
rules(metric, stat, op, threshold) AS (VALUES
  ('function_errors', 'sum', '>=', 1), ('function_throttles', 'sum', '>=', 1), ('job_failed', 'sum', '>=', 1),
  ('job_timeout', 'sum', '>=', 1), ('stream_iterator_age_ms', 'max', '>', 60000), ('delivery_success', 'sum', '<', 1),
  ('dead_letter_depth', 'max', '>=', 1), ('warehouse_errors', 'sum', '>=', 1), ('warehouse_capacity', 'sum', '>=', 1),
  ('query_bytes_scanned', 'sum', '>', 1073741824))"""

LOGS = """
logs AS (
  SELECT event_id AS log_id, ts,
         CASE user_id % 3 WHEN 0 THEN 'raw_to_clean' WHEN 1 THEN 'warehouse' ELSE 'function' END AS log_group,
         CASE event_type WHEN 'error' THEN 'ERROR merge step' WHEN 'click' THEN 'run FAILED'
              WHEN 'purchase' THEN 'TIMEOUT after 30 min' WHEN 'signup' THEN 'capacity scaled up'
              ELSE 'run finished' END AS message
  FROM events
)"""


def _rules() -> str:
    """Rules of the fact table over ``staged``."""
    names = FACT_COLUMNS.split(", ")
    lengths = {"event_id": 36, "user_id": 128, "track_id": 128, "artist_id": 64, "platform": 32}
    rows = [
        f"SELECT 'not_null:{c}' AS rule, count(*) FILTER (WHERE {c} IS NULL) AS failures FROM staged" for c in names
    ]
    rows += [
        f"SELECT 'max_length:{c}', count(*) FILTER (WHERE length({c}) > {n}) FROM staged" for c, n in lengths.items()
    ]
    rows.append("SELECT 'primary_key:event_id', count(*) - count(DISTINCT event_id) FROM staged")
    return " UNION ALL ".join(rows)


def _constraints() -> str:
    return (
        f"WITH {GATE}, staged AS (SELECT event_id, user_id, "
        "CASE WHEN src_id % 13 = 0 THEN repeat(track_id, 12) ELSE track_id END AS track_id, "
        "sha256(artist_name) AS artist_id, played_at, duration_seconds, platform, ingest_date FROM normal), "
        f"report AS ({_rules()}) SELECT 'fact_stream' AS table_name, rule, failures FROM report"
    )


_TEXT = "event_id, user_id, track_id, artist_name, played_at, CAST(duration_seconds AS VARCHAR) AS duration_seconds, platform, ingest_date"
_SOURCE = "CASE WHEN src_id % 3 = 0 THEN 'batch' ELSE 'stream' END AS source"
_CLEAN = """
SELECT event_id, user_id, track_id, artist_name, played_at, duration_seconds, platform,
       CAST(ingest_date AS DATE) AS ingest_date, source, {load} AS load_id
FROM loaded"""

ORACLES: dict[str, str] = {
    # sources
    "raw_scan": f"WITH {RAW} SELECT {_TEXT}, CAST(NULL AS VARCHAR) AS _corrupt_record FROM raw_events",
    "raw_scan_concatenated": f"WITH {RAW} SELECT {_SOURCE}, CAST(ingest_date AS DATE) AS run_date, {_TEXT} FROM raw_events",
    "clean_scan": f"WITH {GATE} {_CLEAN.format(load=chr(39) + 'batch' + chr(39))}",
    "csv_scan": f"WITH {RAW} SELECT {_TEXT} FROM raw_events",
    "lake_tables": f"""WITH {GATE},
        days AS (SELECT ingest_date, platform, count(DISTINCT event_id) AS day_event_count FROM firsts GROUP BY ALL)
        SELECT CAST(f.ingest_date AS DATE) AS ingest_date, f.platform, f.artist_name, d.day_event_count,
               count(*) AS event_count, count(DISTINCT f.artist_name) AS track_artists
        FROM firsts f JOIN days d ON f.ingest_date = d.ingest_date AND f.platform = d.platform GROUP BY ALL""",
    "manifest_worklist": r"""
        WITH raw_keys AS (
          SELECT 'lake' AS bucket, strftime(ts, '%Y-%m-%d') AS d, event_id % 7 AS c FROM events),
        keys AS (
          SELECT bucket, CASE c
            WHEN 2 THEN 'raw/source%3Dbatch/ingest_date%3D' || d || '/manifest.json'
            WHEN 3 THEN 'raw/source=my+feed/ingest_date=' || d || '/manifest.json'
            WHEN 4 THEN 'clean/source=batch/ingest_date=' || d || '/manifest.json'
            WHEN 5 THEN 'raw/source=batch/ingest_date=' || d || '/events.json'
            WHEN 6 THEN 'raw/source=batch/ingest_date=2026-99-99/manifest.json'
            ELSE 'raw/source=batch/ingest_date=' || d || '/manifest.json' END AS key
          FROM raw_keys),
        decoded AS (SELECT bucket, key, url_decode(replace(key, '+', '%20')) AS k FROM keys),
        parsed AS (
          SELECT *, regexp_full_match(k, 'raw/source=[^/]+/ingest_date=\d{4}-\d{2}-\d{2}/manifest\.json') AS shaped,
                 try_cast(regexp_extract(k, 'ingest_date=(\d{4}-\d{2}-\d{2})/', 1) AS DATE) AS day
          FROM decoded)
        SELECT bucket, key,
               CASE WHEN shaped AND day IS NOT NULL THEN left(k, length(k) - 13) END AS raw_prefix,
               CASE WHEN shaped THEN day END AS ingest_date,
               CASE WHEN shaped AND day IS NOT NULL THEN 'accepted' ELSE 'rejected' END AS status,
               CASE WHEN NOT shaped THEN 'not_a_manifest' WHEN day IS NULL THEN 'no_such_date' END AS reason
        FROM parsed""",
    # pipeline and sinks
    "lake_pipeline": f"WITH {GATE} {FIRST_FACT}",
    "quarantine_sink": f"WITH {GATE} {AUDITED}",
    # quality gate
    "ensure_columns": f"WITH {MUSIC} SELECT * EXCLUDE (platform, duration_seconds), CAST(NULL AS VARCHAR) AS platform, "
    "CAST(NULL AS INTEGER) AS duration_seconds FROM music_events",
    "normalize_timestamps": f"WITH {GATE} SELECT src_id, seq, played_at_raw, played_at FROM normal",
    "gate_valid": f"WITH {GATE} SELECT * EXCLUDE (source) FROM valid",
    "gate_invalid": f"WITH {GATE} SELECT * EXCLUDE (source) FROM invalid",
    "contract_violations": f"""WITH {BROKEN},
        v AS (
          SELECT src_id, raw_line, ok, json_extract_string(j, '$.event_id') AS e, json_extract_string(j, '$.user_id') AS u,
                 json_extract_string(j, '$.track_id') AS t, json_extract_string(j, '$.artist_name') AS a,
                 json_extract_string(j, '$.played_at') AS p, json_extract_string(j, '$.duration_seconds') AS d,
                 json_extract_string(j, '$.platform') AS f, json_extract_string(j, '$.ingest_date') AS i,
                 json_type(j, '$.user_id') AS ut, json_type(j, '$.duration_seconds') AS dt,
                 json_exists(j, '$.extra') AS extra
          FROM fields)
        SELECT src_id, raw_line, concat_ws(',',
          CASE WHEN NOT ok THEN 'not_json' END,
          CASE WHEN e IS NULL THEN 'missing:event_id' END,
          CASE WHEN NOT regexp_full_match(e, '[0-9a-f]{{8}}(-[0-9a-f]{{4}}){{3}}-[0-9a-f]{{12}}') THEN 'format:event_id' END,
          CASE WHEN u IS NULL THEN 'missing:user_id' END,
          CASE WHEN t IS NULL THEN 'missing:track_id' END,
          CASE WHEN t = '' THEN 'length:track_id' END,
          CASE WHEN a IS NULL THEN 'missing:artist_name' END,
          CASE WHEN p IS NULL THEN 'missing:played_at' END,
          CASE WHEN NOT regexp_full_match(p, '[0-9-]{{10}}T[0-9:]{{8}}Z') THEN 'format:played_at' END,
          CASE WHEN d IS NULL THEN 'missing:duration_seconds' END,
          CASE WHEN contains(d, '.') OR regexp_matches(d, '[a-z]') THEN 'type:duration_seconds' END,
          CASE WHEN try_cast(d AS DOUBLE) < 1 THEN 'minimum:duration_seconds' END,
          CASE WHEN f IS NULL THEN 'missing:platform' END,
          CASE WHEN f NOT IN ('android', 'ios', 'web', 'desktop') THEN 'enum:platform' END,
          CASE WHEN i IS NULL THEN 'missing:ingest_date' END,
          CASE WHEN i IS NOT NULL AND try_cast(i AS DATE) IS NULL THEN 'format:ingest_date' END,
          CASE WHEN ut NOT IN ('VARCHAR', 'NULL') THEN 'kind:user_id' END,
          CASE WHEN dt = 'VARCHAR' THEN 'kind:duration_seconds' END,
          CASE WHEN extra THEN 'unknown_fields' END) AS violations
        FROM v""",
    "quarantine_records": f"WITH {GATE} {AUDITED}",
    "stamp_ingest_date": f"WITH {GATE} SELECT event_id, DATE '2026-07-10' AS ingest_date FROM firsts",
    "canonical_types": f"""WITH {BROKEN}
        SELECT src_id, CAST(floor(try_cast(json_extract_string(j, '$.duration_seconds') AS DOUBLE)) AS INTEGER) AS duration_seconds,
               try_cast(json_extract_string(j, '$.ingest_date') AS DATE) AS ingest_date
        FROM fields""",
    "replay_quarantine": f"""WITH {GATE}
        SELECT CAST(src_id AS VARCHAR) AS src_id, event_id, coalesce(user_id, 'user-unknown') AS user_id, 'run-0001' AS run_id,
               CASE WHEN reasons = 'missing:user_id' THEN 'recovered' ELSE 'rejected' END AS status,
               CASE WHEN reasons = 'missing:user_id' THEN '' ELSE replace(reasons, 'missing:user_id,', '') END AS reasons
        FROM invalid""",
    "replay_state": f"""WITH {GATE}
        SELECT event_id, count(*) FILTER (WHERE reasons <> 'missing:user_id') AS open,
               count(*) FILTER (WHERE reasons = 'missing:user_id') AS recovered
        FROM invalid GROUP BY event_id""",
    # dedup, keys, constraints
    "constraint_report_changed": f"""WITH {FACT},
        again AS (SELECT * REPLACE (CAST('2024-01-10' AS DATE) AS ingest_date) FROM one_each
                  WHERE event_id < '08' AND CAST(ingest_date AS DATE) <> CAST('2024-01-10' AS DATE)),
        staged AS (SELECT * REPLACE (CAST(ingest_date AS DATE) AS ingest_date) FROM one_each UNION ALL SELECT * FROM again),
        report AS ({_rules()}) SELECT 'fact_stream' AS table_name, rule, failures FROM report""",
    "dedup_events": f"WITH {GATE} SELECT * EXCLUDE (source) FROM firsts",
    "duplicate_keys": f"WITH {RAW} SELECT event_id, count(*) AS row_count FROM raw_events GROUP BY 1 HAVING count(*) > 1",
    "constraint_report": _constraints(),
    # model
    "artist_key": f"WITH {FACT} SELECT event_id, artist_name, artist_id FROM keyed",
    "fact_stream": f"WITH {GATE} {FIRST_FACT}",
    "dim_artist": f"WITH {FACT} SELECT DISTINCT artist_id, artist_name FROM keyed",
    "dim_track": f"""WITH {MUSIC},
        plays AS (SELECT track_id, played_at,
                         sha256('Artist ' || CAST(CAST(substr(user_id, 6) AS INTEGER) % 7 AS VARCHAR)) AS artist_id
                  FROM music_events),
        r AS (SELECT *, row_number() OVER (PARTITION BY track_id ORDER BY played_at DESC, artist_id DESC) AS rn FROM plays)
        SELECT track_id, artist_id FROM r WHERE rn = 1""",
    "daily_listening_metrics_approx": f"""WITH {RAW}
        SELECT ingest_date, platform, CAST(sum(duration_seconds) AS BIGINT) AS listening_seconds,
               true AS events_within_error, true AS listeners_within_error
        FROM raw_events GROUP BY ingest_date, platform""",
    "daily_listening_metrics": f"""WITH {RAW}
        SELECT ingest_date, platform, count(DISTINCT event_id) AS event_count,
               count(DISTINCT user_id) AS unique_listener_count, CAST(sum(duration_seconds) AS BIGINT) AS listening_seconds
        FROM raw_events GROUP BY 1, 2""",
    "upsert_fact": f"WITH {UPSERTED}",
    "upsert_idempotent": f"WITH {UPSERTED}",
    # marts
    "dashboard_events": f"WITH {FACT} SELECT *, CASE WHEN duration_seconds < 30 THEN 1 ELSE 0 END AS is_skip FROM fact",
    "daily_listening_minutes": f"""WITH {FACT}
        SELECT CAST(played_at AS DATE) AS listening_date, CAST(sum(duration_seconds) AS DOUBLE) / 60 AS listening_minutes
        FROM fact GROUP BY 1 ORDER BY 1""",
    "top_artists": f"WITH {MUSIC} {TOP.format(source='music_events')}",
    "top10_artists": f"WITH {FACT} {TOP.format(source='one_each')} ORDER BY listening_minutes DESC, artist_name LIMIT 10",
    "platform_distribution": f"""WITH {FACT}
        SELECT platform, count(*) AS event_count, CAST(sum(duration_seconds) AS DOUBLE) / 60 AS listening_minutes
        FROM fact GROUP BY 1""",
    "skip_rate": f"""WITH {FACT}
        SELECT CAST(played_at AS DATE) AS listening_date,
               CAST(count(*) FILTER (WHERE duration_seconds < 30) AS DOUBLE) / count(*) AS skip_rate
        FROM fact GROUP BY 1""",
    "latest_skip_rate": f"""WITH {FACT}
        SELECT CAST(played_at AS DATE) AS listening_date,
               CAST(count(*) FILTER (WHERE duration_seconds < 30) AS DOUBLE) / count(*) AS skip_rate
        FROM fact GROUP BY 1 ORDER BY 1 DESC LIMIT 1""",
    "fact_count": "SELECT count(DISTINCT event_id) AS event_count FROM events",
    # access, monitoring, retention
    "row_level_access": f"""WITH {MUSIC},
        access_map(principal, dimension, value) AS (VALUES ('analytics-admins', '*', '*'), ('business-web', 'platform', 'web'),
          ('regional-north', 'market', 'north'))
        SELECT e.event_id, e.platform, m.principal FROM music_events e
        JOIN access_map m ON m.dimension = '*' OR (m.dimension = 'platform' AND m.value = e.platform)""",
    "log_triage": f"""WITH {LOGS}
        SELECT * FROM logs WHERE regexp_matches(message, 'ERROR|FAILED|TIMEOUT') ORDER BY ts DESC, log_id DESC LIMIT 100""",
    "log_metrics": f"""WITH {LOGS},
        hits AS (
          SELECT ts, CASE WHEN log_group = 'raw_to_clean' AND message LIKE '%FAILED%' THEN 'job_failed'
                          WHEN log_group = 'raw_to_clean' AND message LIKE '%TIMEOUT%' THEN 'job_timeout'
                          WHEN log_group = 'warehouse' AND message LIKE '%ERROR%' THEN 'warehouse_errors'
                          WHEN log_group = 'warehouse' AND message LIKE '%capacity%' THEN 'warehouse_capacity' END AS metric
          FROM logs)
        SELECT time_bucket(INTERVAL 5 MINUTES, ts) AS window_start, metric, count(*) AS value
        FROM hits WHERE metric IS NOT NULL GROUP BY 1, 2""",
    "metric_alarms": f"""WITH {RULES},
        points AS (
          SELECT ts, CASE event_type WHEN 'click' THEN 'function_errors' WHEN 'view' THEN 'stream_iterator_age_ms'
                          WHEN 'purchase' THEN 'query_bytes_scanned' WHEN 'signup' THEN 'delivery_success'
                          ELSE 'dead_letter_depth' END AS metric,
                 CASE event_type WHEN 'view' THEN CAST(floor(value) AS BIGINT) * 200
                      WHEN 'purchase' THEN CAST(floor(value) AS BIGINT) * 5000000
                      ELSE CAST(floor(value) AS BIGINT) % 2 END AS value
          FROM events),
        totals AS (
          SELECT time_bucket(INTERVAL 5 MINUTES, ts) AS window_start, metric, sum(value) AS s, max(value) AS m
          FROM points GROUP BY 1, 2),
        periods AS (
          SELECT window_start, t.metric, stat, op, CAST(threshold AS DOUBLE) AS threshold,
                 CAST(CASE WHEN stat = 'sum' THEN s ELSE m END AS DOUBLE) AS value
          FROM totals t JOIN rules r ON t.metric = r.metric)
        SELECT window_start, metric, stat, value, threshold FROM periods
        WHERE (op = '>=' AND value >= threshold) OR (op = '>' AND value > threshold) OR (op = '<' AND value < threshold)""",
    "recent_queries": """SELECT o_orderkey AS query_id, o_orderdate AS submitted_at,
               CAST(floor(o_totalprice) AS BIGINT) AS bytes_scanned,
               CASE WHEN o_orderstatus = 'F' THEN 'SUCCEEDED' ELSE 'FAILED' END AS status
        FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 50""",
    "expired_partitions": """
        SELECT DISTINCT zone, CAST(ts AS DATE) AS ingest_date
        FROM events, (VALUES ('raw', 90), ('clean', 180), ('analytics', 365)) z(zone, days)
        WHERE CAST(ts AS DATE) < DATE '2024-07-15' - days""",
    "stream_lag": """
        WITH a AS (SELECT ts, ts + to_seconds(event_id % 120) AS arrival FROM events)
        SELECT time_bucket(INTERVAL 5 MINUTES, arrival) AS window_start,
               max(epoch_ms(arrival) - epoch_ms(ts)) AS max_lag_ms,
               max(epoch_ms(arrival) - epoch_ms(ts)) > 60000 AS breach
        FROM a GROUP BY 1""",
    # streaming
    "stream_landing": f"WITH {BROKEN} SELECT raw_line, CASE WHEN ok THEN 'raw' ELSE 'error' END AS zone FROM fields",
    "stream_gate": f"""WITH {GATE}
        SELECT event_id, user_id, track_id, artist_name, strftime(played_at, '%Y-%m-%dT%H:%M:%SZ') AS played_at,
               duration_seconds, platform, CAST(ingest_date AS DATE) AS ingest_date, source, '' AS reasons FROM loaded
        UNION ALL
        SELECT event_id, user_id, track_id, artist_name, played_at_raw, duration_seconds, platform,
               CAST(ingest_date AS DATE), source, reasons FROM invalid""",
    "stream_dedup": f"WITH {FACT} SELECT * EXCLUDE (artist_id) FROM one_each",
    "stream_upsert": f"WITH {UPSERTED}",
    "incremental_ingest": f"WITH {GATE} "
    + _CLEAN.format(load="CASE source WHEN 'batch' THEN 'batch 0000000000' ELSE 'batch 0000000001' END"),
    "clean_two_prefixes": f"""WITH {MUSIC}
        SELECT event_id, user_id, track_id, artist_name, date_trunc('second', played_at) AS played_at, duration_seconds,
               platform, ingest_date
        FROM (SELECT *, row_number() OVER (PARTITION BY event_id, src_id % 2, ingest_date ORDER BY {ORDER}) AS rn FROM music_events)
        WHERE rn = 1""",
    "gate_two_streams": f"""WITH {GATE}
        SELECT DISTINCT ON (event_id, seq, ingest_date) event_id, seq % 2 AS stream, '' AS reasons FROM valid
        UNION ALL SELECT event_id, seq % 2, reasons FROM invalid""",
    "raw_scan_nested": f"WITH {RAW} SELECT {_TEXT}, CAST(NULL AS VARCHAR) AS _corrupt_record FROM raw_events",
    "manifest_dead_letters": """
        SELECT DISTINCT 'raw/source=' || CASE event_id % 4 WHEN 0 THEN 'a+b' WHEN 1 THEN 'a%20b' WHEN 2 THEN '100%' ELSE 'good' END
               || '/ingest_date=' || CASE WHEN event_id % 20 = 3 THEN '2026-99-99' ELSE strftime(ts, '%Y-%m-%d') END
               || '/manifest.json' AS key,
               CASE WHEN event_id % 20 = 3 THEN 'no_such_date' ELSE 'loaded' END AS state
        FROM events""",
    "lake_views": f"""WITH {GATE}, fact AS ({FIRST_FACT}),
        minutes AS (SELECT CAST(sum(duration_seconds) AS DOUBLE) / 60 AS m FROM fact)
        SELECT 'events' AS name, CAST(count(*) AS DOUBLE) AS value FROM fact
        UNION ALL SELECT 'skips', CAST(count(*) FILTER (WHERE duration_seconds < 30) AS DOUBLE) FROM fact
        UNION ALL SELECT 'minutes', m FROM minutes
        UNION ALL SELECT 'days', CAST(count(DISTINCT CAST(played_at AS DATE)) AS DOUBLE) FROM fact
        UNION ALL SELECT 'artist minutes ' || artist_name, CAST(sum(duration_seconds) AS DOUBLE) / 60 FROM firsts GROUP BY artist_name
        UNION ALL SELECT 'platform events ' || platform, CAST(count(*) AS DOUBLE) FROM fact GROUP BY platform
        UNION ALL SELECT 'skip rate ' || CAST(CAST(played_at AS DATE) AS VARCHAR),
                         CAST(count(*) FILTER (WHERE duration_seconds < 30) AS DOUBLE) / count(*)
                  FROM fact GROUP BY CAST(played_at AS DATE)""",
    # the same operators on order lines
    "order_plays_dedup": f"""WITH {ORDER_PLAYS},
        r AS (SELECT *, row_number() OVER (PARTITION BY event_id
                ORDER BY l_suppkey, played_at, l_extendedprice, duration_seconds, platform) AS rn FROM order_plays)
        SELECT event_id, l_suppkey, played_at FROM r WHERE rn = 1""",
    "order_plays_duplicate_keys": f"WITH {ORDER_PLAYS} SELECT event_id, count(*) AS row_count FROM order_plays "
    "GROUP BY 1 HAVING count(*) > 1",
    "order_plays_daily_metrics": f"""WITH {ORDER_PLAYS}
        SELECT ingest_date, platform, count(DISTINCT event_id) AS event_count,
               count(DISTINCT user_id) AS unique_listener_count, CAST(sum(duration_seconds) AS BIGINT) AS listening_seconds
        FROM order_plays GROUP BY 1, 2""",
    "order_plays_top_artists": f"WITH {ORDER_PLAYS} {TOP.format(source='order_plays')}",
    "order_plays_skip_rate": f"""WITH {ORDER_PLAYS}
        SELECT CAST(played_at AS DATE) AS listening_date,
               CAST(count(*) FILTER (WHERE duration_seconds < 30) AS DOUBLE) / count(*) AS skip_rate
        FROM order_plays GROUP BY 1""",
}

ORACLES["manifest_discovery"] = ORACLES["manifest_worklist"]  # the same decisions, however the keys arrive
