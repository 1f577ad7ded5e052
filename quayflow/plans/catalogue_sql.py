"""The catalogue's queries in SQL for DuckDB, straight from the star-schema tables.

Nothing here goes through JSON documents: the SQL states the expected rows.
"""

from __future__ import annotations

# One row for each visit, or for each delivery or event that has none.
_VISITS = """
WITH ev AS (
  SELECT l_orderkey AS k, CAST(l_linenumber AS BIGINT) AS n, l_partkey AS p, l_suppkey AS s,
         l_quantity AS q, l_returnflag AS rf, l_linestatus AS ls, epoch_us(l_shipdate) AS ship,
         epoch_us(date_trunc('year', l_shipdate)) AS year_start,
         l_quantity NOT IN (29, 31, 37) AS ok,
         CASE l_partkey % 4 WHEN 0 THEN 0 WHEN 2 THEN 2 ELSE 1 END AS n_del
  FROM lineitem
),
del AS (
  SELECT *, unnest(CASE WHEN ok AND n_del > 0 THEN range(1, n_del + 1)
                        ELSE [CAST(NULL AS BIGINT)] END) AS d
  FROM ev
),
vis AS (
  SELECT *, unnest(CASE WHEN d IS NOT NULL AND (n + d) % 4 > 0 THEN range(1, (n + d) % 4 + 1)
                        ELSE [CAST(NULL AS BIGINT)] END) AS v
  FROM del
),
passages AS (
  SELECT
    strftime(make_timestamp(year_start + n * 3600000000), '%Y-%m-%d') AS ingest_date,
    year_start + n * 3600000000 AS ingest_ts,
    'lineitem-events' AS kafka_topic,
    CAST(s % 8 AS INTEGER) AS kafka_partition,
    k * 8 + n AS kafka_offset,
    ship + n * 3600000000 AS kafka_timestamp,
    CASE WHEN ok THEN 'star.lineitem' END AS event_source,
    CASE WHEN ok AND q <> 13 THEN CAST(1 AS INTEGER) END AS event_version,
    CASE WHEN ok THEN 'STIF:StopPoint:Q:' || s || ':' END AS monitoring_ref,
    'STIF:StopPoint:Q:' || s || ':' AS kafka_key,
    CASE WHEN ok THEN ship + k % 1000000 END AS producer_ts,
    CASE WHEN v IS NOT NULL THEN ship + n * 3600000000 END AS recorded_at_time,
    CASE WHEN v IS NOT NULL THEN k || ':' || n || ':' || d || ':' || v END AS item_identifier,
    CASE WHEN v IS NULL THEN NULL
         WHEN n = 5 THEN 'stif:line::c' || (p + v - 1) || ':'
         WHEN n = 6 THEN 'STIF:Line::C' || (p + v - 1)
         WHEN v = 3 AND s % 5 = 0 THEN NULL
         ELSE 'STIF:Line::C' || (p + v - 1) || ':' END AS line_ref,
    CASE WHEN v IS NOT NULL THEN ls END AS direction_ref,
    CASE WHEN v IS NOT NULL AND n % 3 = 2 THEN rf END AS direction_name,
    CASE WHEN v IS NOT NULL THEN 'D' || s END AS destination_ref,
    CASE WHEN v IS NOT NULL THEN rf || ' - ' || s END AS destination_name,
    CASE WHEN v IS NOT NULL THEN 'Stop ' || s END AS stop_point_name,
    CASE WHEN v IS NULL OR (n + v) % 5 = 0 THEN NULL
         ELSE ship + (n * 60 + v * 7) * 60000000 + CASE WHEN v = 2 THEN 0 ELSE 123000 END
    END AS expected_departure_time,
    CASE WHEN v IS NULL THEN NULL WHEN rf = 'A' THEN 'onTime' WHEN rf = 'N' THEN 'delayed'
    END AS departure_status,
    CASE WHEN v IS NOT NULL THEN ls = 'O' END AS vehicle_at_stop
  FROM vis
),
lines AS (
  SELECT 'FR1:Line:C' || p_partkey || ':' AS line_id,
         'C' || p_partkey AS line_code,
         'STIF:Line::C' || p_partkey || ':' AS siri_line_ref,
         CASE WHEN p_size <= 25 THEN p_type END AS roi_label,
         p_name AS name, p_brand AS short_name, lower(p_type) AS transport_mode
  FROM part
),
enriched AS (
  SELECT passages.*, roi_label, name, short_name, transport_mode
  FROM passages LEFT JOIN lines ON line_ref = siri_line_ref
),
curated AS (SELECT * FROM enriched WHERE roi_label IS NOT NULL),
kpi AS (SELECT * FROM curated WHERE expected_departure_time IS NOT NULL)
"""

_RAW = """
SELECT CAST(user_id AS VARCHAR) AS kafka_key, props AS raw_json, event_type AS kafka_topic,
       CAST(user_id % 8 AS INTEGER) AS kafka_partition, event_id AS kafka_offset,
       epoch_us(ts) AS kafka_timestamp, epoch_us(ts) AS ingest_ts,
       strftime(ts, '%Y-%m-%d') AS ingest_date
FROM events
"""

_FETCHES = """
WITH fetches AS (
  SELECT c_custkey AS k, CASE WHEN c_custkey % 11 > 1
                              THEN 'STIF:StopPoint:Q:' || c_custkey || ':' END AS ref,
         CASE c_custkey % 13 WHEN 4 THEN '{"same": 1, "same": '
              WHEN 5 THEN '{"n": ' || repeat('7', 1500) || ', "v": '
              WHEN 6 THEN repeat('[', 900) ELSE '' END
           || '{"Name": "' || c_name || ' — né", "Segment": "' || c_mktsegment || '", "Nation": '
           || c_nationkey || ', "Balance": 1.50, "none": null}'
           || CASE c_custkey % 13 WHEN 4 THEN '}' WHEN 5 THEN '}'
              WHEN 6 THEN repeat(']', 900) ELSE '' END AS payload,
         c_custkey % 13 > 3 AND c_custkey % 17 <> 0 AS ok,
         1704067200000000 + c_custkey * 250001 AS fetched_us
  FROM customer
),
events_out AS (
  SELECT ref AS monitoring_ref,
         '{"event_source":"star.customer","event_version":1,"producer_ts":"'
           || strftime(make_timestamp(fetched_us), '%Y-%m-%dT%H:%M:%S')
           || CASE WHEN fetched_us % 1000000 = 0 THEN ''
                   ELSE '.' || lpad(CAST(fetched_us % 1000000 AS VARCHAR), 6, '0') END
           || '+00:00","monitoring_ref":"' || ref || '","payload":' || payload || '}' AS event
  FROM fetches WHERE ref IS NOT NULL AND ok
)
"""

_METRICS = """
WITH msg AS (
  SELECT event_id AS e, user_id AS u, epoch_us(ts) AS us,
         CAST(round(value * 100) AS BIGINT) AS cents
  FROM events
),
texts AS (
  SELECT *,
    CASE WHEN e % 7 = 0 THEN '"12"' WHEN e % 7 = 1 THEN 'true' WHEN e % 7 = 2 THEN e || '.9'
         WHEN e % 49 = 3 THEN '"x"' WHEN e % 49 = 10 THEN 'null'
         ELSE CAST(e AS VARCHAR) END AS available,
    CASE WHEN e % 5 = 0 THEN '"7"' WHEN e % 5 = 1 THEN 'false' WHEN e % 5 = 2 THEN '3.7'
         WHEN e % 5 = 3 THEN 'null' ELSE CAST(u AS VARCHAR) END AS running,
    CASE e % 3 WHEN 0 THEN 'true' WHEN 1 THEN '5' ELSE '"n/a"' END AS busy
  FROM msg
),
whole AS (
  SELECT *, '{"clusterMetrics":{"totalMB":' || cents || ',"availableMB":' || available
    || ',"utilizedMBPercent":' || (cents // 4) || '.5,"appsRunning":' || running
    || ',"rmSchedulerBusyPercent":' || busy
    || CASE WHEN e % 2 = 0 THEN ',"totalNodes":' || u ELSE '' END || ',"unknown":1}}' AS full_text
  FROM texts
),
messages AS (
  SELECT *,
    CASE e % 53 WHEN 0 THEN full_text || ' tail' WHEN 1 THEN '[1]'
                WHEN 2 THEN '{"clusterMetrics":null}' WHEN 3 THEN '{}'
                ELSE full_text END AS message,
    CASE e % 53 WHEN 0 THEN 'not valid JSON' WHEN 1 THEN 'not a JSON object'
                WHEN 2 THEN 'clusterMetrics is not an object'
                ELSE CASE WHEN e % 53 <> 3 AND e % 7 > 2 AND e % 49 IN (3, 10)
                          THEN 'unreadable number: availableMB'
                          WHEN e % 61 IN (7, 8) THEN 'time beyond nanoseconds' END
    END AS reject_reason,
    (us // 1000) * 1000000 + e % 1000000 AS time_ns
  FROM whole
),
accepted AS (SELECT * FROM messages WHERE reject_reason IS NULL AND e % 53 <> 3),
fields AS (
  SELECT e, time_ns, 1 AS pos, 'totalMB' AS field, cents AS long_value,
         CAST(NULL AS DOUBLE) AS double_value, CAST(NULL AS BOOLEAN) AS bool_value
  FROM accepted
  UNION ALL
  SELECT e, time_ns, 2, 'availableMB',
         CASE WHEN e % 7 = 0 THEN 12 WHEN e % 7 = 1 THEN 1 ELSE e END, NULL, NULL
  FROM accepted
  UNION ALL
  SELECT e, time_ns, 3, 'utilizedMBPercent', NULL, (cents // 4) + 0.5, NULL FROM accepted
  UNION ALL
  SELECT e, time_ns, 4, 'appsRunning',
         CASE WHEN e % 5 = 2 THEN 3 WHEN e % 5 = 4 THEN u END, NULL,
         CASE WHEN e % 5 = 1 THEN false END
  FROM accepted WHERE e % 5 IN (1, 2, 4)
  UNION ALL
  SELECT e, time_ns, 5, 'totalNodes', u, NULL, NULL FROM accepted WHERE e % 2 = 0
  UNION ALL
  SELECT e, time_ns, 6, 'rmSchedulerBusyPercent', NULL,
         CASE WHEN e % 3 = 1 THEN 5.0 END, CASE WHEN e % 3 = 0 THEN true END
  FROM accepted WHERE e % 3 < 2
)
"""

_METRIC_POINTS = (
    _METRICS
    + """
SELECT 'cluster' AS measurement, 'yarn_rm' AS source, 'master' AS rm_host,
       'cluster-metrics' AS topic, CAST(u % 8 AS VARCHAR) AS "partition", time_ns,
       e AS kafka_offset, field, long_value,
       CAST(double_value AS DOUBLE) AS double_value, bool_value
FROM fields JOIN (SELECT e, u FROM messages) USING (e)
"""
)

_POINT_FIELDS = """
SELECT 'passages' AS measurement, roi_label, short_name, transport_mode, stop_point_name,
       destination_name, ingest_date, kafka_topic, kafka_partition, kafka_offset,
       strftime(make_timestamp(kafka_timestamp), '%Y-%m-%d %H:%M:%S') AS kafka_timestamp,
       event_source, event_version, monitoring_ref, kafka_key, item_identifier, line_ref,
       direction_ref, direction_name, destination_ref, departure_status, vehicle_at_stop, name,
       expected_departure_time * 1000 AS time_ns
FROM kpi
"""

_POINT_LINES = (
    _VISITS
    + ", points AS ("
    + _POINT_FIELDS
    + """)
SELECT concat_ws(' ',
  concat_ws(',', measurement,
    'destination_name=' || replace(destination_name, ' ', '\\ '),
    'roi_label=' || replace(roi_label, ' ', '\\ '),
    'short_name=' || replace(short_name, ' ', '\\ '),
    'stop_point_name=' || replace(stop_point_name, ' ', '\\ '),
    'transport_mode=' || replace(transport_mode, ' ', '\\ ')),
  concat_ws(',',
    'departure_status="' || departure_status || '"',
    'destination_ref="' || destination_ref || '"',
    'direction_name="' || direction_name || '"',
    'direction_ref="' || direction_ref || '"',
    'event_source="' || event_source || '"',
    'event_version=' || event_version || 'i',
    'ingest_date="' || ingest_date || '"',
    'item_identifier="' || item_identifier || '"',
    'kafka_key="' || kafka_key || '"',
    'kafka_offset=' || kafka_offset || 'i',
    'kafka_partition=' || kafka_partition || 'i',
    'kafka_timestamp="' || kafka_timestamp || '"',
    'kafka_topic="' || kafka_topic || '"',
    'line_ref="' || line_ref || '"',
    'monitoring_ref="' || monitoring_ref || '"',
    'name="' || name || '"',
    'vehicle_at_stop=' || CAST(vehicle_at_stop AS VARCHAR)),
  CAST(time_ns AS VARCHAR)) AS line
FROM points
"""
)

_KEYWORDS = """
WITH keywords(roi_station, keyword) AS (
  VALUES ('RING', 'ring'), ('RED', 'red'), ('OLD_BOLT', 'old bolt')
),
names AS (
  SELECT p_partkey,
         trim(regexp_replace(strip_accents(lower(p_name)), '[^a-z0-9]+', ' ', 'g')) AS name_norm
  FROM part
)
SELECT p_partkey, name_norm, roi_station FROM names JOIN keywords ON
"""

ORACLE_SQL: dict[str, str] = {
    "raw_records": _RAW,
    "raw_one_day": _RAW + " WHERE CAST(ts AS DATE) = DATE '2024-01-15'",
    "stream_raw": _RAW,
    "build_events": _FETCHES + "SELECT monitoring_ref, event FROM events_out",
    "keyed_event_records": _FETCHES
    + "SELECT monitoring_ref AS key, event AS value FROM events_out",
    "unkeyed_metric_records": _METRICS
    + "SELECT CAST(NULL AS VARCHAR) AS key, message AS value FROM messages",
    "fetch_outcome_counts": _FETCHES
    + """SELECT count(*) AS total, count(*) FILTER (ok) AS ok,
                count(*) FILTER (NOT ok) AS failed
         FROM fetches WHERE ref IS NOT NULL""",
    "publish_counts": _FETCHES
    + """, listed AS (
  SELECT DISTINCT 'STIF:StopPoint:Q:' || s_suppkey * 2 || ':' AS ref FROM supplier)
SELECT count(*) AS total, count(monitoring_ref) AS ok,
       count(*) FILTER (monitoring_ref IS NULL) AS failed,
       count(monitoring_ref) + count(*) FILTER (monitoring_ref LIKE '%4:') AS n_sent
FROM listed LEFT JOIN (SELECT DISTINCT monitoring_ref FROM events_out) ON ref = monitoring_ref
""",
    "batch_counts": """
SELECT count(*) AS total, count(*) FILTER (o_orderstatus <> 'P') AS ok,
       count(*) FILTER (o_orderstatus = 'P') AS failed
FROM orders WHERE o_custkey % 10 <> 0
""",
    "stop_list": """
SELECT CAST(s_suppkey AS VARCHAR) AS monitoring_ref,
       CASE WHEN s_suppkey % 3 <> 0 THEN s_name ELSE '' END AS stop_name,
       CASE WHEN s_suppkey % 4 <> 0 THEN 'NATION_' || s_nationkey ELSE '' END AS roi_station
FROM supplier WHERE s_suppkey % 5 > 1
""",
    "parse_props": "SELECT event_id, CAST(props->>'$.k' AS INTEGER) AS k FROM events",
    "parsed_envelopes": _VISITS
    + """
SELECT 'STIF:StopPoint:Q:' || s || ':' AS kafka_key, k * 8 + n AS kafka_offset,
       CASE WHEN ok THEN 'star.lineitem' END AS event_source,
       CASE WHEN ok AND q <> 13 THEN CAST(1 AS INTEGER) END AS event_version,
       CASE WHEN ok THEN strftime(make_timestamp(ship), '%Y-%m-%dT%H:%M:%S')
         || CASE WHEN k % 1000000 = 0 THEN ''
                 ELSE '.' || lpad(CAST(k % 1000000 AS VARCHAR), 6, '0') END || '+00:00'
       END AS producer_ts_raw,
       CASE WHEN ok THEN 'STIF:StopPoint:Q:' || s || ':' END AS monitoring_ref,
       CASE WHEN ok AND NOT (n_del = 0 AND s % 2 = 0) THEN CAST(n_del AS INTEGER)
       END AS n_deliveries
FROM ev
""",
    "flatten_outer": _VISITS
    + """SELECT kafka_key, kafka_offset, event_version, item_identifier, line_ref,
                vehicle_at_stop FROM passages""",
    "passages": _VISITS + "SELECT * FROM passages",
    "passages_strict_times": _VISITS
    + """SELECT * REPLACE (CAST(NULL AS BIGINT) AS producer_ts,
                          CASE WHEN item_identifier LIKE '%:1' THEN expected_departure_time END
                            AS expected_departure_time)
         FROM passages""",
    "enrich_left": _VISITS + "SELECT * FROM enriched",
    "enrich_salted": _VISITS + "SELECT * FROM enriched",
    "enrich_roi": _VISITS + "SELECT * FROM curated",
    "curated_roundtrip": _VISITS + "SELECT * FROM curated",
    "curated_job": _VISITS + "SELECT * FROM curated",
    "layer_counts": _VISITS
    + """SELECT 'raw' AS layer, count(*) AS n_rows FROM lineitem
         UNION ALL SELECT 'curated', count(*) FROM curated
         UNION ALL SELECT 'kpi', count(*) FROM kpi""",
    "kpi_ready": _VISITS + "SELECT * FROM kpi",
    "point_time": _VISITS
    + """SELECT kafka_key, kafka_offset, item_identifier,
                1000 * coalesce(expected_departure_time, recorded_at_time, producer_ts, ingest_ts)
                  AS time_ns
         FROM passages""",
    "point_tags_fields": _VISITS + _POINT_FIELDS,
    "point_lines": _POINT_LINES,
    "point_text_sink": _POINT_LINES,
    "metrics_points": _METRIC_POINTS,
    "metrics_lines": _METRICS
    + """
SELECT 'cluster,partition=' || any_value(u % 8)
  || ',rm_host=master,source=yarn_rm,topic=cluster-metrics ' || string_agg(field || '=' || coalesce(long_value || 'i', CAST(double_value AS VARCHAR),
                                         CAST(bool_value AS VARCHAR)), ','
                ORDER BY pos)
  || ' ' || any_value(time_ns) AS line
FROM fields JOIN (SELECT e, u FROM messages) USING (e) GROUP BY e
""",
    "metrics_point_identity": _METRICS
    + "SELECT count(DISTINCT e) AS n_messages, count(DISTINCT e) AS n_points FROM fields",
    "metrics_rejected": _METRICS
    + """SELECT e AS kafka_offset, message, reject_reason FROM messages
         WHERE reject_reason IS NOT NULL""",
    "stream_metrics": _METRIC_POINTS,
    "stop_ids": """
WITH ids AS (
  SELECT CASE WHEN c_custkey % 9 = 0 THEN 'FR::StopPlace:Q' || c_custkey || ':FR1'
              ELSE 'FR::monomodalStopPlace:' || c_custkey || ':FR1' END AS id,
         CASE WHEN c_custkey % 9 <> 0 THEN CAST(c_custkey AS VARCHAR) END AS stop_numeric_id
  FROM customer
)
SELECT id, stop_numeric_id, 'STIF:StopPoint:Q:' || stop_numeric_id || ':' AS siri_monitoring_ref
FROM ids
""",
    "line_ids": _VISITS + "SELECT line_id, line_code, siri_line_ref FROM lines",
    "name_norm": """
SELECT doc_id, trim(regexp_replace(strip_accents(lower(text)), '[^a-z0-9]+', ' ', 'g'))
         AS name_norm
FROM documents
""",
    "roi_match": _KEYWORDS + "contains(name_norm, keyword)",
    "roi_match_words": _KEYWORDS
    + "contains(' ' || name_norm || ' ', ' ' || keyword || ' ')",
    "line_selection": _VISITS
    + """SELECT line_id, siri_line_ref, roi_label FROM lines WHERE roi_label IS NOT NULL
         AND EXISTS (SELECT 1 FROM passages WHERE line_ref = siri_line_ref)""",
    "stops_roundtrip": """
SELECT CAST(s_suppkey AS VARCHAR) AS id,
       CASE WHEN s_suppkey % 3 > 0 THEN '"' || s_name || '",' || chr(10) || 'né' ELSE s_name END
         AS name,
       CASE WHEN s_suppkey % 4 > 0 THEN CAST(s_nationkey AS VARCHAR) END AS town
FROM supplier
""",
    "run_stamps": """SELECT count(*) AS n_rows, CAST(1 AS BIGINT) AS n_times,
                     CAST(1 AS BIGINT) AS n_dates FROM events""",
    "ingest_twice": """SELECT count(*) AS first_run, count(*) AS second_run, count(*) AS n_rows
                       FROM events""",
    "export_counts": _VISITS
    + """SELECT count(*) AS n_reported, count(*) AS n_written, CAST(1 AS BIGINT) AS n_stamps
         FROM kpi""",
    "lines_observed": _VISITS
    + """SELECT line_id, siri_line_ref, name FROM lines
         WHERE EXISTS (SELECT 1 FROM passages WHERE line_ref = siri_line_ref)""",
}
