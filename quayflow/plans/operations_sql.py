"""The queries of ``operations`` in SQL for DuckDB."""

from __future__ import annotations

from quayflow.plans.catalogue_sql import _VISITS

_DELIVERED = """
WITH numbered AS (
  SELECT event_id AS e, event_id // 8 AS n,
         event_id // 8 + (event_id // 8) // 300 * 40000 AS kafka_offset
  FROM events
),
arrived AS (
  SELECT 'deliveries' AS kafka_topic, CAST(e % 8 AS INTEGER) AS kafka_partition, kafka_offset,
         CASE WHEN e % 89 = 0 THEN 3 ELSE 1 END AS n_records
  FROM numbered WHERE NOT (e % 97 = 0 OR n % 500 BETWEEN 100 AND 107)
),
steps AS (
  SELECT *, lag(kafka_offset) OVER (PARTITION BY kafka_partition ORDER BY kafka_offset) AS before
  FROM arrived
)
"""

# Reports of one stop and direction, numbered by visit.
_REPORTS = (
    _VISITS
    + """, reports AS (
  SELECT *, recorded_at_time - lag(recorded_at_time) OVER w > 361800000000 AS opens
  FROM passages WHERE recorded_at_time IS NOT NULL AND direction_ref IS NOT NULL
  WINDOW w AS (PARTITION BY kafka_key, direction_ref ORDER BY recorded_at_time)
),
numbered AS (
  SELECT *, sum(CASE WHEN opens THEN 1 ELSE 0 END) OVER (
    PARTITION BY kafka_key, direction_ref ORDER BY recorded_at_time) AS number
  FROM reports
),
ranked AS (
  SELECT *, row_number() OVER (v ORDER BY recorded_at_time DESC, kafka_timestamp DESC,
      kafka_topic DESC, kafka_partition DESC, kafka_offset DESC, item_identifier DESC) AS place,
    count(*) OVER v AS n_reports, min(recorded_at_time) OVER v AS first_reported,
    max(recorded_at_time) OVER v + 361800000000 AS settled_at
  FROM numbered WINDOW v AS (PARTITION BY kafka_key, direction_ref, number)
),
settled AS (
  SELECT kafka_key, direction_ref, recorded_at_time, kafka_offset, item_identifier, n_reports,
         first_reported, settled_at
  FROM ranked WHERE place = 1
)
"""
)

_DAY = 86_400_000_000
# Headways between departures with equal label and direction; four weeks count from 1970.
_HEADWAYS = (
    _VISITS
    + f""", departures AS (
  SELECT roi_label, departure_status, expected_departure_time AS at,
    (expected_departure_time - lag(expected_departure_time) OVER (
      PARTITION BY roi_label, direction_ref ORDER BY expected_departure_time)) // 1000000 AS headway,
    expected_departure_time - expected_departure_time % {_DAY} AS day_start,
    expected_departure_time - expected_departure_time % {28 * _DAY} AS weeks_start
  FROM kpi
)
"""
)

ORACLE_SQL: dict[str, str] = {
    "offset_gaps": _DELIVERED
    + """
SELECT 'missing' AS kind, kafka_topic, kafka_partition, before + 1 AS first_offset,
       kafka_offset - 1 AS last_offset, CAST(0 AS BIGINT) AS n_records
FROM steps WHERE kafka_offset > before + 1
UNION ALL
SELECT 'repeated', kafka_topic, kafka_partition, kafka_offset, kafka_offset, n_records
FROM arrived WHERE n_records > 1
""",
    "offset_totals": _DELIVERED
    + """
SELECT kafka_topic, kafka_partition, min(kafka_offset) AS first_offset,
       max(kafka_offset) AS last_offset, CAST(sum(n_records) AS BIGINT) AS n_records,
       count(*) AS n_offsets, max(kafka_offset) - min(kafka_offset) + 1 - count(*) AS n_missing,
       CAST(sum(n_records) - count(*) AS BIGINT) AS n_repeated
FROM arrived GROUP BY kafka_topic, kafka_partition
""",
    "visit_reports": _REPORTS + "SELECT * FROM settled",
    "stream_visit_reports": _REPORTS
    + f"""SELECT * FROM settled WHERE settled_at <=
  (SELECT max(recorded_at_time) // 1000 * 1000 - 30 * {_DAY} FROM passages)""",
    "daily_kpis": _HEADWAYS
    + """
SELECT day_start AS period_start, roi_label, count(*) AS n_departures,
       count(*) FILTER (departure_status = 'delayed') AS n_delayed, count(headway) AS n_values,
       CAST(sum(headway) AS BIGINT) AS sum_value, min(headway) AS min_value,
       max(headway) AS max_value
FROM departures GROUP BY day_start, roi_label
""",
    "headway_quantiles": _HEADWAYS
    + """
SELECT weeks_start AS period_start, roi_label, count(*) AS n_departures,
       count(headway) AS n_values, true AS p50_in_bound, true AS p90_in_bound
FROM departures GROUP BY weeks_start, roi_label HAVING count(headway) > 0
""",
    "stream_departure_kpis": _VISITS
    + f""", leads AS (
  SELECT *, (expected_departure_time - recorded_at_time) // 1000000 AS lead_seconds,
         expected_departure_time - expected_departure_time % {_DAY} AS day_start
  FROM kpi
)
SELECT day_start AS period_start, roi_label, count(*) AS n_departures,
       count(*) FILTER (departure_status = 'delayed') AS n_delayed, count(lead_seconds) AS n_values,
       CAST(sum(lead_seconds) AS BIGINT) AS sum_value, min(lead_seconds) AS min_value,
       max(lead_seconds) AS max_value
FROM leads
WHERE day_start + {_DAY} <= (
  SELECT max(expected_departure_time) // 1000 * 1000 - 36 * 3600000000 FROM curated)
GROUP BY day_start, roi_label
""",
    "curated_incremental": _VISITS + "SELECT * FROM curated",
    "refresh_counts": _VISITS
    + """
SELECT CAST(1 + (k * 8 + n) % 2 AS INTEGER) AS refresh, count(*) AS raw_rows,
       any_value(curated_rows) AS curated_rows
FROM ev JOIN (SELECT kafka_offset % 2 AS half, count(*) AS curated_rows FROM curated GROUP BY half)
  ON (k * 8 + n) % 2 = half
GROUP BY (k * 8 + n) % 2
UNION ALL SELECT CAST(3 AS INTEGER), 0, 0
""",
    "raw_compacted": _VISITS
    + """
SELECT 'STIF:StopPoint:Q:' || s || ':' AS kafka_key, 'lineitem-events' AS kafka_topic,
       CAST(s % 8 AS INTEGER) AS kafka_partition, k * 8 + n AS kafka_offset,
       ship + n * 3600000000 AS kafka_timestamp, year_start + n * 3600000000 AS ingest_ts,
       strftime(make_timestamp(year_start + n * 3600000000), '%Y-%m-%d') AS ingest_date
FROM ev
""",
    "lines_as_of": _VISITS
    + f""", changes AS (
  SELECT p_partkey AS p, 1 AS c, CAST(NULL AS BIGINT) AS valid_from, p_name AS name FROM part
  WHERE p_partkey % 4 > 0
  UNION ALL
  SELECT p_partkey, 2, 694224000000000 + (p_partkey % 90) * 30 * {_DAY}, p_name || ' II' FROM part
  UNION ALL
  SELECT p_partkey, 3, 694224000000000 + ((p_partkey % 90) * 30 + 400) * {_DAY}, p_name || ' III'
  FROM part WHERE p_partkey % 3 > 0
),
history AS (
  SELECT *, 'STIF:Line::C' || p || ':' AS ref,
    lead(valid_from) OVER (PARTITION BY p ORDER BY c) AS valid_to FROM changes
)
SELECT kafka_offset, item_identifier, line_ref, recorded_at_time, h.name,
       CASE WHEN p_size <= 25 THEN p_type END AS roi_label
FROM passages LEFT JOIN history h ON line_ref = ref
  AND (valid_from IS NULL OR valid_from <= recorded_at_time)
  AND (valid_to IS NULL OR recorded_at_time < valid_to)
  AND recorded_at_time IS NOT NULL
LEFT JOIN part ON h.p = p_partkey
""",
    "keyword_match": """
WITH keywords AS (
  SELECT DISTINCT unnest(['brand ' || (c_custkey % 40) || ' ' || c_custkey,
                          CAST(c_custkey % 1000 AS VARCHAR)]) AS keyword
  FROM customer
),
names AS (
  SELECT p_partkey, trim(regexp_replace(strip_accents(lower(p_name || ' ' || p_brand || ' '
           || p_partkey)), '[^a-z0-9]+', ' ', 'g')) AS name_norm
  FROM part
)
SELECT p_partkey, name_norm, keyword FROM names JOIN keywords ON contains(name_norm, keyword)
""",
    "stream_curated": _VISITS + "SELECT * FROM curated",
}
