"""Schemas of the layers, as DDL. All columns are nullable."""

from __future__ import annotations

# What the Kafka source yields, as far as the raw layer uses it.
KAFKA_RECORD = (
    "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"
)

RAW = (
    "kafka_key string, raw_json string, kafka_topic string, kafka_partition int, "
    "kafka_offset bigint, kafka_timestamp timestamp, ingest_ts timestamp, ingest_date date"
)

# Only the JSON fields that end up in a curated column are declared: the parser
# materialises every declared field and Catalyst does not prune a parsed struct
# that feeds several columns.
_TEXTS = "array<struct<value: string>>"
_REF = "struct<value: string>"
_CALL = (
    f"struct<StopPointName: {_TEXTS}, ExpectedDepartureTime: string, "
    "DepartureStatus: string, VehicleAtStop: boolean>"
)
_JOURNEY = (
    f"struct<LineRef: {_REF}, DirectionRef: {_REF}, DirectionName: {_TEXTS}, "
    f"DestinationRef: {_REF}, DestinationName: {_TEXTS}, MonitoredCall: {_CALL}>"
)
_VISIT = (
    f"struct<RecordedAtTime: string, ItemIdentifier: string, MonitoredVehicleJourney: {_JOURNEY}>"
)
_DELIVERY = f"struct<MonitoredStopVisit: array<{_VISIT}>>"
EVENT = (
    "event_source string, event_version int, producer_ts string, monitoring_ref string, "
    "payload struct<Siri: struct<ServiceDelivery: "
    f"struct<StopMonitoringDelivery: array<{_DELIVERY}>>>>"
)

# The one path that tells which lines are observed.
LINE_REFS = (
    "payload struct<Siri: struct<ServiceDelivery: struct<StopMonitoringDelivery: "
    "array<struct<MonitoredStopVisit: array<struct<MonitoredVehicleJourney: "
    f"struct<LineRef: {_REF}>>>>>>>>"
)

LINEAGE_COLUMNS = [
    "kafka_key",
    "kafka_topic",
    "kafka_partition",
    "kafka_offset",
    "kafka_timestamp",
    "ingest_ts",
    "ingest_date",
]

LINE_COLUMNS = ["roi_label", "name", "short_name", "transport_mode"]

CURATED = (
    "ingest_date date, ingest_ts timestamp, kafka_topic string, kafka_partition int, "
    "kafka_offset bigint, kafka_timestamp timestamp, event_source string, event_version int, "
    "monitoring_ref string, kafka_key string, producer_ts timestamp, recorded_at_time timestamp, "
    "item_identifier string, line_ref string, direction_ref string, direction_name string, "
    "destination_ref string, destination_name string, stop_point_name string, "
    "expected_departure_time timestamp, departure_status string, vehicle_at_stop boolean, "
    "roi_label string, name string, short_name string, transport_mode string"
)


# Outcome of fetching one stop: the JSON text received, or why there is none.
FETCH_OUTCOME = "monitoring_ref string, payload string, error string"
