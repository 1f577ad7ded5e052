"""Raw rows to passages: parse, lift, flatten, project.

``explode_outer`` is used even where the ROI filter later drops its NULL rows.
For ``explode`` Catalyst infers a filter on the array size, pushes it below the
projection and substitutes the parser into it, so each document would be parsed
again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayflow.functions.times import TimeMode, parse_event_time
from quayflow.schemas import EVENT, LINE_REFS, LINEAGE_COLUMNS

# Fixed value: where a visit names its line.
LINE_REF_PATH = "MonitoredVehicleJourney.LineRef.value"


def parse_events(raw: DataFrame, schema: str = EVENT) -> DataFrame:
    """Lineage columns and the document as a struct; unreadable text gives NULL fields.

    ``schema`` may declare less than an event's fields, which spares reading the others.
    """
    return raw.select(*LINEAGE_COLUMNS, F.from_json("raw_json", schema).alias("event"))


def lift_deliveries(parsed: DataFrame) -> DataFrame:
    """Envelope fields and the delivery array as columns."""
    return parsed.select(
        *LINEAGE_COLUMNS,
        "event.event_source",
        "event.event_version",
        F.col("event.producer_ts").alias("producer_ts_raw"),
        "event.monitoring_ref",
        F.col("event.payload.Siri.ServiceDelivery.StopMonitoringDelivery").alias("deliveries"),
    )


def explode_visits(lifted: DataFrame) -> DataFrame:
    """One row for each visit; events and deliveries without any keep one row."""
    per_delivery = lifted.withColumn("delivery", F.explode_outer("deliveries")).drop("deliveries")
    return per_delivery.withColumn("visit", F.explode_outer("delivery.MonitoredStopVisit")).drop(
        "delivery"
    )


def with_line_ref(visits: DataFrame) -> DataFrame:
    """Lift the join key, so that a join can drop visits before their columns are read."""
    return visits.withColumn("line_ref", F.col(f"visit.{LINE_REF_PATH}"))


def project_passages(
    visits: DataFrame, times: TimeMode = "tolerant", keep: Sequence[str] = ()
) -> DataFrame:
    """The 22 passage columns of visits that have ``line_ref``, then the columns to ``keep``."""
    journey = F.col("visit.MonitoredVehicleJourney")
    call = journey["MonitoredCall"]

    def first_text(texts: Column) -> Column:
        # NULL for a NULL or empty array, where an index would raise
        return F.get(texts, F.lit(0))["value"]

    # The paths in a visit.
    return visits.select(
        "ingest_date",
        "ingest_ts",
        "kafka_topic",
        "kafka_partition",
        "kafka_offset",
        "kafka_timestamp",
        "event_source",
        "event_version",
        "monitoring_ref",
        "kafka_key",
        parse_event_time(F.col("producer_ts_raw"), times).alias("producer_ts"),
        parse_event_time(F.col("visit.RecordedAtTime"), times).alias("recorded_at_time"),
        F.col("visit.ItemIdentifier").alias("item_identifier"),
        "line_ref",
        journey["DirectionRef"]["value"].alias("direction_ref"),
        first_text(journey["DirectionName"]).alias("direction_name"),
        journey["DestinationRef"]["value"].alias("destination_ref"),
        first_text(journey["DestinationName"]).alias("destination_name"),
        first_text(call["StopPointName"]).alias("stop_point_name"),
        parse_event_time(call["ExpectedDepartureTime"], times).alias("expected_departure_time"),
        call["DepartureStatus"].alias("departure_status"),
        call["VehicleAtStop"].alias("vehicle_at_stop"),
        *keep,
    )


def line_refs_of(raw: DataFrame) -> DataFrame:
    """``line_ref`` of each visit, reading nothing else of the documents."""
    parsed = raw.select(F.from_json("raw_json", LINE_REFS).alias("event"))
    deliveries = F.col("event.payload.Siri.ServiceDelivery.StopMonitoringDelivery")
    per_delivery = parsed.select(F.explode_outer(deliveries).alias("delivery"))
    visits = per_delivery.select(F.explode_outer("delivery.MonitoredStopVisit").alias("visit"))
    return visits.select(F.col(f"visit.{LINE_REF_PATH}").alias("line_ref"))


def visits_of(raw: DataFrame) -> DataFrame:
    """Raw rows to visits in one narrow stage, without a shuffle."""
    return with_line_ref(explode_visits(lift_deliveries(parse_events(raw))))


def passages(raw: DataFrame, times: TimeMode = "tolerant") -> DataFrame:
    """Raw rows to passages."""
    return project_passages(visits_of(raw), times)
