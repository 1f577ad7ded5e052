"""Envelope, parsing and flattening on hand-made documents."""

import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from quayflow.functions.documents import is_json, parse_json
from quayflow.operators.events import build_events, fetch_counts, keyed_records, monitored_stops
from quayflow.operators.passages import explode_visits, lift_deliveries, parse_events, passages
from quayflow.operators.raw import to_raw
from quayflow.plans.publish import stop_events
from quayflow.schemas import FETCH_OUTCOME, KAFKA_RECORD, RAW

ARRIVED = datetime(2026, 1, 2, 3, 4, 5)


def visit(number=1, **journey):
    call = journey.pop("call", {})
    return {
        "RecordedAtTime": "2026-01-02T03:00:00.000Z",
        "ItemIdentifier": f"item-{number}",
        "Unknown": {"deep": [1, 2]},
        "MonitoredVehicleJourney": {
            "LineRef": {"value": "STIF:Line::C1:"},
            "MonitoredCall": {"ExpectedDepartureTime": "2026-01-02T03:10:00Z", **call},
            **journey,
        },
    }


def event(deliveries, **envelope):
    return json.dumps(
        {
            "event_source": "s",
            "event_version": 1,
            "producer_ts": "2026-01-02T03:04:05.123456+00:00",
            "monitoring_ref": "STIF:StopPoint:Q:1:",
            "payload": {"Siri": {"ServiceDelivery": {"StopMonitoringDelivery": deliveries}}},
            **envelope,
        }
    )


def raw_of(spark, documents):
    rows = [
        ("k", text, "t", 0, offset, ARRIVED, ARRIVED, ARRIVED.date())
        for offset, text in enumerate(documents)
    ]
    return spark.createDataFrame(rows, RAW)


def flat(spark, *documents):
    return passages(raw_of(spark, documents)).orderBy("kafka_offset", "item_identifier").collect()


@pytest.mark.parametrize("text", ["{broken", "", None, "[]", "5"])
def test_unreadable_document_keeps_one_empty_row(spark, text):
    (row,) = flat(spark, text)
    assert row.kafka_offset == 0
    assert (row.event_source, row.event_version, row.monitoring_ref, row.line_ref) == (None,) * 4


@pytest.mark.parametrize(
    ("deliveries", "rows"),
    [
        (None, 1),
        ([], 1),
        ({"not": "an array"}, 1),
        ([{}], 1),
        ([{"MonitoredStopVisit": None}], 1),
        ([{"MonitoredStopVisit": []}], 1),
        ([{"MonitoredStopVisit": [visit(1), visit(2), visit(3)]}], 3),
        ([{"MonitoredStopVisit": [visit(1)]}, {"MonitoredStopVisit": []}], 2),
        ([{"MonitoredStopVisit": [visit(1)]}, {"MonitoredStopVisit": [visit(2), visit(3)]}], 3),
    ],
)
def test_flatten_keeps_parents_without_children(spark, deliveries, rows):
    result = flat(spark, event(deliveries))
    assert len(result) == rows
    assert {row.event_source for row in result} == {"s"}


@pytest.mark.parametrize(
    ("names", "first"),
    [(None, None), ([], None), ([{"value": "a"}, {"value": "b"}], "a"), ([{}], None), ("x", None)],
)
def test_first_text(spark, names, first):
    (row,) = flat(spark, event([{"MonitoredStopVisit": [visit(DirectionName=names)]}]))
    assert row.direction_name == first
    assert row.item_identifier == "item-1"


def test_bad_leaf_nulls_only_itself(spark):
    bad = visit(call={"VehicleAtStop": "maybe", "DepartureStatus": "onTime"})
    (row,) = flat(spark, event([{"MonitoredStopVisit": [bad]}], event_version="x"))
    assert (row.event_version, row.vehicle_at_stop) == (None, None)
    assert (row.monitoring_ref, row.departure_status) == ("STIF:StopPoint:Q:1:", "onTime")


def test_times(spark):
    (row,) = flat(spark, event([{"MonitoredStopVisit": [visit()]}]))
    assert row.producer_ts is not None and row.producer_ts.microsecond == 123456
    document = event([{"MonitoredStopVisit": [visit()]}])
    (strict,) = passages(raw_of(spark, [document]), "strict").collect()
    assert (strict.producer_ts, strict.expected_departure_time) == (None, None)
    assert strict.recorded_at_time is not None


def test_steps_keep_lineage(spark):
    lifted = lift_deliveries(parse_events(raw_of(spark, [event([])])))
    assert "deliveries" in lifted.columns
    visits = explode_visits(lifted)
    assert not {"deliveries", "delivery"} & set(visits.columns)


def test_raw_row(spark):
    records = spark.createDataFrame(
        [(b"k", "é".encode(), "t", 3, 9, ARRIVED), (None, None, "t", 3, 10, ARRIVED)], KAFKA_RECORD
    )
    raw = to_raw(records)
    assert raw.columns == [column.split()[0] for column in RAW.split(", ")]
    first, second = raw.orderBy("kafka_offset").collect()
    assert (first.kafka_key, first.raw_json, first.kafka_partition) == ("k", "é", 3)
    assert (second.kafka_key, second.raw_json) == (None, None)
    assert first.ingest_ts == second.ingest_ts
    assert raw.where(F.col("ingest_date") == F.to_date("ingest_ts")).count() == 2


@pytest.mark.parametrize(
    ("text", "valid"),
    [
        ('{"a": 1.50}', True),
        (" [1, 2] ", True),
        ("null", True),
        ('"text"', True),
        ('{"a": 1, "a": 2}', True),
        ('{"a": 1} tail', False),
        ("1],[2", False),
        ("1,2],[3", False),
        ("{'a': 1}", False),
        ("NaN", False),
        ('{"a": 1}{"b": 2}', False),
        ('{"a": 1}]', False),
        ('{"a": 1}}', False),
        ("1, 2", False),
        ('1, "q": 2', False),
        ('{"a": 1', False),
        ("", False),
        (None, False),
    ],
)
def test_whole_text_is_one_json_value(spark, text, valid):
    df = spark.createDataFrame([(text,)], "t string")
    read = df.select(parse_json(F.col("t")).isNotNull(), is_json(F.col("t"))).collect()[0]
    assert tuple(read) == (valid, valid)


def test_large_payload_is_valid(spark):
    text = F.concat(F.lit('{"a": "'), F.repeat(F.lit("x"), 21_000_000), F.lit('"}'))
    assert spark.range(1).select(is_json(text)).first()[0] is True


def test_build_events_and_counts(spark):
    payload = '{"z": 1.50, "a": "Défense", "none": null}'
    outcomes = spark.createDataFrame(
        [
            (" STIF:StopPoint:Q:1:\t", payload, None),
            ("STIF:StopPoint:Q:2:", None, "timeout"),
            ("STIF:StopPoint:Q:3:", payload + "x", None),
            ("STIF:StopPoint:Q:4:", "null", None),
            ("  \t", payload, None),
            (None, payload, None),
        ],
        FETCH_OUTCOME,
    )
    stamp = F.lit(datetime(2026, 1, 2, 3, 4, 5, 10)).cast("timestamp")
    built = build_events(outcomes, "src", producer_ts=stamp).collect()
    events = {row.monitoring_ref: row.event for row in built}
    assert set(events) == {"STIF:StopPoint:Q:1:", "STIF:StopPoint:Q:4:"}
    assert json.loads(events["STIF:StopPoint:Q:1:"]) == {
        "event_source": "src",
        "event_version": 1,
        "producer_ts": datetime(2026, 1, 2, 3, 4, 5, 10, timezone.utc).isoformat(),
        "monitoring_ref": "STIF:StopPoint:Q:1:",
        "payload": json.loads(payload),
    }
    assert payload in events["STIF:StopPoint:Q:1:"]
    assert fetch_counts(outcomes).collect() == [(4, 2, 2)]


def test_records_for_topics(spark):
    stops = spark.createDataFrame(
        [("STIF:StopPoint:Q:1: ",), ("",), (None,)], "siri_monitoring_ref string"
    )
    (stop,) = monitored_stops(stops).collect()
    assert stop.monitoring_ref == "STIF:StopPoint:Q:1:"
    outcomes = spark.createDataFrame(
        [("STIF:StopPoint:Q:1:", "{}", None), ("STIF:StopPoint:Q:9:", "{}", None)], FETCH_OUTCOME
    )
    (record,) = stop_events(stops, outcomes, "src").collect()
    assert record.key == json.loads(record.value)["monitoring_ref"] == "STIF:StopPoint:Q:1:"
    messages = spark.createDataFrame([("{}",)], "m string")
    assert keyed_records(messages, "m").collect() == [(None, "{}")]
