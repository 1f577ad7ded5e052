"""Fetched payloads to the event topic, metrics messages to the metrics topic."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayflow.operators.events import build_events, keyed_records, monitored_stops
from quayflow.session import stored

# Takes ``key`` and ``value`` columns; returns when all rows are acknowledged.
Send = Callable[[DataFrame], None]


def stop_events(stops: DataFrame, outcomes: DataFrame, event_source: str) -> DataFrame:
    """Events of the listed stops, keyed by stop reference."""
    listed = monitored_stops(stops).select("monitoring_ref").distinct()
    events = build_events(outcomes, event_source).join(listed, "monitoring_ref", "left_semi")
    return keyed_records(events, "event", "monitoring_ref")


class PublishCounts(NamedTuple):
    """Of the listed stops: all, those whose event was sent, and the others."""

    total: int
    ok: int
    failed: int


def publish_counts(stops: DataFrame, events: DataFrame) -> DataFrame:
    """``total, ok, failed`` of the listed stops: one without an event failed, however
    many outcomes it has, and outcomes of unlisted stops do not count."""
    listed = monitored_stops(stops).select(F.col("monitoring_ref").alias("key")).distinct()
    sent = events.select("key").distinct().withColumn("sent", F.lit(True))
    return listed.join(sent, "key", "left").agg(
        F.count(F.lit(1)).alias("total"),
        F.count("sent").alias("ok"),
        F.count_if(F.col("sent").isNull()).alias("failed"),
    )


def publish_events(
    stops: DataFrame, outcomes: DataFrame, event_source: str, send: Send
) -> PublishCounts:
    """Send the events of the listed stops and count the stops that had one.

    The events are kept in the shared folder first, so the payloads are read once, what is
    sent is what is counted, and tasks that run twice count once. With several outcomes of
    a stop each is sent, and the stop counts once.
    """
    events = stored(stop_events(stops, outcomes, event_source), "outbox")
    send(events)
    return PublishCounts(*publish_counts(stops, events).first())


def publish_metrics(messages: DataFrame, value: str, send: Send) -> None:
    """Send metrics messages without a key, each as it is."""
    send(keyed_records(messages, value))
