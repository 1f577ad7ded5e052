"""Stops and fetched payloads to keyed events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayflow.functions.documents import event_json, is_json
from quayflow.functions.texts import text_or_empty
from quayflow.functions.times import iso_utc


def monitored_stops(stops: DataFrame) -> DataFrame:
    """Stops with a usable reference, stripped into ``monitoring_ref``."""
    return stops.withColumn("monitoring_ref", text_or_empty(F.col("siri_monitoring_ref"))).where(
        F.col("monitoring_ref") != ""
    )


def stop_labels(stops: DataFrame) -> DataFrame:
    """Reference, name and station of each usable stop, with '' for missing text."""
    return monitored_stops(stops).select(
        "monitoring_ref",
        F.coalesce("name", F.lit("")).alias("stop_name"),
        F.coalesce("roi_station", F.lit("")).alias("roi_station"),
    )


def _fetched() -> Column:
    """True where a payload arrived and is one JSON value."""
    return F.col("error").isNull() & is_json(F.col("payload"))


def build_events(
    outcomes: DataFrame,
    event_source: str,
    event_version: int = 1,
    producer_ts: Column | None = None,
) -> DataFrame:
    """One ``(monitoring_ref, event)`` row for each successful fetch of a usable stop."""
    ref = text_or_empty(F.col("monitoring_ref"))
    stamp = F.current_timestamp() if producer_ts is None else producer_ts
    return outcomes.where((ref != "") & _fetched()).select(
        ref.alias("monitoring_ref"),
        event_json(event_source, event_version, iso_utc(stamp), ref, F.col("payload")).alias(
            "event"
        ),
    )


def fetch_counts(outcomes: DataFrame) -> DataFrame:
    """Total, ok and failed fetches; stops without a reference are not counted. Batch only."""
    return (
        outcomes.where(text_or_empty(F.col("monitoring_ref")) != "")
        .select(_fetched().alias("ok"))
        .agg(
            F.count(F.lit(1)).alias("total"),
            F.count_if("ok").alias("ok"),
            F.count_if(~F.col("ok")).alias("failed"),
        )
    )


def keyed_records(df: DataFrame, value: str, key: str | None = None) -> DataFrame:
    """Key and value columns for a Kafka topic.

    Records of one key stay in one topic partition; without a key they spread.
    """
    key_column = F.lit(None) if key is None else F.col(key)
    return df.select(key_column.cast("string").alias("key"), F.col(value).alias("value"))
