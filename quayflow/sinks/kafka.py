"""Kafka topics as outputs. Needs the Spark Kafka package on the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_records(records: DataFrame, servers: str, topic: str) -> None:
    """Send ``key`` and ``value`` columns to a topic; returns when all are acknowledged."""
    (
        records.select("key", "value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )
