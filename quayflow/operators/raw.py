"""Kafka records to raw rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def to_raw(records: DataFrame, ingest_ts: Column | None = None) -> DataFrame:
    """The eight raw columns; the document stays an opaque string.

    ``ingest_ts`` defaults to the time of the micro-batch or query.
    """
    stamp = F.current_timestamp() if ingest_ts is None else ingest_ts
    return records.select(
        F.col("key").cast("string").alias("kafka_key"),
        F.col("value").cast("string").alias("raw_json"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
        stamp.alias("ingest_ts"),
    ).withColumn("ingest_date", F.to_date("ingest_ts"))
