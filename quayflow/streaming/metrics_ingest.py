"""Metrics topic to points."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quayflow.operators.metrics import (
    HOST_TAG,
    metric_lines,
    metric_points,
    metric_time,
    placed,
    read_metrics,
    rejected_messages,
)
from quayflow.sinks.point_store import post_lines
from quayflow.streaming.control import DEFAULT_INTERVAL, triggered

_RECORD = ("kafka_topic", "kafka_partition", "kafka_offset")


@dataclass(frozen=True)
class MetricsBatch:
    """One micro-batch: its points in long form and as line protocol, and what has none."""

    number: int
    points: DataFrame
    lines: DataFrame
    rejected: DataFrame


BatchSink = Callable[[MetricsBatch], None]


def _write_batch(df: DataFrame, path: str, number: int) -> None:
    """A folder per micro-batch; a batch that runs again replaces its folder."""
    df.write.mode("overwrite").parquet(f"{path}/batch_id={number}")


def file_sink(points_path: str, rejected_path: str) -> BatchSink:
    """Points and rejected messages as Parquet."""

    def write(batch: MetricsBatch) -> None:
        _write_batch(batch.points, points_path, batch.number)
        _write_batch(batch.rejected, rejected_path, batch.number)

    return write


def store_sink(rejected_path: str, **store: str) -> BatchSink:
    """Points to the time-series store, see :func:`post_lines`; rejected messages as Parquet."""

    def write(batch: MetricsBatch) -> None:
        post_lines(batch.lines, **store)
        _write_batch(batch.rejected, rejected_path, batch.number)

    return write


def start_metrics_ingest(
    records: DataFrame,
    measurement: str,
    sink: BatchSink,
    checkpoint: str,
    *,
    topic: str,
    interval: str = DEFAULT_INTERVAL,
    available_now: bool = False,
    record_time: Column | None = None,
    host: str = HOST_TAG,
) -> StreamingQuery:
    """Convert each message once and write its points; unreadable ones go aside.

    A point's time comes from its record (``record_time``, by default the Kafka
    timestamp) and offset, and its tags hold the partition, so no two records of a
    topic share a point and a batch that runs again gives the same points; a record whose
    time no point can have goes aside as well. Progress is committed after the sink returns,
    so delivery is at least once, and both points and files are replaced by their repetition.
    """
    stamped = records.select(
        F.col("value").cast("string").alias("value"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
        (F.col("timestamp") if record_time is None else record_time).alias("record_time"),
    )

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # The outputs share the parsed messages; what an executor loss drops from
        # the cache is read again from the source at the batch's offsets.
        read = placed(read_metrics(batch), metric_time("kafka_offset", F.col("record_time")))
        read = read.persist()
        try:
            time_ns = F.col("time_ns")
            sink(
                MetricsBatch(
                    number=batch_id,
                    points=metric_points(
                        read, topic, measurement, time_ns, _RECORD, host=host
                    ),
                    lines=metric_lines(read, topic, measurement, time_ns, host=host),
                    rejected=rejected_messages(read),
                )
            )
        finally:
            read.unpersist()

    writer = stamped.writeStream.foreachBatch(write_batch).option(
        "checkpointLocation", checkpoint
    )
    return triggered(writer, interval, available_now).start()
