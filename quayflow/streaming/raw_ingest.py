"""Event topic to the raw layer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from quayflow.operators.raw import to_raw
from quayflow.streaming.control import DEFAULT_INTERVAL, triggered


def start_raw_ingest(
    records: DataFrame,
    path: str,
    checkpoint: str,
    *,
    interval: str = DEFAULT_INTERVAL,
    available_now: bool = False,
    ingest_ts: Column | None = None,
) -> StreamingQuery:
    """Append records to Parquet, partitioned by ingestion date.

    ``records`` is any stream with the Kafka source's columns. Nothing is
    shuffled, and a micro-batch has one ingestion time, so each task writes one
    file. The file sink's log with the checkpoint makes a restart add no row twice.
    """
    writer = (
        to_raw(records, ingest_ts)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .partitionBy("ingest_date")
    )
    return triggered(writer, interval, available_now).start()
