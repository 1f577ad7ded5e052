"""Visits to their last reports, as a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from quayflow.operators.visits import VISIT_KEYS, last_reports
from quayflow.streaming.control import DEFAULT_INTERVAL, state_on_disk, triggered


def start_visit_reports(
    visits: DataFrame,
    path: str,
    checkpoint: str,
    *,
    keys: Sequence[str] = VISIT_KEYS,
    gap: str = "2 hours",
    delay: str = "1 hour",
    time: str = "recorded_at_time",
    interval: str = DEFAULT_INTERVAL,
    available_now: bool = False,
) -> StreamingQuery:
    """Append each visit's last report to Parquet once no other can change it.

    ``delay`` is how far a report may be behind the newest one; later ones are dropped. The
    state holds the visits that are open at the watermark, after a first batch all of its
    visits, and is on the executors' disks, not in their memory.
    """
    settled = last_reports(visits.withWatermark(time, delay), keys, gap, time)
    writer = (
        settled.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    with state_on_disk(visits.sparkSession):
        return triggered(writer, interval, available_now).start()
