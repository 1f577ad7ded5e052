"""Departures to indicators by time window, as a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from quayflow.operators.kpis import DEPARTURE, KPI_KEYS, departure_kpis, lead_seconds
from quayflow.streaming.control import DEFAULT_INTERVAL, triggered


def start_departure_kpis(
    departures: DataFrame,
    path: str,
    checkpoint: str,
    *,
    window: str = "1 hour",
    keys: Sequence[str] = KPI_KEYS,
    delay: str = "10 minutes",
    interval: str = DEFAULT_INTERVAL,
    available_now: bool = False,
) -> StreamingQuery:
    """Append each window's indicators, with sketches of the lead times, once it is closed.

    A window closes when the newest departure is ``delay`` beyond its end; until then late
    rows count, after that they are dropped.
    """
    timed = departures.withWatermark(DEPARTURE, delay).withColumn("lead_seconds", lead_seconds())
    writer = (
        departure_kpis(timed, "lead_seconds", window, keys)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    return triggered(writer, interval, available_now).start()
