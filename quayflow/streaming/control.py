"""Triggers and waiting, shared by the streams."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

DEFAULT_INTERVAL = "30 seconds"
# State that grows with the open keys is kept on the executors' disks, and what all its
# partitions on an executor hold in memory is bounded.
_STATE = "spark.sql.streaming.stateStore"
DISK_STATE = {
    f"{_STATE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STATE}.rocksdb.boundedMemoryUsage": "true",
    f"{_STATE}.rocksdb.maxMemoryUsageMB": "500",
}


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Queries started here keep their state on disk; one with a checkpoint of another kind of
    state goes on with that."""
    before = {key: spark.conf.get(key, None) for key in DISK_STATE}
    for key, value in DISK_STATE.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def triggered(
    writer: DataStreamWriter, interval: str = DEFAULT_INTERVAL, available_now: bool = False
) -> DataStreamWriter:
    """Micro-batches at an interval, or one pass over what is there for on-demand runs."""
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=interval)


def wait(query: StreamingQuery, timeout: float | None = None) -> bool:
    """Block until the query ends; False when it still runs after ``timeout`` seconds."""
    if timeout is None:
        query.awaitTermination()
        return True
    return bool(query.awaitTermination(timeout))
