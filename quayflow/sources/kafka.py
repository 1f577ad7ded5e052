"""Kafka topics as streams. Needs the Spark Kafka package on the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def kafka_options(
    servers: str,
    topic: str,
    *,
    starting: str = "earliest",
    fail_on_data_loss: bool = False,
    group_id: str | None = None,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Options of the Kafka source.

    ``starting`` counts on the first start only; later the checkpoint decides.
    ``max_offsets_per_trigger`` bounds a micro-batch after an outage, and
    ``min_partitions`` reads one topic partition, which may hold most of the
    records, with several tasks.
    """
    if starting not in ("earliest", "latest"):
        raise ValueError(f"starting must be 'earliest' or 'latest', not {starting!r}")
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if group_id is not None:
        options["kafka.group.id"] = group_id
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def kafka_stream(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """Records of a topic as a stream; see :func:`kafka_options`."""
    reader = spark.readStream.format("kafka")
    return reader.options(**kafka_options(servers, topic, **options)).load()


def event_stream(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """The event topic: from the earliest record, lost offsets tolerated."""
    return kafka_stream(spark, servers, topic, **{"starting": "earliest", **options})


def metrics_stream(
    spark: SparkSession, servers: str, topic: str, group_id: str | None = None, **options
) -> DataFrame:
    """The metrics topic: new records only; progress lives in the checkpoint.

    ``group_id`` is needed only where the brokers authorise by consumer group.
    """
    return kafka_stream(
        spark, servers, topic, **{"starting": "latest", "group_id": group_id, **options}
    )
