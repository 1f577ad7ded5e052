"""Streams over files; the Kafka source differs only in its options."""

import json
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from quayflow.operators.lines import join_lines, roi_only
from quayflow.operators.passages import project_passages, visits_of
from quayflow.plans import catalogue
from quayflow.plans.curated import curated_rows
from quayflow.schemas import KAFKA_RECORD, LINE_COLUMNS
from quayflow.sources.kafka import kafka_options
from quayflow.sources.tables import raw_stream, raw_table
from quayflow.streaming import metrics_ingest
from quayflow.streaming.control import wait
from quayflow.streaming.metrics_ingest import file_sink, start_metrics_ingest
from quayflow.streaming.raw_ingest import start_raw_ingest
from test_events import event, visit
from test_lines import LINES

ARRIVED = datetime(2026, 1, 2, 3, 4, 5)


def add_records(spark, path, values, first_offset=0, topic="t"):
    rows = [
        (b"k", value.encode(), topic, 0, offset, ARRIVED)
        for offset, value in enumerate(values, first_offset)
    ]
    spark.createDataFrame(rows, KAFKA_RECORD).coalesce(1).write.mode("append").parquet(str(path))


def records(spark, path):
    return spark.readStream.schema(KAFKA_RECORD).parquet(str(path))


def ingest(spark, tmp_path):
    query = start_raw_ingest(
        records(spark, tmp_path / "in"),
        str(tmp_path / "raw"),
        str(tmp_path / "checkpoint"),
        available_now=True,
    )
    assert wait(query, 120)
    return raw_table(spark, str(tmp_path / "raw"))


def test_raw_ingest_adds_each_record_once(spark, tmp_path):
    add_records(spark, tmp_path / "in", ["a", "b", "c"])
    raw = ingest(spark, tmp_path)
    assert raw.count() == 3
    assert raw.select("ingest_ts").distinct().count() == 1
    assert raw.where(F.col("ingest_date") == F.to_date("ingest_ts")).count() == 3
    assert ingest(spark, tmp_path).count() == 3
    add_records(spark, tmp_path / "in", ["d"], 3)
    offsets = [row.kafka_offset for row in ingest(spark, tmp_path).collect()]
    assert sorted(offsets) == [0, 1, 2, 3]


def test_interval_trigger_runs_until_stopped(spark, tmp_path):
    add_records(spark, tmp_path / "in", ["a"])
    query = start_raw_ingest(
        records(spark, tmp_path / "in"),
        str(tmp_path / "raw"),
        str(tmp_path / "checkpoint"),
        interval="1 second",
    )
    try:
        query.processAllAvailable()
        assert not wait(query, 1)
    finally:
        query.stop()
    assert raw_table(spark, str(tmp_path / "raw")).count() == 1


@pytest.mark.parametrize("salt", [None, 4])
def test_stream_and_batch_curate_alike(spark, tmp_path, salt):
    refs = ["STIF:Line::C1:", "STIF:Line::C9:", None]
    visits = [visit(i, LineRef={"value": ref}) for i, ref in enumerate(refs)]
    document = event([{"MonitoredStopVisit": visits}])
    add_records(spark, tmp_path / "in", [document, event([]), "{broken"])
    raw = ingest(spark, tmp_path)
    lines = spark.createDataFrame([("STIF:Line::C1:", "RER A", "A", "A", "rail")], LINES)
    joined = join_lines(visits_of(raw_stream(spark, str(tmp_path / "raw"), 10)), lines, salt)
    query = (
        project_passages(roi_only(joined), keep=LINE_COLUMNS)
        .writeStream.format("parquet")
        .option("path", str(tmp_path / "curated"))
        .option("checkpointLocation", str(tmp_path / "checkpoint2"))
        .trigger(availableNow=True)
        .start()
    )
    assert wait(query, 120)
    batch = curated_rows(visits_of(raw), lines)
    streamed = spark.read.parquet(str(tmp_path / "curated")).select(batch.columns)
    assert Counter(streamed.collect()) == Counter(batch.collect())
    assert batch.count() == 1


def run_metrics(spark, tmp_path, sink):
    query = start_metrics_ingest(
        records(spark, tmp_path / "in"),
        "m",
        sink,
        str(tmp_path / "checkpoint"),
        topic="metrics",
        available_now=True,
    )
    assert wait(query, 120)


MESSAGES = [json.dumps({"clusterMetrics": {"totalMB": i, "appsRunning": i}}) for i in range(5)]


def test_metrics_ingest(spark, tmp_path):
    points, rejected = str(tmp_path / "points"), str(tmp_path / "rejected")
    sink = file_sink(points, rejected)
    add_records(spark, tmp_path / "in", [*MESSAGES, "broken"])
    run_metrics(spark, tmp_path, sink)
    run_metrics(spark, tmp_path, sink)
    rows = spark.read.parquet(points)
    assert rows.count() == 10
    assert rows.select("time_ns").distinct().count() == 5
    (bad,) = spark.read.parquet(rejected).collect()
    assert (bad.value, bad.kafka_offset, bad.reject_reason) == ("broken", 5, "not valid JSON")
    add_records(spark, tmp_path / "in", MESSAGES, 6)
    run_metrics(spark, tmp_path, sink)
    assert spark.read.parquet(points).count() == 20
    assert spark.read.parquet(rejected).count() == 1


def test_repeated_batch_gives_the_same_points(spark, tmp_path):
    """The sink fails after writing; the batch runs again and replaces its output."""
    points, rejected = str(tmp_path / "points"), str(tmp_path / "rejected")
    write = file_sink(points, rejected)
    seen = []

    def failing(batch):
        write(batch)
        seen.append(Counter(spark.read.parquet(points).collect()))
        if len(seen) == 1:
            raise RuntimeError("lost after the write")

    add_records(spark, tmp_path / "in", MESSAGES)
    with pytest.raises(Exception, match="lost after the write"):
        run_metrics(spark, tmp_path, failing)
    run_metrics(spark, tmp_path, failing)
    assert len(seen) == 2 and seen[0] == seen[1]
    assert spark.read.parquet(points).count() == 10


def test_store_sink_posts_one_line_for_each_message(spark, tmp_path, monkeypatch):
    posted = []
    monkeypatch.setattr(
        metrics_ingest, "post_lines", lambda lines, **store: posted.append((lines.collect(), store))
    )
    rejected = str(tmp_path / "rejected")
    sink = metrics_ingest.store_sink(rejected, url="u", org="o", bucket="b", token="t")
    add_records(spark, tmp_path / "in", [*MESSAGES, "broken"])
    run_metrics(spark, tmp_path, sink)
    ((lines, store),) = posted
    assert len({row.line for row in lines}) == 5
    assert store == {"url": "u", "org": "o", "bucket": "b", "token": "t"}
    assert spark.read.parquet(rejected).count() == 1


def test_kafka_options():
    assert kafka_options("a:1,b:2", "t") == {
        "kafka.bootstrap.servers": "a:1,b:2",
        "subscribe": "t",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
    }
    more = kafka_options(
        "a:1", "t", starting="latest", fail_on_data_loss=True, group_id="g",
        max_offsets_per_trigger=5, min_partitions=8,
    )
    assert more["startingOffsets"] == "latest"
    assert more["failOnDataLoss"] == "true"
    assert more["kafka.group.id"] == "g"
    assert (more["maxOffsetsPerTrigger"], more["minPartitions"]) == ("5", "8")
    with pytest.raises(ValueError):
        kafka_options("a:1", "t", starting="now")


def test_table_stream_reads_a_file_and_a_folder_alike(spark, sf_dir, tmp_path):
    """The driver's tables are one file or a folder of part files."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    events.repartition(4).write.parquet(str(tmp_path / "events.parquet"))
    for query in ("stream_raw", "stream_metrics"):
        one = catalogue.QUERIES[query](spark, sf_dir)
        many = catalogue.QUERIES[query](spark, str(tmp_path))
        assert one.count() > 0
        assert one.exceptAll(many).isEmpty() and many.exceptAll(one).isEmpty()
