"""Every operator as a query over the star-schema tables.

Timestamps are returned as microseconds since the epoch and dates as text, so
that the results compare with any other engine's.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayflow.functions.texts import normalise_name
from quayflow.functions.times import epoch_nanos
from quayflow.operators.counts import row_count
from quayflow.operators.events import build_events, fetch_counts, keyed_records, stop_labels
from quayflow.operators.lines import join_lines
from quayflow.operators.metrics import (
    metric_lines,
    metric_points,
    metric_time,
    placed,
    read_metrics,
    rejected_messages,
)
from quayflow.operators.passages import (
    explode_visits,
    lift_deliveries,
    line_refs_of,
    parse_events,
    passages,
    project_passages,
    visits_of,
)
from quayflow.operators.points import (
    INSERTED_AT_FIELD,
    kpi_ready,
    line_protocol,
    point_time,
    to_points,
)
from quayflow.operators.raw import to_raw
from quayflow.operators.reference import identify_stops, observed_lines, select_roi_stops
from quayflow.plans.curated import curated_rows, enriched_rows, refresh_curated
from quayflow.plans.export import export_points
from quayflow.plans.publish import publish_events, publish_metrics
from quayflow.plans.references import line_reference
from quayflow.plans.star_events import (
    METRICS_TOPIC,
    event_records,
    far_time,
    metrics_messages,
    metrics_records,
    part_lines,
    raw_layer,
    stored_layer,
    table,
)
from quayflow.session import scratch_path
from quayflow.sinks.files import write_curated, write_lines, write_points, write_raw
from quayflow.sources.tables import curated_table, message_lines, raw_table, stops_csv
from quayflow.streaming.control import wait
from quayflow.streaming.metrics_ingest import file_sink, start_metrics_ingest
from quayflow.streaming.raw_ingest import start_raw_ingest

Query = Callable[[SparkSession, str], DataFrame]

ONE_DAY = "2024-01-15"
PART_KEYWORDS = {"RING": "ring", "RED": "red", "OLD_BOLT": "old bolt"}


def plain(df: DataFrame) -> DataFrame:
    """Timestamps as microseconds, dates as text."""

    def column(field: T.StructField) -> Column:
        value = F.col(field.name)
        if isinstance(field.dataType, T.TimestampType):
            return F.unix_micros(value).alias(field.name)
        if isinstance(field.dataType, T.DateType):
            return value.cast("string").alias(field.name)
        return value

    return df.select(*[column(field) for field in df.schema.fields])


# raw layer


def _event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_raw(event_records(table(spark, sf_dir, "events")), F.col("timestamp"))


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_event_rows(spark, sf_dir))


def raw_one_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "raw")
    write_raw(_event_rows(spark, sf_dir), path)
    return plain(raw_table(spark, path, ONE_DAY))


def _table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table as a stream of its files: one file of that name or a folder of parts.

    Streams list folders; as a pattern the path may be a file as well.
    """
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.[p]arquet")


def stream_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "raw")
    query = start_raw_ingest(
        event_records(_table_stream(spark, sf_dir, "events")),
        path,
        scratch_path(spark, "checkpoint"),
        available_now=True,
        ingest_ts=F.col("timestamp"),
    )
    wait(query)
    return plain(raw_table(spark, path))


# events


def _outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as fetches: blank and padded references, errors, broken payloads, numbers of
    1,500 digits and values nested 900 deep occur."""
    key = F.col("c_custkey")
    ref = F.concat(F.lit("STIF:StopPoint:Q:"), key, F.lit(":"))
    payload = F.concat(
        F.lit('{"Name": "'),
        F.col("c_name"),
        F.lit(' — né", "Segment": "'),
        F.col("c_mktsegment"),
        F.lit('", "Nation": '),
        F.col("c_nationkey"),
        F.lit(', "Balance": 1.50, "none": null}'),
    )
    return table(spark, sf_dir, "customer").select(
        F.when(key % 11 == 0, F.lit(None))
        .when(key % 11 == 1, " \t ")
        .when(key % 11 == 2, F.concat(F.lit("\t "), ref, F.lit(" \n")))
        .otherwise(ref)
        .alias("monitoring_ref"),
        F.when(key % 13 == 0, F.lit(None))
        .when(key % 13 == 1, F.concat(payload, F.lit(" tail")))
        .when(key % 13 == 2, F.concat(payload, F.lit("}")))
        .when(key % 13 == 3, F.concat(F.lit('{"broken": '), payload))
        .when(key % 13 == 4, F.concat(F.lit('{"same": 1, "same": '), payload, F.lit("}")))
        .when(key % 13 == 5, F.concat(F.lit('{"n": ' + "7" * 1500 + ', "v": '), payload, F.lit("}")))
        .when(key % 13 == 6, F.concat(F.lit("[" * 900), payload, F.lit("]" * 900)))
        .otherwise(payload)
        .alias("payload"),
        F.when(key % 17 == 0, "timeout").alias("error"),
        F.timestamp_micros(F.lit(1_704_067_200_000_000) + key * 250_001).alias("fetched_at"),
    )


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_events(
        _outcomes(spark, sf_dir), "star.customer", producer_ts=F.col("fetched_at")
    )


def envelope_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir)


def keyed_event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed_records(_events(spark, sf_dir), "event", "monitoring_ref")


def unkeyed_metric_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job's function on files of messages, with a folder in place of the topic."""
    lines, sent = scratch_path(spark, "messages"), scratch_path(spark, "sent")
    records = metrics_records(table(spark, sf_dir, "events"))
    write_lines(records.select(F.col("value").cast("string")), lines)
    publish_metrics(message_lines(spark, lines), "message", lambda r: r.write.parquet(sent))
    return spark.read.parquet(sent)


def fetch_outcome_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fetch_counts(_outcomes(spark, sf_dir))


def publish_batch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job's function with suppliers as stops and customers as outcomes, and a folder in
    place of the topic: stops occur that are unlisted, that have no outcome and that have two."""
    key = F.col("s_suppkey")
    stops = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit(" STIF:StopPoint:Q:"), key * 2, F.lit(":")).alias("siri_monitoring_ref")
    )
    outcomes, sent = _outcomes(spark, sf_dir), scratch_path(spark, "sent")
    again = outcomes.where("monitoring_ref LIKE '%4:%'")
    counts = publish_events(
        stops, outcomes.union(again), "star.customer", lambda events: events.write.parquet(sent)
    )
    numbers = [F.lit(n).cast("bigint").alias(name) for name, n in counts._asdict().items()]
    return spark.read.parquet(sent).agg(F.count(F.lit(1)).alias("n_sent")).select(*numbers, "n_sent")


def run_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of a run share one ingestion time and date."""
    rows = to_raw(event_records(table(spark, sf_dir, "events")))
    return rows.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("ingest_ts").alias("n_times"),
        F.count_distinct("ingest_date").alias("n_dates"),
    )


def ingest_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream that starts again with its checkpoint adds nothing."""
    path, checkpoint = scratch_path(spark, "raw"), scratch_path(spark, "checkpoint")
    counts = []
    for _ in range(2):
        query = start_raw_ingest(
            event_records(_table_stream(spark, sf_dir, "events")),
            path,
            checkpoint,
            available_now=True,
            ingest_ts=F.col("timestamp"),
        )
        wait(query)
        counts.append(raw_table(spark, path).count())
    first, second = (F.lit(n).cast("bigint") for n in counts)
    return row_count(raw_table(spark, path)).select(
        first.alias("first_run"), second.alias("second_run"), F.col("rows").alias("n_rows")
    )


def batch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcomes = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_custkey") % 10 != 0, F.col("o_custkey").cast("string")).alias(
            "monitoring_ref"
        ),
        F.when(F.col("o_orderstatus") != "P", F.to_json(F.struct("o_orderkey"))).alias("payload"),
        F.when(F.col("o_orderstatus") == "P", "pending").alias("error"),
    )
    return fetch_counts(outcomes)


def stop_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    stops = table(spark, sf_dir, "supplier").select(
        F.when(key % 5 == 0, F.lit(None))
        .when(key % 5 == 1, "  ")
        .otherwise(F.concat(F.lit(" "), key, F.lit(" ")))
        .alias("siri_monitoring_ref"),
        F.when(key % 3 != 0, F.col("s_name")).alias("name"),
        F.when(key % 4 != 0, F.concat(F.lit("NATION_"), F.col("s_nationkey"))).alias("roi_station"),
    )
    return stop_labels(stops)


# passages


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_table(spark, raw_layer(spark, sf_dir))


def parse_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The web events' own documents, read as events with a schema of their own."""
    parsed = parse_events(_event_rows(spark, sf_dir), "k int")
    return parsed.select(F.col("kafka_offset").alias("event_id"), "event.k")


def parsed_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    lifted = lift_deliveries(parse_events(_raw(spark, sf_dir)))
    return lifted.select(
        "kafka_key",
        "kafka_offset",
        "event_source",
        "event_version",
        "producer_ts_raw",
        "monitoring_ref",
        F.size("deliveries").alias("n_deliveries"),
    )


def flatten_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    visits = explode_visits(lift_deliveries(parse_events(_raw(spark, sf_dir))))
    journey = "visit.MonitoredVehicleJourney"
    return visits.select(
        "kafka_key",
        "kafka_offset",
        "event_version",
        F.col("visit.ItemIdentifier").alias("item_identifier"),
        F.col(f"{journey}.LineRef.value").alias("line_ref"),
        F.col(f"{journey}.MonitoredCall.VehicleAtStop").alias("vehicle_at_stop"),
    )


def all_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(passages(_raw(spark, sf_dir)))


def passages_strict_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(passages(_raw(spark, sf_dir), "strict"))


# enrichment


def _visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visits_of(_raw(spark, sf_dir))


def _curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curated_rows(_visits(spark, sf_dir), part_lines(spark, sf_dir))


def enrich_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(enriched_rows(_visits(spark, sf_dir), part_lines(spark, sf_dir)))


def enrich_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    visits = project_passages(_visits(spark, sf_dir))
    return plain(join_lines(visits, part_lines(spark, sf_dir), salt=8))


def enrich_roi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_curated(spark, sf_dir))


def curated_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "curated")
    write_curated(_curated(spark, sf_dir), path)
    return plain(curated_table(spark, path))


def curated_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch job from files to files, with the line table as CSV."""
    lines, curated = scratch_path(spark, "lines"), scratch_path(spark, "curated")
    part_lines(spark, sf_dir).write.option("header", True).csv(lines)
    refresh_curated(spark, raw_layer(spark, sf_dir), lines, curated)
    return plain(curated_table(spark, curated))


def layer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the layers; those of the curated layer and of its points in one pass."""
    raw = row_count(_raw(spark, sf_dir), "n_rows").select(F.lit("raw").alias("layer"), "n_rows")
    counts = _curated(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("curated"),
        F.count_if(F.col("expected_departure_time").isNotNull()).alias("kpi"),
    )
    named = [F.struct(F.lit(n).alias("layer"), F.col(n).alias("n_rows")) for n in ("curated", "kpi")]
    return raw.union(counts.select(F.inline(F.array(*named))))


# points


def curated_layer(spark: SparkSession, sf_dir: str) -> str:
    """Path of the curated table of all line items."""
    return stored_layer(
        spark, sf_dir, "curated", lambda path: write_curated(_curated(spark, sf_dir), path)
    )


def _kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi_ready(curated_table(spark, curated_layer(spark, sf_dir)))


def kpi_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_kpi(spark, sf_dir))


def point_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = passages(_raw(spark, sf_dir))
    return rows.select(
        "kafka_key",
        "kafka_offset",
        "item_identifier",
        epoch_nanos(point_time(rows)).alias("time_ns"),
    )


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points without the field that holds the time of the run."""
    points = to_points(_kpi(spark, sf_dir), "passages")
    return points.withColumn("fields", F.col("fields").dropFields(INSERTED_AT_FIELD))


def point_tags_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _points(spark, sf_dir).select("measurement", "tags.*", "fields.*", "time_ns")


def export_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the export reports, and the points and insertion times that it wrote."""
    path = scratch_path(spark, "points")
    counts = export_points(
        spark, curated_layer(spark, sf_dir), "passages", lambda points: write_points(points, path)
    )
    return spark.read.parquet(path).agg(
        F.lit(counts.points).cast("bigint").alias("n_reported"),
        F.count(F.lit(1)).alias("n_written"),
        F.count_distinct(f"fields.{INSERTED_AT_FIELD}").alias("n_stamps"),
    )


def point_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_protocol(_points(spark, sf_dir))


def point_text_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "lines")
    write_lines(point_lines(spark, sf_dir), path)
    return spark.read.text(path).select(F.col("value").alias("line"))


# metrics


def _read_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = read_metrics(metrics_messages(spark, sf_dir))
    return placed(read, metric_time("offset", F.col("timestamp")))


def metrics_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    read, time_ns = _read_metrics(spark, sf_dir), F.col("time_ns")
    points = metric_points(read, METRICS_TOPIC, "cluster", time_ns, ("offset",), "partition")
    return points.withColumnRenamed("offset", "kafka_offset")


def metrics_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = _read_metrics(spark, sf_dir)
    return metric_lines(read, METRICS_TOPIC, "cluster", F.col("time_ns"), "partition")


def metrics_point_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted messages with fields and their points, for offsets that repeat in the
    partitions and one time for the whole batch but the records with a far one."""
    messages = metrics_messages(spark, sf_dir).withColumns(
        {
            "partition": (F.col("offset") % 8).cast("int"),
            "event": F.col("offset"),
            "offset": F.expr("offset DIV 8"),
            "timestamp": far_time(F.col("offset"), F.timestamp_seconds(F.lit(1_700_000_000))),
        }
    )
    read = read_metrics(messages.withColumn("kafka_partition", F.col("partition")))
    read = placed(read, metric_time("offset", F.col("timestamp")))
    points = metric_points(read, METRICS_TOPIC, "cluster", F.col("time_ns"), ("event",))
    identity = F.struct("source", "rm_host", "topic", "partition", "time_ns")
    return points.agg(
        F.count_distinct("event").alias("n_messages"), F.count_distinct(identity).alias("n_points")
    )


def metrics_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejected_messages(_read_metrics(spark, sf_dir)).select(
        F.col("offset").alias("kafka_offset"),
        F.col("value").cast("string").alias("message"),
        "reject_reason",
    )


def stream_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    points, rejected = scratch_path(spark, "points"), scratch_path(spark, "rejected")
    query = start_metrics_ingest(
        metrics_records(_table_stream(spark, sf_dir, "events")),
        "cluster",
        file_sink(points, rejected),
        scratch_path(spark, "checkpoint"),
        topic=METRICS_TOPIC,
        available_now=True,
        record_time=F.col("timestamp"),
    )
    wait(query)
    return spark.read.parquet(points).drop("batch_id", "kafka_topic", "kafka_partition")


# reference tables


def stop_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    candidates = table(spark, sf_dir, "customer").select(
        F.when(key % 9 == 0, F.concat(F.lit("FR::StopPlace:Q"), key, F.lit(":FR1")))
        .otherwise(F.concat(F.lit("FR::monomodalStopPlace:"), key, F.lit(":FR1")))
        .alias("id")
    )
    return identify_stops(candidates)


def line_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return part_lines(spark, sf_dir).select("line_id", "line_code", "siri_line_ref")


def name_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return documents.select("doc_id", normalise_name(F.col("text")).alias("name_norm"))


def roi_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return select_roi_stops(parts, PART_KEYWORDS, name="p_name").drop("p_name")


def roi_match_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return select_roi_stops(parts, PART_KEYWORDS, name="p_name", whole_words=True).drop("p_name")


def stops_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as a stop table in CSV, with quotes and line breaks in the names."""
    path = scratch_path(spark, "stops")
    name = F.concat(F.lit('"'), F.col("s_name"), F.lit('",\nné'))
    stops = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("id"),
        F.when(F.col("s_suppkey") % 3 > 0, name).otherwise(F.col("s_name")).alias("name"),
        F.when(F.col("s_suppkey") % 4 > 0, F.col("s_nationkey").cast("string")).alias("town"),
    )
    stops.write.option("header", True).option("escape", '"').csv(path)
    return stops_csv(spark, path)


def line_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as lines, those up to size 25 selected by a table of labels."""
    parts = part_lines(spark, sf_dir)
    selection = parts.select("line_id", "roi_label")
    reference = line_reference(parts, line_refs_of(_raw(spark, sf_dir)), selection)
    return reference.select("line_id", "siri_line_ref", "roi_label")


def lines_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = part_lines(spark, sf_dir)
    refs = line_refs_of(_raw(spark, sf_dir))
    return observed_lines(lines, refs).select("line_id", "siri_line_ref", "name")


QUERIES: dict[str, Query] = {
    "raw_records": raw_records,
    "raw_one_day": raw_one_day,
    "stream_raw": stream_raw,
    "build_events": envelope_events,
    "keyed_event_records": keyed_event_records,
    "unkeyed_metric_records": unkeyed_metric_records,
    "fetch_outcome_counts": fetch_outcome_counts,
    "batch_counts": batch_counts,
    "publish_counts": publish_batch_counts,
    "stop_list": stop_list,
    "parse_props": parse_props,
    "parsed_envelopes": parsed_envelopes,
    "flatten_outer": flatten_outer,
    "passages": all_passages,
    "passages_strict_times": passages_strict_times,
    "enrich_left": enrich_left,
    "enrich_salted": enrich_salted,
    "enrich_roi": enrich_roi,
    "curated_roundtrip": curated_roundtrip,
    "curated_job": curated_job,
    "layer_counts": layer_counts,
    "kpi_ready": kpi_rows,
    "point_time": point_times,
    "point_tags_fields": point_tags_fields,
    "point_lines": point_lines,
    "point_text_sink": point_text_sink,
    "metrics_points": metrics_points,
    "metrics_lines": metrics_lines,
    "metrics_point_identity": metrics_point_identity,
    "metrics_rejected": metrics_rejected,
    "stream_metrics": stream_metrics,
    "stop_ids": stop_ids,
    "line_ids": line_ids,
    "name_norm": name_norm,
    "roi_match": roi_match,
    "roi_match_words": roi_match_words,
    "lines_observed": lines_observed,
    "line_selection": line_selection,
    "stops_roundtrip": stops_roundtrip,
    "run_stamps": run_stamps,
    "ingest_twice": ingest_twice,
    "export_counts": export_counts,
}
