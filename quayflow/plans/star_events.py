"""The star-schema tables seen as event sources.

The pipeline's own inputs are Kafka records. These functions derive the same
shapes from the given tables, row by row and without a shuffle, so that every
operator can run on them at any scale: each line item becomes one event document
with zero to two deliveries of zero to three visits, parts become lines,
suppliers stops, and web events cluster-metrics messages.
"""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayflow.functions.times import iso_utc
from quayflow.operators.raw import to_raw
from quayflow.operators.reference import identify_lines
from quayflow.session import compiled_methods, scratch_path
from quayflow.sinks.files import write_raw
from quayflow.sources.storage import child_names, file_state

EVENT_SOURCE = "star.lineitem"
EVENT_TOPIC = "lineitem-events"
METRICS_TOPIC = "cluster-metrics"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def timestamp(column: str) -> Column:
    """The tables hold zone-free timestamps; the session zone is UTC."""
    return F.col(column).cast("timestamp")


def _value(text: Column) -> Column:
    """JSON object of a ``value``; empty for NULL."""
    return F.to_json(F.struct(text.alias("value")))


def _array(count: Column, texts: list[Column]) -> Column:
    """JSON array of the first ``count`` texts, ``[]`` for none."""
    listed = F.lit("[]")
    for n in range(1, len(texts) + 1):
        parts = [part for text in texts[:n] for part in (F.lit(","), text)][1:]
        listed = F.when(count == n, F.concat(F.lit("["), *parts, F.lit("]"))).otherwise(listed)
    return listed


def _member(name: str, count: Column, texts: list[Column]) -> Column:
    """JSON object of an array of ``count`` texts; without any the array is missing or empty,
    by supplier parity."""
    missing = (F.coalesce(count, F.lit(0)) <= 0) & (F.col("l_suppkey") % 2 == 0)
    held = F.concat(F.lit(f'{{"{name}":'), _array(count, texts), F.lit("}"))
    return F.when(missing, "{}").otherwise(held)


def _expected_text(visit: int) -> Column:
    """The visit's expected departure, in one of three shapes."""
    minute = 60_000_000
    micros = F.col("_shipped") + (F.col("_number") * 60 + visit * 7) * minute + 123_000
    expected = F.timestamp_micros(micros)
    if visit == 1:
        return F.date_format(expected, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    if visit == 2:
        return F.date_format(expected, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return iso_utc(expected)


def _line_ref(visit: int) -> Column:
    """The visit's line; wrong case, no trailing colon and no reference stay unmatched."""
    part = (F.col("l_partkey") + (visit - 1)).cast("string")
    number = F.col("_number")
    line = F.when(number == 5, F.concat(F.lit("stif:line::c"), part, F.lit(":"))).when(
        number == 6, F.concat(F.lit("STIF:Line::C"), part)
    )
    if visit == 3:
        line = line.when(F.col("l_suppkey") % 5 == 0, F.lit(None))
    return line.otherwise(F.concat(F.lit("STIF:Line::C"), part, F.lit(":")))


def _after_item(visit: int) -> Column:
    """What follows a visit's identifier, up to the visit's end."""
    ref = F.concat(F.lit('{"value":"'), _line_ref(visit), F.lit('"}'))
    expected = F.when(
        (F.col("_number") + visit) % 5 != 0,
        F.concat(F.lit(',"ExpectedDepartureTime":"'), _expected_text(visit), F.lit('"')),
    )
    return F.concat(
        F.lit(f':{visit}","MonitoredVehicleJourney":{{"LineRef":'),
        F.coalesce(ref, F.lit("{}")),
        F.col("_journey"),
        F.coalesce(expected, F.lit("")),
        F.col("_after_times"),
    )


def _with_document(lineitem: DataFrame) -> DataFrame:
    """Add ``document``, the event text; some are broken, empty, NULL or carry an unreadable
    version.

    One to two deliveries hold up to three visits each, which differ in the delivery's number
    only, so what is the same for a document or for a visit's number is written once. Texts,
    not arrays of structs: lambda functions over arrays are interpreted, these are compiled
    if written under :func:`compiled_methods`.
    """
    hour = 3_600_000_000
    number = F.col("l_linenumber").cast("bigint")
    remainder = F.col("l_partkey") % 4
    n_deliveries = F.when(remainder == 0, 0).when(remainder == 2, 2).otherwise(1)
    shipped = F.unix_micros(timestamp("l_shipdate"))
    numbered = lineitem.withColumns(
        {"_number": number, "_shipped": shipped, "_deliveries": n_deliveries}
    )
    recorded = F.date_format(
        F.timestamp_micros(F.col("_shipped") + F.col("_number") * hour),
        "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'",
    )
    flag, supplier = F.col("l_returnflag"), F.col("l_suppkey").cast("string")
    number = F.col("_number")
    status = F.when(flag == "A", ',"DepartureStatus":"onTime"').when(
        flag == "N", ',"DepartureStatus":"delayed"'
    )
    direction = (
        F.when(number % 3 == 0, F.lit(""))
        .when(
            number % 3 == 2,
            F.concat(F.lit(',"DirectionName":['), _value(flag), F.lit(',{"value":"second"}]')),
        )
        .otherwise(F.lit(',"DirectionName":[]'))
    )
    at_stop = F.when(F.col("l_linestatus") == "O", ',"VehicleAtStop":true').when(
        F.col("l_linestatus") != "O", ',"VehicleAtStop":false'
    )
    undeclared = F.substring(F.to_json(F.struct(F.col("l_tax").alias("UndeclaredField"))), 2, 1 << 30)
    shared = numbered.withColumns(
        {
            "_before_item": F.concat(
                F.lit("{"),
                F.coalesce(
                    F.concat(F.lit('"RecordedAtTime":"'), recorded, F.lit('",')), F.lit("")
                ),
                F.lit('"ItemIdentifier":"'),
                F.concat_ws(":", "l_orderkey", "l_linenumber"),
                F.lit(":"),
            ),
            "_journey": F.concat(
                direction,
                F.lit(',"DestinationRef":{"value":"D'),
                supplier,
                F.lit('"},"DestinationName":['),
                _value(F.concat_ws(" - ", "l_returnflag", "l_suppkey")),
                F.lit('],"MonitoredCall":{"StopPointName":[{"value":"Stop '),
                supplier,
                F.lit('"}]'),
                F.coalesce(at_stop, F.lit("")),
            ),
            "_after_times": F.concat(
                F.coalesce(status, F.lit("")),
                F.lit('},"DirectionRef":'),
                _value(F.col("l_linestatus")),
                F.when(F.col("l_tax").isNull(), "}").otherwise(F.lit("},")),
                undeclared,
            ),
        }
    )
    # delivery 1 has (number + 1) % 4 visits, delivery 2 one more or none
    visits = shared
    for visit in (1, 2, 3):
        least = (number + 1) % 4
        wanted = (least >= visit) | ((F.col("_deliveries") == 2) & ((number + 2) % 4 >= visit))
        visits = visits.withColumn(f"_visit{visit}", F.when(wanted, _after_item(visit)))
    delivered = visits
    for delivery in (1, 2):
        texts = [
            F.concat(F.col("_before_item"), F.lit(str(delivery)), F.col(f"_visit{visit}"))
            for visit in (1, 2, 3)
        ]
        held = _member("MonitoredStopVisit", (number + delivery) % 4, texts)
        delivered = delivered.withColumn(
            f"_delivery{delivery}", F.when(F.col("_deliveries") >= delivery, held)
        )
    service = _member(
        "StopMonitoringDelivery",
        F.col("_deliveries"),
        [F.col("_delivery1"), F.col("_delivery2")],
    )
    produced = F.timestamp_micros(F.col("_shipped") + F.col("l_orderkey") % 1_000_000)
    version = F.when(F.col("l_quantity") == 13, '"x"').otherwise("1")
    text = F.concat(
        F.lit(f'{{"event_source":"{EVENT_SOURCE}","event_version":'),
        version,
        F.lit(',"producer_ts":"'),
        iso_utc(produced),
        F.lit('","monitoring_ref":"STIF:StopPoint:Q:'),
        F.col("l_suppkey"),
        F.lit(':","payload":{"Siri":{"ServiceDelivery":'),
        service,
        F.lit("}}}"),
    )
    document = (
        F.when(F.col("l_quantity") == 29, F.concat(F.lit("#"), text))
        .when(F.col("l_quantity") == 31, "")
        .when(F.col("l_quantity") == 37, F.lit(None))
        .otherwise(text)
    )
    return delivered.withColumn("document", document)


def lineitem_records(lineitem: DataFrame) -> DataFrame:
    """Line items as Kafka records, plus ``ingested`` for a reproducible ingestion time."""
    hours = F.col("l_linenumber").cast("bigint") * 3_600_000_000
    arrived = F.timestamp_micros(F.unix_micros(timestamp("l_shipdate")) + hours)
    year = F.date_trunc("year", timestamp("l_shipdate"))
    return _with_document(lineitem).select(
        F.concat(F.lit("STIF:StopPoint:Q:"), F.col("l_suppkey"), F.lit(":"))
        .cast("binary")
        .alias("key"),
        F.col("document").cast("binary").alias("value"),
        F.lit(EVENT_TOPIC).alias("topic"),
        (F.col("l_suppkey") % 8).cast("int").alias("partition"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("offset"),
        arrived.alias("timestamp"),
        F.timestamp_micros(F.unix_micros(year) + hours).alias("ingested"),
    )


def lineitem_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items in the raw layer's shape."""
    lineitem = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        "l_quantity",
        "l_tax",
        "l_returnflag",
        "l_linestatus",
        "l_shipdate",
    )
    return to_raw(lineitem_records(lineitem), F.col("ingested"))


_written: dict[tuple, str] = {}


def _files_of(spark: SparkSession, sf_dir: str) -> tuple:
    """What tells the input files of the layers from rewritten ones."""
    names = [n for t in ("lineitem", "part") for n in table(spark, sf_dir, t).inputFiles()]
    return tuple(file_state(spark, unquote(name)) for name in names)


def stored_layer(
    spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]
) -> str:
    """Path of a layer, written on first use by this application.

    The pipeline keeps its layers as tables, and so do the queries on it: each starts
    from the layer below its own and does not build that one again. Input files that
    were rewritten since give a layer of their own.
    """
    key = (spark.sparkContext.applicationId, sf_dir, name, *_files_of(spark, sf_dir))
    if key not in _written or not child_names(spark, _written[key]):
        path = scratch_path(spark, name)
        write(path)
        _written[key] = path
    return _written[key]


def raw_layer(spark: SparkSession, sf_dir: str) -> str:
    """Path of the raw table of all line items."""

    def write(path: str) -> None:
        with compiled_methods(spark):
            write_raw(lineitem_raw(spark, sf_dir), path)

    return stored_layer(spark, sf_dir, "raw", write)


def part_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as lines; parts over size 25 are not of interest and have no label."""
    parts = table(spark, sf_dir, "part").select(
        F.concat(F.lit("FR1:Line:C"), F.col("p_partkey"), F.lit(":")).alias("line_id"),
        F.when(F.col("p_size") <= 25, F.col("p_type")).alias("roi_label"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("short_name"),
        F.lower("p_type").alias("transport_mode"),
    )
    return identify_lines(parts)


def event_records(events: DataFrame) -> DataFrame:
    """Web events as Kafka records."""
    return events.select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.col("props").cast("binary").alias("value"),
        F.col("event_type").alias("topic"),
        (F.col("user_id") % 8).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        timestamp("ts").alias("timestamp"),
    )


def metrics_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The web events' cluster-metrics messages."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")
    return metrics_records(events)


def far_time(event: Column, at: Column) -> Column:
    """Times of some records beyond the years of a nanosecond time, as a producer may set."""
    return (
        F.when(event % 61 == 7, F.lit("2300-01-01 00:00:00").cast("timestamp"))
        .when(event % 61 == 8, F.lit("1600-01-01 00:00:00").cast("timestamp"))
        .otherwise(at)
    )


def metrics_records(events: DataFrame) -> DataFrame:
    """Web events as cluster-metrics messages with every JSON type in the fields."""
    event = F.col("event_id")
    cents = F.round(F.col("value") * 100).cast("bigint")
    pending = (
        F.when(event % 7 == 0, '"12"')
        .when(event % 7 == 1, "true")
        .when(event % 7 == 2, F.concat(event.cast("string"), F.lit(".9")))
        .when(event % 49 == 3, '"x"')
        .when(event % 49 == 10, "null")
        .otherwise(event.cast("string"))
    )
    running = (
        F.when(event % 5 == 0, '"7"')
        .when(event % 5 == 1, "false")
        .when(event % 5 == 2, "3.7")
        .when(event % 5 == 3, "null")
        .otherwise(F.col("user_id").cast("string"))
    )
    busy = F.when(event % 3 == 0, "true").when(event % 3 == 1, "5").otherwise('"n/a"')
    total_nodes = F.concat(F.lit(',"totalNodes":'), F.col("user_id"))
    nodes = F.when(event % 2 == 0, total_nodes).otherwise("")
    text = F.concat(
        F.lit('{"clusterMetrics":{"totalMB":'),
        cents,
        F.lit(',"availableMB":'),
        pending,
        F.lit(',"utilizedMBPercent":'),
        F.concat(F.floor(cents / 4).cast("string"), F.lit(".5")),
        F.lit(',"appsRunning":'),
        running,
        F.lit(',"rmSchedulerBusyPercent":'),
        busy,
        nodes,
        F.lit(',"unknown":1}}'),
    )
    document = (
        F.when(event % 53 == 0, F.concat(text, F.lit(" tail")))
        .when(event % 53 == 1, "[1]")
        .when(event % 53 == 2, '{"clusterMetrics":null}')
        .when(event % 53 == 3, "{}")
        .otherwise(text)
    )
    return events.select(
        F.lit(None).cast("binary").alias("key"),
        document.cast("binary").alias("value"),
        F.lit(METRICS_TOPIC).alias("topic"),
        (F.col("user_id") % 8).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        far_time(F.col("event_id"), timestamp("ts")).alias("timestamp"),
    )
