"""What running the pipeline needs beyond the layers themselves, as queries.

Like the catalogue, these run on the star-schema tables and return times as microseconds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayflow.functions.texts import normalise_name
from quayflow.operators.keywords import match_keywords
from quayflow.operators.kpis import (
    departure_kpis,
    headways,
    merge_kpis,
    with_quantiles,
)
from quayflow.operators.offsets import offset_report, offset_summary
from quayflow.operators.passages import project_passages, visits_of
from quayflow.operators.validity import join_lines_as_of, with_validity
from quayflow.operators.visits import REPORT_ORDER, last_reports
from quayflow.plans.catalogue import Query, curated_layer, plain
from quayflow.plans.compaction import compact_raw
from quayflow.plans.curated import curated_rows, refresh_versions
from quayflow.plans.star_events import part_lines, raw_layer, table
from quayflow.schemas import CURATED
from quayflow.session import scratch_path
from quayflow.sinks.files import write_raw
from quayflow.sources.tables import curated_table, raw_stream, raw_table
from quayflow.streaming.control import wait
from quayflow.streaming.curated_stream import HotLines, start_curated_stream
from quayflow.streaming.departure_kpis import start_departure_kpis
from quayflow.streaming.visit_reports import start_visit_reports

# lost and repeated offsets


def delivered_records(events: DataFrame) -> DataFrame:
    """Web events as the records of eight topic partitions, some lost and some repeated.

    Every 97th event is lost, and eight of every 500 offsets; every 300 offsets a source
    went on 40,000 later. Every 89th event comes three times.
    """
    event = F.col("event_id")
    number = F.expr("event_id DIV 8")
    lost = (event % 97 == 0) | (number % 500).between(100, 107)
    times = F.when(event % 89 == 0, 3).otherwise(1)
    return events.where(~lost).select(
        F.lit("deliveries").alias("kafka_topic"),
        (event % 8).cast("int").alias("kafka_partition"),
        (number + F.expr("(event_id DIV 8) DIV 300") * 40_000).alias("kafka_offset"),
        F.explode(F.array_repeat(F.lit(1), times)).alias("delivery"),
    )


def offset_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return offset_report(delivered_records(table(spark, sf_dir, "events").select("event_id")))


def offset_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return offset_summary(delivered_records(table(spark, sf_dir, "events").select("event_id")))


# repeated reports

STOP_KEYS = ("kafka_key", "direction_ref")
REPORT_GAP = "100 hours 30 minutes"
REPORT_DELAY = "30 days"
_REPORT_COLUMNS = [
    "kafka_key",
    "direction_ref",
    "recorded_at_time",
    "kafka_offset",
    "item_identifier",
    "n_reports",
    "first_reported",
    "settled_at",
]


def _reports_of(raw: DataFrame) -> DataFrame:
    """Visits with the columns that reports are told apart and shown by.

    A report is moved whole, so columns nobody asks for are left behind before.
    """
    names = dict.fromkeys((*STOP_KEYS, "recorded_at_time", *REPORT_ORDER))
    return project_passages(visits_of(raw)).select(*names)


def visit_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visits of a stop and direction as reports of one, as long as they follow closely."""
    visits = _reports_of(raw_table(spark, raw_layer(spark, sf_dir)))
    return plain(last_reports(visits, STOP_KEYS, REPORT_GAP).select(_REPORT_COLUMNS))


def stream_visit_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "reports")
    visits = _reports_of(raw_stream(spark, raw_layer(spark, sf_dir)))
    query = start_visit_reports(
        visits,
        path,
        scratch_path(spark, "checkpoint"),
        keys=STOP_KEYS,
        gap=REPORT_GAP,
        delay=REPORT_DELAY,
        available_now=True,
    )
    wait(query)
    return plain(spark.read.parquet(path).select(_REPORT_COLUMNS))


# departure indicators

_KPI_COLUMNS = ["n_departures", "n_delayed", "n_values", "sum_value", "min_value", "max_value"]
HEADWAY_KEYS = ("roi_label", "direction_ref")
RANKS = (0.5, 0.9)
RANK_ERROR = 0.04


def _departures(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = curated_table(spark, curated_layer(spark, sf_dir))
    columns = [*HEADWAY_KEYS, "expected_departure_time", "departure_status"]
    return headways(rows.select(columns), HEADWAY_KEYS)


def _period(df: DataFrame) -> DataFrame:
    start = F.unix_micros("period.start").alias("period_start")
    return df.select(start, *[name for name in df.columns if name != "period"])


def daily_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    kpis = departure_kpis(_departures(spark, sf_dir), "headway_seconds", "1 day")
    return _period(kpis.drop("sketch"))


def headway_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles of four weeks' headways from daily sketches, held against the exact ranks."""
    rows = _departures(spark, sf_dir)
    daily = departure_kpis(rows, "headway_seconds", "1 day")
    merged = with_quantiles(merge_kpis(daily, "28 days"), RANKS).select(
        "period", "roi_label", "n_departures", "n_values", "quantiles"
    )
    exact = rows.where("headway_seconds IS NOT NULL").select(
        F.window("expected_departure_time", "28 days").alias("period"), "roi_label", "headway_seconds"
    )
    checks = []
    for i, rank in enumerate(RANKS):
        value = F.col("quantiles")[i]
        below = F.count_if(F.col("headway_seconds") < value) / F.first("n_values")
        up_to = F.count_if(F.col("headway_seconds") <= value) / F.first("n_values")
        near = (below <= rank + RANK_ERROR) & (up_to >= rank - RANK_ERROR)
        checks.append(near.alias(f"p{round(100 * rank)}_in_bound"))
    found = exact.join(merged, ["period", "roi_label"]).groupBy("period", "roi_label").agg(
        F.first("n_departures").alias("n_departures"), F.first("n_values").alias("n_values"), *checks
    )
    return _period(found)


def stream_departure_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily indicators from the raw layer's files; the last days stay open."""
    path = scratch_path(spark, "kpis")
    raw = raw_stream(spark, raw_layer(spark, sf_dir))
    query = start_departure_kpis(
        curated_rows(visits_of(raw), part_lines(spark, sf_dir)),
        path,
        scratch_path(spark, "checkpoint"),
        window="1 day",
        delay="36 hours",
        available_now=True,
    )
    wait(query)
    return _period(spark.read.parquet(path).drop("sketch"))


# versions of the layers


def _halves(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The line items' raw rows as two batches that arrive one after the other."""
    raw = raw_table(spark, raw_layer(spark, sf_dir))
    return [raw.where(F.col("kafka_offset") % 2 == half) for half in (0, 1)]


def _lines_file(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "lines")
    part_lines(spark, sf_dir).write.option("header", True).csv(path)
    return path


def curated_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A refresh of all, then one of the raw files that came since."""
    raw, curated = scratch_path(spark, "raw"), scratch_path(spark, "curated")
    lines = _lines_file(spark, sf_dir)
    for half in _halves(spark, sf_dir):
        write_raw(half, raw)
        refresh_versions(spark, raw, lines, curated, incremental=True)
    return plain(curated_table(spark, curated))


def refresh_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What two incremental refreshes and one without new files report."""
    raw, curated = scratch_path(spark, "raw"), scratch_path(spark, "curated")
    lines = _lines_file(spark, sf_dir)
    counts = []
    for half in [*_halves(spark, sf_dir), None]:
        if half is not None:
            write_raw(half, raw)
        counts.append(refresh_versions(spark, raw, lines, curated, incremental=True))
    rows = [(n, c["raw_rows"], c["curated_rows"]) for n, c in enumerate(counts, 1)]
    return spark.createDataFrame(rows, "refresh int, raw_rows bigint, curated_rows bigint")


def raw_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw layer after all its dates were compacted and more arrived for them."""
    path = scratch_path(spark, "raw")
    first, second = _halves(spark, sf_dir)
    write_raw(first, path)
    dates = [row.ingest_date for row in raw_table(spark, path).select("ingest_date").distinct().collect()]
    for day in dates:
        compact_raw(spark, path, day.isoformat())
    write_raw(second, path)
    return plain(raw_table(spark, path).drop("raw_json"))


# lines and keywords


def _line_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as lines that change up to twice: name from the start, label later or never."""
    key = F.col("p_partkey")
    micros = F.lit(694_224_000_000_000) + (key % 90) * 30 * 86_400_000_000
    first = F.timestamp_micros(micros)
    second = F.timestamp_micros(micros + 400 * 86_400_000_000)
    change = lambda at, name, kept: F.struct(at.alias("valid_from"), name.alias("name"), kept.alias("kept"))
    changes = F.array(
        change(F.lit(None).cast("timestamp"), F.col("name"), key % 4 > 0),
        change(first, F.concat(F.col("name"), F.lit(" II")), F.lit(True)),
        change(second, F.concat(F.col("name"), F.lit(" III")), key % 3 > 0),
    )
    lines = part_lines(spark, sf_dir).withColumn("p_partkey", F.regexp_extract("line_code", r"\d+", 0).cast("bigint"))
    rows = lines.select("siri_line_ref", "roi_label", "short_name", "transport_mode", F.explode(changes).alias("c"))
    rows = rows.where("c.kept").select("siri_line_ref", "roi_label", "short_name", "transport_mode", "c.valid_from", "c.name")
    return with_validity(rows)


def lines_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each visit with its line as it was when the visit was recorded."""
    visits = project_passages(visits_of(raw_table(spark, raw_layer(spark, sf_dir))))
    joined = join_lines_as_of(visits, _line_changes(spark, sf_dir))
    return plain(joined.select("kafka_offset", "item_identifier", "line_ref", "recorded_at_time", "name", "roi_label"))


def keyword_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts whose name holds a keyword; keywords come from customers, short ones among them."""
    key = F.col("c_custkey")
    words = F.array(
        F.concat_ws(" ", F.lit("brand"), key % 40, key), (key % 1000).cast("string"), F.lit("")
    )
    keywords = table(spark, sf_dir, "customer").select(F.explode(words).alias("keyword")).distinct()
    name = normalise_name(F.concat_ws(" ", "p_name", "p_brand", "p_partkey"))
    names = table(spark, sf_dir, "part").select("p_partkey", name.alias("name_norm"))
    return match_keywords(names, keywords)


def stream_curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw layer's files as a stream, a few at a time, hot lines spread from the second on."""
    path = scratch_path(spark, "curated")
    query = start_curated_stream(
        raw_stream(spark, raw_layer(spark, sf_dir), max_files_per_trigger=8),
        part_lines(spark, sf_dir),
        path,
        scratch_path(spark, "checkpoint"),
        hot=HotLines(share=0.001),
        available_now=True,
    )
    wait(query)
    rows = spark.read.schema(f"{CURATED}, batch_id int").parquet(path)
    return plain(rows.drop("batch_id"))


QUERIES: dict[str, Query] = {
    "offset_gaps": offset_gaps,
    "offset_totals": offset_totals,
    "visit_reports": visit_reports,
    "stream_visit_reports": stream_visit_reports,
    "daily_kpis": daily_kpis,
    "headway_quantiles": headway_quantiles,
    "stream_departure_kpis": stream_departure_kpis,
    "curated_incremental": curated_incremental,
    "refresh_counts": refresh_counts,
    "raw_compacted": raw_compacted,
    "lines_as_of": lines_as_of,
    "keyword_match": keyword_match,
    "stream_curated": stream_curated,
}
