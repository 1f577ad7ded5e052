from datetime import date, datetime

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quayflow.operators.counts import row_count
from quayflow.operators.points import (
    INSERTED_AT_FIELD,
    TAG_COLUMNS,
    TIME_COLUMNS,
    kpi_ready,
    line_protocol,
    point_time,
    to_points,
)
from quayflow.plans.export import export_points
from quayflow.schemas import CURATED
from quayflow.sinks import point_store
from quayflow.sinks.files import write_lines, write_points

BASE = {
    "ingest_date": date(2026, 1, 1),
    "ingest_ts": datetime(2026, 1, 1, 10),
    "kafka_topic": "t",
    "kafka_partition": 0,
    "kafka_offset": 7,
    "kafka_timestamp": datetime(2026, 1, 1, 9, 0, 0, 500),
    "event_version": 1,
    "line_ref": 'q"\\',
    "expected_departure_time": datetime(2026, 1, 1, 12, 0, 0, 1),
    "vehicle_at_stop": True,
    "roi_label": "RER A",
    "short_name": "A,=",
    "transport_mode": "",
    "destination_name": "Marne\nla Vallée",
}
NAMES = [column.split()[0] for column in CURATED.split(", ")]


def curated(spark, *changes):
    rows = [tuple({**BASE, **change}.get(name) for name in NAMES) for change in changes or ({},)]
    return spark.createDataFrame(rows, CURATED)


def test_tags_and_fields_partition_the_columns(spark):
    points = to_points(curated(spark), "m")
    assert points.columns == ["measurement", "tags", "fields", "time_ns"]
    assert points.schema["tags"].dataType.names == TAG_COLUMNS
    fields = points.schema["fields"].dataType.names
    assert len(fields) == 18
    assert set(fields) == set(NAMES) - set(TAG_COLUMNS) - set(TIME_COLUMNS) | {INSERTED_AT_FIELD}


def test_field_types(spark):
    point = to_points(curated(spark), "m").collect()[0]
    fields = point.fields
    assert fields.vehicle_at_stop is True
    assert (fields.kafka_offset, fields.event_version) == (7, 1)
    assert fields.ingest_date == "2026-01-01"
    assert fields.kafka_timestamp == str(BASE["kafka_timestamp"])
    assert fields.departure_status is None
    assert datetime.fromisoformat(fields[INSERTED_AT_FIELD])
    assert point.tags.stop_point_name is None


def test_inserted_at_is_one_value(spark):
    rows = curated(spark, *[{"kafka_offset": i} for i in range(50)])
    points = to_points(rows.repartition(8), "m")
    assert points.select(f"fields.{INSERTED_AT_FIELD}").distinct().count() == 1


def test_time_priority(spark):
    moments = {name: datetime(2026, 1, 1, hour) for hour, name in enumerate(TIME_COLUMNS, 1)}
    steps = []
    for index in range(len(TIME_COLUMNS)):
        steps.append({**dict.fromkeys(TIME_COLUMNS[:index]), **dict(list(moments.items())[index:])})
    df = curated(spark, *steps, dict.fromkeys(TIME_COLUMNS))
    rows = df.select(F.hour(point_time(df)), point_time(df).alias("t")).collect()
    assert [row[0] for row in rows[:-1]] == [1, 2, 3, 4]
    assert abs((rows[-1].t - datetime.now()).total_seconds()) < 3600 * 24
    only = df.select("ingest_ts")
    assert [r[0] for r in only.select(F.hour(point_time(only))).collect()][:4] == [4, 4, 4, 4]


def test_line_protocol_text(spark):
    points = to_points(curated(spark), "my m")
    points = points.withColumn(
        "fields",
        F.struct(
            F.col("fields.line_ref").alias("line ref"),
            F.col("fields.kafka_offset").alias("offset"),
            F.col("fields.vehicle_at_stop").alias("at"),
            F.col("fields.departure_status").alias("status"),
            F.lit(float("nan")).alias("nan"),
            F.lit(1.5).alias("ratio"),
        ),
    )
    micros = 1767268800000001
    assert line_protocol(points).collect()[0].line == (
        r"my\ m,destination_name=Marne\nla\ Vallée,roi_label=RER\ A,short_name=A\,\= "
        r'at=true,line\ ref="q\"\\",offset=7i,ratio=1.5 ' + f"{micros * 1000}"
    )


def test_points_without_fields_have_no_line(spark):
    points = to_points(curated(spark), "m").withColumn(
        "fields", F.struct(F.lit(None).cast("string").alias("a"), F.lit(float("inf")).alias("b"))
    )
    assert line_protocol(points).count() == 0


def test_kpi_ready_and_counts(spark):
    df = curated(spark, {}, {"expected_departure_time": None})
    assert row_count(kpi_ready(df)).collect() == [(1,)]


@pytest.mark.parametrize("text", [False, True])
def test_export_to_files(spark, tmp_path, text):
    layer, out = str(tmp_path / "curated"), str(tmp_path / "points")
    far = {"expected_departure_time": datetime(9999, 12, 31)}
    none = {"expected_departure_time": None}
    curated(spark, {}, none, {"kafka_offset": 8}, far).write.parquet(layer)

    def write(points):
        write_lines(line_protocol(points), out) if text else write_points(points, out)

    assert export_points(spark, layer, "m", write) == (2, 1)
    assert (spark.read.text(out) if text else spark.read.parquet(out)).count() == 2


def test_lines_are_stored_compressed_and_read_alike(spark, tmp_path):
    texts = [f'passages,roi_label=L\\ {n} status="é \\"{n}\\"",offset={n}i 170406720{n:04d}000000' for n in range(4000)]
    lines = spark.createDataFrame([(t,) for t in texts], "line string").coalesce(1)
    sizes = {}
    for codec in ("gzip", "none"):
        out = tmp_path / codec
        write_lines(lines, str(out)) if codec == "gzip" else write_lines(lines, str(out), codec=codec)
        assert sorted(row.value for row in spark.read.text(str(out)).collect()) == sorted(texts)
        sizes[codec] = sum(f.stat().st_size for f in out.glob("part-*"))
    assert sizes["none"] == sum(len(t.encode()) + 1 for t in texts)
    assert sizes["gzip"] < sizes["none"] / 4


def test_times_beyond_nanoseconds_have_no_point(spark):
    far = [datetime(9999, 12, 31), datetime(1600, 1, 1), datetime(2262, 1, 1)]
    df = curated(spark, *[{"expected_departure_time": time} for time in far])
    points = to_points(df, "m")
    assert [row.time_ns is None for row in points.collect()] == [True, True, False]
    assert line_protocol(points).count() == 1


def test_one_line_and_one_separator_whatever_the_text(spark):
    df = curated(spark, {"roi_label": "Stop\\", "line_ref": "two\nlines", "short_name": "a\rb"})
    (row,) = line_protocol(to_points(df, "m,n o")).collect()
    assert "\n" not in row.line and "\r" not in row.line
    assert row.line.startswith("m\\,n\\ o,")
    assert "roi_label=Stop\\ ,short_name=a\\rb " in row.line
    assert 'line_ref="two\\nlines"' in row.line


def test_busy_store_is_asked_again(monkeypatch):
    waits, answers = [], [429, 503, None, 400]

    def opener(request, timeout):
        code = answers.pop(0)
        if code:
            raise point_store.urllib.error.HTTPError(request.full_url, code, "", {}, None)
        return Answer()

    monkeypatch.setattr(point_store.urllib.request, "urlopen", opener)
    monkeypatch.setattr(point_store.time, "sleep", waits.append)
    writer = point_store._LineWriter({"url": "http://store", "org": "o", "bucket": "b", "token": "t"})
    writer._post(["x"])
    assert waits == [1, 2] and answers == [400]
    with pytest.raises(point_store.urllib.error.HTTPError):
        writer._post(["x"])
    assert len(waits) == 2


def test_token_is_required(spark):
    with pytest.raises(ValueError, match="token"):
        point_store.post_lines(spark.range(0), url="u", org="o", bucket="b", token="")


class Answer:
    def __enter__(self):
        return self

    def __exit__(self, *args):
        return False


def test_writer_posts_blocks_and_skips_empty_tasks(monkeypatch):
    sent = []

    def urlopen(request, timeout):
        sent.append(request)
        return Answer()

    monkeypatch.setattr(point_store.urllib.request, "urlopen", urlopen)
    options = {"url": "http://store/", "org": "o", "bucket": "b c", "token": "secret"}
    options["block_lines"] = "2"
    writer = point_store.LineProtocolHttp(options).writer(None, False)
    batch = pa.RecordBatch.from_pydict({"line": ["a", "é", "c"]})
    assert writer.write(iter([batch])).lines == 3
    assert [request.data for request in sent] == ["a\né".encode(), b"c"]
    assert sent[0].full_url == "http://store/api/v2/write?org=o&bucket=b+c&precision=ns"
    assert sent[0].get_header("Authorization") == "Token secret"
    assert writer.write(iter([])).lines == 0
    assert len(sent) == 2


def test_failed_post_fails_the_write(spark):
    """The store's address does not exist, so the write must raise and not lose points."""
    lines = spark.createDataFrame([("m a=1i 1",)], "line string")
    with pytest.raises(Exception):
        point_store.post_lines(lines, url="unknown://store", org="o", bucket="b", token="t")


def test_empty_frame_makes_no_call(spark):
    lines = spark.createDataFrame([], "line string")
    point_store.post_lines(lines, url="unknown://store", org="o", bucket="b", token="t")
