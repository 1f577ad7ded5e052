from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from quayflow.functions.times import epoch_nanos, iso_utc, parse_event_time, utc_text

SHAPES = {
    "2026-01-02T03:04:05.123Z": 123000,
    "2026-01-02T03:04:05Z": 0,
    "2026-01-02T03:04:05.123456Z": 123456,
    "2026-01-02T03:04:05.123456+00:00": 123456,
}
UNREADABLE = ["", "soon", "12:30:00", "2026-01-02", "2026-13-02T03:04:05Z", None]
SECOND = int(datetime(2026, 1, 2, 3, 4, 5, tzinfo=timezone.utc).timestamp()) * 1_000_000


@pytest.fixture(params=["UTC", "Europe/Paris"])
def zone(spark, request):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", before)


def parsed(spark, texts, mode):
    df = spark.createDataFrame([(text,) for text in texts], "t string")
    rows = df.select("t", F.unix_micros(parse_event_time(F.col("t"), mode)).alias("u")).collect()
    return {row.t: row.u for row in rows}


def test_tolerant_reads_all_shapes_in_any_zone(spark, zone):
    expected = {text: SECOND + micros for text, micros in SHAPES.items()}
    assert parsed(spark, SHAPES, "tolerant") == expected


def test_tolerant_honours_offset(spark):
    assert parsed(spark, ["2026-01-02T05:04:05+02:00"], "tolerant").popitem()[1] == SECOND


@pytest.mark.parametrize("mode", ["tolerant", "strict"])
def test_unreadable_is_null(spark, mode):
    assert set(parsed(spark, UNREADABLE, mode).values()) == {None}


def test_strict_reads_milliseconds_and_z_only(spark):
    result = parsed(spark, SHAPES, "strict")
    assert [text for text, value in result.items() if value is not None] == [next(iter(SHAPES))]


def test_unknown_mode():
    with pytest.raises(ValueError):
        parse_event_time(None, "loose")


MOMENTS = [
    datetime(2026, 1, 2, 3, 4, 5, 120000, timezone.utc),
    datetime(2026, 1, 2, 3, 4, 5, 0, timezone.utc),
    # both sides of the hour that Paris repeats, and the hour it skips
    datetime(2025, 10, 26, 0, 30, 0, 1, timezone.utc),
    datetime(2025, 10, 26, 1, 30, 0, 1, timezone.utc),
    datetime(2026, 3, 29, 2, 30, 0, 0, timezone.utc),
    datetime(1969, 12, 31, 23, 59, 59, 999999, timezone.utc),
]


def test_rendering_equals_python(spark, zone):
    start = datetime(1970, 1, 1, tzinfo=timezone.utc)
    micros = [(moment - start) // timedelta(microseconds=1) for moment in MOMENTS]
    df = spark.createDataFrame([(m,) for m in micros], "m bigint").withColumn(
        "ts", F.timestamp_micros("m")
    )
    rows = df.select(
        iso_utc(F.col("ts")), utc_text(F.col("ts")), epoch_nanos(F.col("ts"))
    ).collect()
    naive = [moment.replace(tzinfo=None) for moment in MOMENTS]
    assert [row[0] for row in rows] == [moment.isoformat() for moment in MOMENTS]
    assert [row[1] for row in rows] == [str(moment) for moment in naive]
    assert [row[2] for row in rows] == [m * 1000 for m in micros]
