"""Curated rows to time-series points and to line protocol text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayflow.functions.times import epoch_nanos, utc_text

# Tag columns, and time columns by falling priority.
TAG_COLUMNS = [
    "roi_label",
    "short_name",
    "transport_mode",
    "stop_point_name",
    "destination_name",
]
TIME_COLUMNS = [
    "expected_departure_time",
    "recorded_at_time",
    "producer_ts",
    "ingest_ts",
]
# Fixed value: name of the field that holds the conversion time.
INSERTED_AT_FIELD = "influx_inserted_at"


def kpi_ready(curated: DataFrame) -> DataFrame:
    """Rows with an expected departure time."""
    return curated.where(F.col("expected_departure_time").isNotNull())


def point_time(df: DataFrame, time_columns: Sequence[str] = TIME_COLUMNS) -> Column:
    """First non-NULL of the time columns present, else the current time."""
    present = [F.col(name) for name in time_columns if name in df.columns]
    return F.coalesce(*present, F.current_timestamp())


def _field(column: T.StructField) -> Column:
    """Booleans and numbers keep their type, timestamps become UTC text, the rest text."""
    value = F.col(column.name)
    kept = (
        T.BooleanType,
        T.ByteType,
        T.ShortType,
        T.IntegerType,
        T.LongType,
        T.FloatType,
        T.DoubleType,
    )
    if isinstance(column.dataType, kept):
        return value
    if isinstance(column.dataType, T.TimestampType):
        return utc_text(value).alias(column.name)
    return value.cast("string").alias(column.name)


def to_points(
    df: DataFrame,
    measurement: str,
    tag_columns: Sequence[str] = TAG_COLUMNS,
    time_columns: Sequence[str] = TIME_COLUMNS,
) -> DataFrame:
    """Points as ``measurement, tags, fields, time_ns``.

    Tags and fields are structs with one typed column each, where NULL means that
    the point does not have it. Columns that are neither tag nor time are fields.
    ``time_ns`` is NULL where the time is beyond what nanoseconds reach.
    """
    tags = [F.col(name).cast("string").alias(name) for name in tag_columns if name in df.columns]
    fields = [
        _field(column)
        for column in df.schema.fields
        if column.name not in tag_columns and column.name not in time_columns
    ]
    inserted_at = utc_text(F.current_timestamp(), "T").alias(INSERTED_AT_FIELD)
    return df.select(
        F.lit(measurement).alias("measurement"),
        F.struct(*tags).alias("tags"),
        F.struct(*fields, inserted_at).alias("fields"),
        epoch_nanos(point_time(df, time_columns)).alias("time_ns"),
    )


def _escape_key(text: str) -> str:
    return text.replace(",", r"\,").replace("=", r"\=").replace(" ", r"\ ")


def _escaped(value: Column, replacements: Sequence[tuple[str, str]]) -> Column:
    """Plain replacements: most texts have none of the characters, and need no regex for it."""
    for char, text in replacements:
        value = F.replace(value, F.lit(char), F.lit(text))
    return value


# Line protocol's escapes in measurement names, tag values and text fields.
_MEASUREMENT_ESCAPES = [(",", r"\,"), (" ", r"\ "), ("\n", r"\n"), ("\r", r"\r")]
_TAG_ESCAPES = [
    (",", r"\,"),
    ("=", r"\="),
    (" ", r"\ "),
    ("\n", r"\n"),
    ("\t", r"\t"),
    ("\r", r"\r"),
]
# A text field's line breaks become the two characters, as one point is one line.
_TEXT_ESCAPES = [("\\", r"\\"), ('"', r"\""), ("\n", r"\n"), ("\r", r"\r")]


def measurement_text(value: Column) -> Column:
    """Escaped measurement name."""
    return _escaped(value, _MEASUREMENT_ESCAPES)


def tag_text(value: Column) -> Column:
    """Escaped tag value; NULL for the empty string, which cannot be a tag value.

    A backslash at the end would escape the separator after it. Line protocol has no
    escape for it, so it is made an escaped blank.
    """
    text = _escaped(F.nullif(value, F.lit("")), _TAG_ESCAPES)
    return F.when(text.endswith("\\"), F.concat(text, F.lit(" "))).otherwise(text)


def _field_text(value: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, T.BooleanType):
        return value.cast("string")
    if isinstance(data_type, T.FractionalType):
        return value.cast("string")
    if isinstance(data_type, T.IntegralType):
        return F.concat(value.cast("string"), F.lit("i"))
    return F.concat(F.lit('"'), _escaped(value, _TEXT_ESCAPES), F.lit('"'))


def _writable(column: T.StructField) -> Column:
    """The field's value; NULL for NaN and infinities, which line protocol cannot hold."""
    value = F.col("fields")[column.name]
    if not isinstance(column.dataType, (T.FloatType, T.DoubleType)):
        return value
    return F.when(~F.isnan(value) & (F.abs(value) != F.lit(float("inf"))), value)


def line_protocol(points: DataFrame) -> DataFrame:
    """One ``line`` of line protocol text for each point that has a field and a time."""
    schema = points.schema
    head = [measurement_text(F.col("measurement"))]
    for name in sorted(schema["tags"].dataType.names):
        tag = tag_text(F.col("tags")[name])
        head.append(F.concat(F.lit(f"{_escape_key(name)}="), tag))
    body = []
    columns = sorted(schema["fields"].dataType.fields, key=lambda field: field.name)
    for column in columns:
        text = _field_text(_writable(column), column.dataType)
        body.append(F.concat(F.lit(f"{_escape_key(column.name)}="), text))
    line = F.concat_ws(
        " ", F.concat_ws(",", *head), F.concat_ws(",", *body), F.col("time_ns").cast("string")
    )
    has_field = F.coalesce(*[_writable(column).cast("string") for column in columns])
    writable = has_field.isNotNull() & F.col("time_ns").isNotNull()
    return points.where(writable).select(line.alias("line"))
