"""Cluster-metrics messages to points in long form, bad messages to quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayflow.functions.documents import LARGE_BYTES, parse_json
from quayflow.operators.points import measurement_text, tag_text

# The metric fields by conversion rule, and the constant tags.
INTEGER_FIELDS = [
    "totalMB",
    "availableMB",
    "allocatedMB",
    "reservedMB",
    "pendingMB",
    "totalVirtualCores",
    "availableVirtualCores",
    "allocatedVirtualCores",
]
DOUBLE_FIELDS = [
    "utilizedMBPercent",
    "utilizedVirtualCoresPercent",
]
BY_TYPE_FIELDS = [
    "appsSubmitted",
    "appsCompleted",
    "appsPending",
    "appsRunning",
    "appsFailed",
    "appsKilled",
    "totalNodes",
    "activeNodes",
    "lostNodes",
    "unhealthyNodes",
    "containersAllocated",
    "containersReserved",
    "containersPending",
    "rmSchedulerBusyPercent",
]
TIME_REASON = "time beyond nanoseconds"
SOURCE_TAG = "yarn_rm"
HOST_TAG = "master"


_BY_TYPE_DOUBLE = [name for name in BY_TYPE_FIELDS if "Percent" in name]
_BY_TYPE_INTEGER = [name for name in BY_TYPE_FIELDS if "Percent" not in name]

# Every field as VARIANT, which keeps the JSON type of a value, and a JSON null
# apart from a missing field.
_FIELDS_TYPE = ", ".join(
    f"{name}: variant" for name in [*INTEGER_FIELDS, *DOUBLE_FIELDS, *BY_TYPE_FIELDS]
)


# Text the JVM reads as a number and no other reader does: 0x1p3, 1.5d, 2f.
_JAVA_NUMBER = r"(?i)0x|[0-9.][df]\s*\z"


def _present(names: list[str]) -> Column:
    """The fields the message has, as ``name, value`` pairs."""
    pairs = ", ".join(f"struct('{name}' AS name, metrics.{name} AS value)" for name in names)
    return F.expr(f"filter(array({pairs}), pair -> pair.value IS NOT NULL)")


def _entry(
    name: Column,
    bad: Column,
    long_value: Column | None = None,
    double_value: Column | None = None,
    bool_value: Column | None = None,
) -> Column:
    nothing = F.lit(None)
    return F.struct(
        name.alias("field"),
        (nothing if long_value is None else long_value).cast("bigint").alias("long_value"),
        (nothing if double_value is None else double_value).cast("double").alias("double_value"),
        (nothing if bool_value is None else bool_value).cast("boolean").alias("bool_value"),
        bad.alias("bad"),
    )


def _number(pair: Column, target: str) -> Column:
    """Entry of a value that must convert; numeric text and booleans do."""
    number = F.try_variant_get(pair["value"], "$", target)
    if target == "double":
        text = F.try_variant_get(pair["value"], "$", "string")
        number = F.when(~text.rlike(_JAVA_NUMBER), number)
    slot = {"bigint": "long_value", "double": "double_value"}[target]
    return _entry(pair["name"], number.isNull(), **{slot: number})


def _by_type(pair: Column, target: str) -> Column:
    """Entry of a boolean or a number, NULL for any other value.

    The JSON type decides: text such as "12" would convert to a number too.
    """
    kind = F.schema_of_variant(pair["value"])
    is_number = kind.isin("BIGINT", "DOUBLE") | kind.startswith("DECIMAL")
    flag = F.try_variant_get(pair["value"], "$", "boolean")
    return F.when(
        kind == "BOOLEAN", _entry(pair["name"], F.lit(False), bool_value=flag)
    ).when(is_number, _number(pair, target))


def read_metrics(messages: DataFrame, value: str = "value") -> DataFrame:
    """Add ``metric_fields``, with NULL for an ignored value, and ``reject_reason``.

    A message is rejected as a whole, and has NULL for its fields, when its text is
    not one JSON object or when a number in it cannot be read by the rule of its
    field.

    The rules are array functions over the fields present, not one expression for
    each of the fields: that many expressions make methods too long for the JVM to
    compile.
    """
    kept = messages.columns
    text = F.col(value).cast("string")
    documents = messages.select(*kept, parse_json(text).alias("document"))
    documents = documents.select(
        "*", F.variant_get("document", "$.clusterMetrics", "variant").alias("given")
    )
    documents = documents.select(
        "*", F.try_variant_get("given", "$", f"struct<{_FIELDS_TYPE}>").alias("metrics")
    )
    document_reason = (
        F.when(
            F.col("document").isNull() & (F.octet_length(text) >= LARGE_BYTES),
            F.lit("too large or not valid JSON"),
        )
        .when(F.col("document").isNull(), F.lit("not valid JSON"))
        .when(~F.ltrim(text).startswith("{"), F.lit("not a JSON object"))
        .when(
            F.col("given").isNotNull() & F.col("metrics").isNull(),
            F.lit("clusterMetrics is not an object"),
        )
    )
    entries = F.concat(
        F.transform(_present(INTEGER_FIELDS), lambda pair: _number(pair, "bigint")),
        F.transform(_present(DOUBLE_FIELDS), lambda pair: _number(pair, "double")),
        F.transform(_present(_BY_TYPE_INTEGER), lambda pair: _by_type(pair, "bigint")),
        F.transform(_present(_BY_TYPE_DOUBLE), lambda pair: _by_type(pair, "double")),
    )
    checked = documents.select(
        *kept, document_reason.alias("document_reason"), entries.alias("entries")
    )
    bad_names = F.array_join(
        F.transform("entries", lambda entry: F.when(entry["bad"], entry["field"])), ","
    )
    checked = checked.select(
        *kept,
        "entries",
        F.coalesce(
            F.col("document_reason"),
            F.when(bad_names != "", F.concat(F.lit("unreadable number: "), bad_names)),
        ).alias("reason"),
    )
    # The generator keeps filters on its columns above the parse. A filter on a
    # projection would move below it and parse every message again.
    return checked.select(
        *kept,
        F.inline_outer(
            F.array(
                F.struct(
                    F.col("reason").alias("reject_reason"),
                    F.when(F.col("reason").isNull(), F.col("entries")).alias("metric_fields"),
                )
            )
        ),
    )


def metric_time(offset: str, at: Column) -> Column:
    """Time of a record's point in nanoseconds, distinct within its topic partition.

    Points of equal time and tags replace each other in a time-series store. The time
    is ``at``, for a Kafka record its own timestamp, to the millisecond, and the six
    digits below hold the end of ``offset``; the partition is a tag. Two records share
    both only if a partition gets a million records with one millisecond. NULL outside the
    years 1677 to 2262, which nanoseconds reach.
    """
    millions = F.try_multiply(F.unix_millis(at), F.lit(1_000_000))
    return F.try_add(millions, F.pmod(F.col(offset), F.lit(1_000_000)))


def placed(read: DataFrame, time_ns: Column) -> DataFrame:
    """Add ``time_ns``; a message without one, or with a time beyond its range, is rejected.

    A producer sets its record's time, so one that no point can have must not stop a stream.
    """
    others = [n for n in read.columns if n not in ("time_ns", "reject_reason", "metric_fields")]
    timed = read.select(*others, "reject_reason", "metric_fields", time_ns.alias("time_ns"))
    reason = F.coalesce("reject_reason", F.when(F.col("time_ns").isNull(), F.lit(TIME_REASON)))
    fields = F.when(F.col("time_ns").isNotNull(), F.col("metric_fields"))
    return timed.select(
        *others, "time_ns", reason.alias("reject_reason"), fields.alias("metric_fields")
    )


def _tagged(
    topic: str, measurement: str, time_ns: Column, partition: str, host: str
) -> list[Column]:
    return [
        F.lit(measurement).alias("measurement"),
        F.lit(SOURCE_TAG).alias("source"),
        F.lit(host).alias("rm_host"),
        F.lit(topic).alias("topic"),
        F.col(partition).cast("string").alias("partition"),
        time_ns.alias("time_ns"),
    ]


def metric_points(
    read: DataFrame,
    topic: str,
    measurement: str,
    time_ns: Column,
    keep: tuple[str, ...] = (),
    partition: str = "kafka_partition",
    host: str = HOST_TAG,
) -> DataFrame:
    """Long form: one row for each field of each accepted message."""
    return (
        read.select(
            *_tagged(topic, measurement, time_ns, partition, host),
            *keep,
            F.explode_outer("metric_fields").alias("m"),
        )
        .where(F.col("m").isNotNull())
        .select("*", "m.field", "m.long_value", "m.double_value", "m.bool_value")
        .drop("m")
    )


def metric_lines(
    read: DataFrame,
    topic: str,
    measurement: str,
    time_ns: Column,
    partition: str = "kafka_partition",
    host: str = HOST_TAG,
) -> DataFrame:
    """One line of line protocol text for each accepted message with at least one field."""

    def pair(m: Column) -> Column:
        finite = ~F.isnan(m["double_value"]) & (F.abs(m["double_value"]) != F.lit(float("inf")))
        text = F.coalesce(
            F.concat(m["long_value"].cast("string"), F.lit("i")),
            F.when(finite, m["double_value"].cast("string")),
            m["bool_value"].cast("string"),
        )
        return F.concat(m["field"], F.lit("="), text)

    pairs = F.array_join(F.transform("metric_fields", pair), ",")
    tags = F.concat_ws(
        ",",
        measurement_text(F.lit(measurement)),
        F.concat(F.lit("partition="), F.col(partition).cast("string")),
        F.concat(F.lit("rm_host="), tag_text(F.lit(host))),
        F.lit(f"source={SOURCE_TAG}"),
        F.concat(F.lit("topic="), tag_text(F.lit(topic))),
    )
    line = F.when(pairs != "", F.concat_ws(" ", tags, pairs, time_ns.cast("string")))
    return read.select(line.alias("line")).where(F.col("line").isNotNull())


def rejected_messages(read: DataFrame) -> DataFrame:
    """The messages without a point, with the reason."""
    return read.where(F.col("reject_reason").isNotNull()).drop("metric_fields", "time_ns")
