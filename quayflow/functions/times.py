"""Timestamps: tolerant reading, zone-free rendering, epoch nanoseconds."""

from __future__ import annotations

from typing import Literal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the one timestamp shape the strict mode reads.
STRICT_TIME_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"

TimeMode = Literal["tolerant", "strict"]


def parse_event_time(text: Column, mode: TimeMode = "tolerant") -> Column:
    """ISO date-time text to timestamp, NULL where it cannot be read.

    ``tolerant`` takes any fraction length and any offset and honours it.
    ``strict`` takes milliseconds followed by a literal ``Z`` only and reads them
    in the session zone, which is right while the session is in UTC.
    """
    if mode == "strict":
        # Other texts cannot fit the pattern, and to fail on one costs more than to read it.
        may_fit = text.rlike(r"\..*[Zz]\z")
        return F.when(may_fit, F.try_to_timestamp(text, F.lit(STRICT_TIME_PATTERN)))
    if mode != "tolerant":
        raise ValueError(f"unknown time mode: {mode!r}")
    # Without the "T" test Spark would also read a bare time as a time of today.
    return F.when(F.substring(text, 11, 1) == "T", F.try_to_timestamp(text))


def utc_text(ts: Column, separator: str = " ") -> Column:
    """Timestamp as UTC text with six fraction digits, or none when they are zero.

    Goes through the epoch and a zone-free timestamp, so the session zone and
    its daylight-saving gaps do not matter.
    """
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    text = F.timestamp_add("MICROSECOND", F.unix_micros(ts), epoch).cast("string")
    text = F.when(F.length(text) > 19, F.rpad(text, 26, "0")).otherwise(text)
    return text if separator == " " else F.replace(text, F.lit(" "), F.lit(separator))


def iso_utc(ts: Column) -> Column:
    """ISO-8601 UTC text with an explicit ``+00:00`` offset."""
    return F.concat(utc_text(ts, "T"), F.lit("+00:00"))


def epoch_nanos(ts: Column) -> Column:
    """Nanoseconds since the epoch, NULL outside the years 1677 to 2262 that they reach.

    Spark's clock resolution is one microsecond.
    """
    return F.try_multiply(F.unix_micros(ts), F.lit(1000))
