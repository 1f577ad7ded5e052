"""Lines as they were at the time of a visit: an as-of join by bins of time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayflow.schemas import LINE_COLUMNS

BIN_DAYS = 30
LONG_HISTORY = 64  # rows of one line that each of its visits is compared with, without bins
REPEATS = 4
_MICROS = 86_400_000_000


def _bin(time: Column, days: int) -> Column:
    return F.floor(F.unix_micros(time) / F.lit(days * _MICROS))


def with_validity(changes: DataFrame, key: str = "siri_line_ref") -> DataFrame:
    """Add ``valid_to`` to rows with ``valid_from``: the next row's start, NULL for the last.

    Of rows with equal key and start one is kept, the largest by its columns.
    """
    order = F.struct(*[c for c in changes.columns if c not in (key, "valid_from")])
    once = changes.groupBy(key, "valid_from").agg(F.max(order).alias("row"))
    history = once.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("valid_from", "row"))).alias("h"))
    numbered = history.select(key, "h", F.posexplode("h").alias("n", "v"))
    return numbered.select(
        key, "v.valid_from", "v.row.*", F.get("h", F.col("n") + 1)["valid_from"].alias("valid_to")
    )


def join_lines_as_of(
    visits: DataFrame, lines: DataFrame, time: str = "recorded_at_time", bin_days: int = BIN_DAYS
) -> DataFrame:
    """Left join on the line reference and the row of ``lines`` that was valid at ``time``.

    ``lines`` has ``siri_line_ref, valid_from, valid_to`` and the line columns; validity
    includes its start and not its end, NULL stands for always before or after. The join is on
    the reference. Where a line has over ``LONG_HISTORY`` rows it is on reference and bin of
    time as well: a reference row is repeated for each bin it is valid in, and a line's visits
    spread over its bins and meet only rows of theirs. Bins are ``bin_days`` wide, or wider, so
    that rows are not repeated more than ``REPEATS`` times on average, however long they are
    valid; they are those of the visits' own times only.
    Overlapping validities multiply rows; visits without a time or a valid line have NULLs.
    """
    at = F.col(time)
    known = lines.where(F.col("siri_line_ref").isNotNull())
    n_rows, n_lines, longest = (
        known.groupBy("siri_line_ref")
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1)), F.coalesce(F.max("n"), F.lit(0)))
        .first()
    )
    refs = known.select(
        F.col("siri_line_ref").alias("join_line_ref"),
        F.col("valid_from").alias("join_from"),
        F.col("valid_to").alias("join_to"),
        *LINE_COLUMNS,
    )
    valid = (F.col("join_from").isNull() | (F.col("join_from") <= at)) & (
        F.col("join_to").isNull() | (at < F.col("join_to"))
    )
    if longest <= LONG_HISTORY:
        on = (visits["line_ref"] == refs["join_line_ref"]) & at.isNotNull() & valid
        return visits.join(refs, on, "left").drop("join_line_ref", "join_from", "join_to")
    lowest, highest = F.min(_bin(at, bin_days)), F.max(_bin(at, bin_days))
    bounds = visits.agg(lowest.alias("lowest"), highest.alias("highest")).first()
    # without any time there is no bin
    n_bins = 0 if bounds.lowest is None else bounds.highest - bounds.lowest + 1
    most = max(1, REPEATS * n_rows // n_lines)
    days = bin_days * max(1, -(-n_bins // most))
    low = F.lit(0 if bounds.lowest is None else bounds.lowest * bin_days // days).cast("bigint")
    high = F.lit(-1 if bounds.highest is None else bounds.highest * bin_days // days + 1).cast("bigint")
    start = F.greatest(F.coalesce(_bin(F.col("join_from"), days), low), low)
    end = F.least(F.coalesce(_bin(F.col("join_to"), days), high), high)
    bins = F.explode(F.sequence(start, end)).alias("join_bin")
    # Catalyst does not see the repeats, and would send them to the driver
    binned = refs.where(start <= end).select("*", bins).hint("merge")
    placed = visits.withColumn("visit_bin", _bin(at, days))
    on = (
        (placed["line_ref"] == binned["join_line_ref"])
        & (placed["visit_bin"] == binned["join_bin"])
        & valid
    )
    joined = placed.join(binned, on, "left")
    return joined.drop("visit_bin", "join_line_ref", "join_from", "join_to", "join_bin")
