"""Enrichment of visits with the line reference table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayflow.schemas import LINE_COLUMNS

# Bits and words of the marks: a fixed size, 524,288 rows at most, however many lines there are.
MARK_BITS = 1 << 25
WORD_BITS = 64
# Lines, by their size in files, that a task holds in a hash map: some 20 times this in memory.
HASH_BYTES = 16 << 20


def _conf_and_size(lines: DataFrame):
    conf = lines.sparkSession._jsparkSession.sessionState().conf()
    size = lines._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return conf, int(str(size))


def is_broadcast(lines: DataFrame) -> bool:
    """Whether Catalyst takes the table for small enough to broadcast."""
    conf, size = _conf_and_size(lines)
    return size <= conf.autoBroadcastJoinThreshold()


def is_hashed(lines: DataFrame, times: int = 1) -> bool:
    """Whether a shuffled part of the table, each line ``times`` repeated, fits a hash map of
    ``HASH_BYTES`` or what may be broadcast. A join then sorts and spills no visits. Never
    where broadcasts are switched off."""
    conf, size = _conf_and_size(lines)
    threshold = conf.autoBroadcastJoinThreshold()
    most = max(threshold, HASH_BYTES) * conf.numShufflePartitions()
    return threshold >= 0 and size * times <= most


def line_marks(lines: DataFrame) -> DataFrame:
    """Each line as one bit of a table of fixed size, however many lines there are."""
    bit = F.pmod(F.xxhash64("siri_line_ref"), F.lit(MARK_BITS))
    marked = lines.select(bit.alias("bit"))
    word = F.expr(f"bit DIV {WORD_BITS}").alias("mark_word")
    return marked.groupBy(word).agg(
        F.expr(f"bit_or(shiftleft(1L, CAST(bit % {WORD_BITS} AS INT)))").alias("mark_bits")
    )


def on_marked_lines(
    visits: DataFrame, lines: DataFrame, marks: DataFrame | None = None
) -> DataFrame:
    """Leave out visits that are on none of ``lines``, so that a join does not move them.

    The lines' marks, or ``marks`` made of them before, are broadcast. No visit on one of
    the lines is lost; some on others stay, with lines by the million some 10 %.
    """
    marks = line_marks(lines) if marks is None else marks
    own = f"pmod(xxhash64(line_ref), {MARK_BITS}L)"
    seen = visits.join(F.broadcast(marks), F.expr(f"{own} DIV {WORD_BITS} = mark_word"))
    return seen.where(f"getbit(mark_bits, CAST({own} % {WORD_BITS} AS INT)) = 1").drop(
        "mark_word", "mark_bits"
    )


def join_lines(visits: DataFrame, lines: DataFrame, salt: int | None = None) -> DataFrame:
    """Left join on the exact line reference; duplicate references multiply rows.

    No broadcast is forced. Catalyst broadcasts ``lines`` when its size is below
    ``spark.sql.autoBroadcastJoinThreshold``. Beyond it both sides are shuffled, and
    the visits probe a hash map of a part's lines where those are few enough
    (:func:`is_hashed`), else both are sorted and merged; adaptive execution splits
    hot partitions of either join. Adaptive splitting is not applied to streams, so a
    stream with a reference table beyond the threshold can pass ``salt``: rows of one
    line then spread over that many tasks and each reference row is repeated as often.
    """
    dimension = lines.select(F.col("siri_line_ref").alias("join_line_ref"), *LINE_COLUMNS)
    if salt is not None and salt < 1:
        raise ValueError(f"salt must be 1 or more, not {salt}")
    hashed = not is_broadcast(lines) and is_hashed(lines, salt or 1)
    if salt is None:
        dimension = dimension.hint("shuffle_hash") if hashed else dimension
        on = visits["line_ref"] == dimension["join_line_ref"]
        return visits.join(dimension, on, "left").drop("join_line_ref")
    # A hash of the record, not a random number: a retried task salts alike.
    record = F.xxhash64("kafka_topic", "kafka_partition", "kafka_offset")
    salted = visits.withColumn("fact_salt", F.pmod(record, F.lit(salt)))
    repeated = dimension.withColumn(
        "line_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salt - 1).cast("bigint")))
    )
    repeated = repeated.hint("shuffle_hash") if hashed else repeated
    on = (salted["line_ref"] == repeated["join_line_ref"]) & (
        salted["fact_salt"] == repeated["line_salt"]
    )
    return salted.join(repeated, on, "left").drop("join_line_ref", "fact_salt", "line_salt")


def roi_only(enriched: DataFrame) -> DataFrame:
    """Rows on a line of interest; after ``join_lines`` Catalyst makes the join inner."""
    return enriched.where(F.col("roi_label").isNotNull())
