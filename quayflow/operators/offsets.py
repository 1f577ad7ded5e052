"""Lost and repeated offsets of topic partitions.

A source that goes on past lost offsets says nothing of them; the records that arrived do.
Offsets are counted in cells of as many as a bitmap of Spark's has bits, so a task sends one
bitmap for each cell it has records of, and the records of a long topic partition are dealt
by cell. Only cells that have holes or repeats are looked at record by record. What lies
between cells follows from their first and last offsets, first within groups of cells and
then between the groups, so no window holds more rows than a cell has offsets, a group
cells, or a topic partition groups.

Brokers may leave offsets out by design (transaction markers, compacted topics); those are
reported as missing too. Records without topic, partition or offset are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quayflow.session import stored

PARTITION = ["kafka_topic", "kafka_partition"]
CELL = 32_768  # fixed by the bitmap functions
GROUP = 4_096


def _celled(records: DataFrame) -> DataFrame:
    known = records.select(*PARTITION, "kafka_offset").dropna()
    return known.withColumn("cell", F.expr(f"kafka_offset DIV {CELL}"))


def offset_cells(records: DataFrame) -> DataFrame:
    """For each cell with records: ``n_records``, distinct ``n_offsets``, ``first``, ``last``."""
    position = F.pmod("kafka_offset", F.lit(CELL))
    return (
        _celled(records)
        .groupBy(*PARTITION, "cell")
        .agg(
            F.count(F.lit(1)).alias("n_records"),
            F.bitmap_count(F.bitmap_construct_agg(position)).alias("n_offsets"),
            F.min("kafka_offset").alias("first"),
            F.max("kafka_offset").alias("last"),
        )
    )


def offset_summary(records: DataFrame) -> DataFrame:
    """For each topic partition the offsets that arrived, and how many are missing between
    the first and the last one or came again."""
    cells = offset_cells(records)
    return (
        cells.groupBy(*PARTITION)
        .agg(
            F.min("first").alias("first_offset"),
            F.max("last").alias("last_offset"),
            F.sum("n_records").alias("n_records"),
            F.sum("n_offsets").alias("n_offsets"),
        )
        .withColumn("n_missing", F.expr("last_offset - first_offset + 1 - n_offsets"))
        .withColumn("n_repeated", F.expr("n_records - n_offsets"))
    )


def _of_cells(records: DataFrame, cells: DataFrame) -> DataFrame:
    """The distinct offsets in some cells, and how often each arrived."""
    keys = [*PARTITION, "cell"]
    rows = _celled(records).join(cells.select(*keys), keys, "left_semi")
    return rows.groupBy(*keys, "kafka_offset").agg(F.count(F.lit(1)).alias("n_records"))


def _between(spans: DataFrame, *keys: str) -> DataFrame:
    """Ranges left open between spans ``first, last`` that do not overlap."""
    before = F.lag("last").over(W.partitionBy(*keys).orderBy("first"))
    ranges = spans.select(
        *PARTITION, (before + 1).alias("first_offset"), (F.col("first") - 1).alias("last_offset")
    )
    return ranges.where("first_offset <= last_offset")


def missing_offsets(records: DataFrame, cells: DataFrame | None = None) -> DataFrame:
    """Ranges ``first_offset, last_offset`` that never arrived between others that did.

    ``cells`` are the stored :func:`offset_cells`, if they are there already.
    """
    cells = stored(offset_cells(records), "cells") if cells is None else cells
    holed = cells.where("last - first + 1 > n_offsets")
    offset = F.col("kafka_offset")
    inside = _of_cells(records, holed).select(
        *PARTITION, "cell", offset.alias("first"), offset.alias("last")
    )
    grouped = cells.withColumn("cells", F.expr(f"cell DIV {GROUP}"))
    groups = grouped.groupBy(*PARTITION, "cells").agg(
        F.min("first").alias("first"), F.max("last").alias("last")
    )
    return (
        _between(inside, *PARTITION, "cell")
        .union(_between(grouped, *PARTITION, "cells"))
        .union(_between(groups, *PARTITION))
    )


def repeated_offsets(records: DataFrame, cells: DataFrame | None = None) -> DataFrame:
    """Offsets that arrived more than once, and how often."""
    cells = stored(offset_cells(records), "cells") if cells is None else cells
    rows = _of_cells(records, cells.where("n_records > n_offsets"))
    return rows.where("n_records > 1").select(*PARTITION, "kafka_offset", "n_records")


def offset_report(records: DataFrame) -> DataFrame:
    """Missing ranges and repeated offsets as ``kind, first_offset, last_offset, n_records``."""
    cells = stored(offset_cells(records), "cells")
    missing = missing_offsets(records, cells).select(
        F.lit("missing").alias("kind"),
        *PARTITION,
        "first_offset",
        "last_offset",
        F.lit(0).cast("bigint").alias("n_records"),
    )
    offset = F.col("kafka_offset")
    repeated = repeated_offsets(records, cells).select(
        F.lit("repeated").alias("kind"),
        *PARTITION,
        offset.alias("first_offset"),
        offset.alias("last_offset"),
        "n_records",
    )
    return missing.unionByName(repeated)
