"""Parquet and text outputs."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import date
from typing import Literal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayflow.sources.manifest import read_manifest

Overwrite = Literal["dynamic", "static"]
CURATED_PARTITIONS = ["ingest_date", "roi_label"]
# documents are alike: half of what the default codec leaves of them, or less
CODEC = "zstd"
# lines of text repeat the names of tags and fields: a tenth of them is left; every reader has it
TEXT_CODEC = "gzip"
# Files a task writes at a time, each holding a row group of so many bytes in memory.
OPEN_FILES = 16
GROUP_BYTES = 16 << 20
_OPEN_FILES_KEY = "spark.sql.maxConcurrentOutputFileWriters"


@contextmanager
def unsorted_writes(spark: SparkSession) -> Iterator[None]:
    """Partitioned writes keep up to ``OPEN_FILES`` files open instead of sorting, and thereby
    spilling, a task's rows first. Tasks with more partitions than that sort the rest."""
    before = spark.conf.get(_OPEN_FILES_KEY)
    spark.conf.set(_OPEN_FILES_KEY, OPEN_FILES)
    try:
        yield
    finally:
        spark.conf.set(_OPEN_FILES_KEY, before)


def write_raw(raw: DataFrame, path: str) -> None:
    """Append a batch of raw rows, partitioned by ingestion date, as the stream does.

    Without a shuffle and a sort: documents are wide, and the records of one task arrived
    on few dates.
    """
    writer = raw.write.mode("append").option("compression", CODEC)
    with unsorted_writes(raw.sparkSession):
        writer.option("parquet.block.size", GROUP_BYTES).partitionBy("ingest_date").parquet(path)


def write_curated(
    curated: DataFrame,
    path: str,
    overwrite: Overwrite = "static",
    ingest_date: str | None = None,
) -> None:
    """Overwrite the curated layer, partitioned by ingestion date and line label.

    ``static`` replaces the whole path or, where all rows are of ``ingest_date``, that
    date's folder: labels that are gone leave no rows behind. ``dynamic`` replaces only
    the partitions that get rows.

    The rebalance brings the rows of a partition together, so each gets a few
    files of the advisory size instead of one from every task, and splits a
    partition beyond that size over several tasks, however hot its label is.

    Readers of the replaced part see it incomplete until this is done; see
    :func:`write_version` for a layer whose readers never do.
    """
    if read_manifest(curated.sparkSession, path.rstrip("/")):
        raise ValueError(f"{path} has manifests; refresh its versions instead")
    partitions = CURATED_PARTITIONS
    if ingest_date and overwrite == "static":
        path = f"{path.rstrip('/')}/ingest_date={date.fromisoformat(ingest_date)}"
        curated, partitions = curated.drop("ingest_date"), CURATED_PARTITIONS[1:]
    writer = (
        curated.hint("rebalance", *partitions)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", overwrite)
        .option("compression", CODEC)
        .option("parquet.block.size", GROUP_BYTES)
    )
    with unsorted_writes(curated.sparkSession):
        writer.partitionBy(*partitions).parquet(path)


def write_version(rows: DataFrame, path: str, version: str, *partitions: str) -> None:
    """Write rows into ``version`` folders below their dates'; no reader sees them until a
    manifest names the version. ``partitions`` divide a version's folder, rebalanced."""
    versioned = rows.withColumn("version", F.lit(version))
    if partitions:
        versioned = versioned.hint("rebalance", "ingest_date", *partitions)
    writer = versioned.write.mode("append").option("compression", CODEC)
    with unsorted_writes(rows.sparkSession):
        writer.option("parquet.block.size", GROUP_BYTES).partitionBy(
            "ingest_date", "version", *partitions
        ).parquet(path)


def write_date(rows: DataFrame, path: str, version: str, ingest_date: str) -> None:
    """Write rows of one date as ``write_version`` does, but into the folder itself: a write
    that is told its partitions by columns sorts each task's rows by them first."""
    folder = f"{path}/ingest_date={date.fromisoformat(ingest_date)}/version={version}"
    rows.drop("ingest_date").write.option("compression", CODEC).parquet(folder)


def write_points(points: DataFrame, path: str, mode: str = "append") -> None:
    """Points as Parquet."""
    points.write.mode(mode).option("compression", CODEC).parquet(path)


def write_lines(
    lines: DataFrame, path: str, mode: str = "append", codec: str = TEXT_CODEC
) -> None:
    """Line protocol as text files, compressed unless ``codec`` is ``none``.

    One task reads a compressed file; a file holds what one task wrote.
    """
    lines.write.mode(mode).option("compression", codec).text(path)
