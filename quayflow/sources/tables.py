"""Raw and curated Parquet layers and the CSV reference tables."""

from __future__ import annotations

from datetime import date
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayflow.schemas import CURATED, RAW
from quayflow.sources.manifest import Manifest, files_not_in, ledger, read_manifest, version_paths

COMPACTED = "_compacted"  # the folder of a raw layer that holds its compacted dates


def on_ingest_date(df: DataFrame, ingest_date: str | None) -> DataFrame:
    """Keep one ingestion date; None or the empty string keeps all.

    The date is checked here and compared as a DATE, so a typing error is
    reported instead of failing inside a task, and partitions are pruned.
    """
    if not ingest_date:
        return df
    return df.where(F.col("ingest_date") == F.lit(_day(ingest_date)))


def _day(text: str) -> date:
    try:
        return date.fromisoformat(text)
    except ValueError as err:
        raise ValueError(f"ingest date must be yyyy-MM-dd, not {text!r}") from err


def manifest_rows(spark: SparkSession, path: str, schema: str, manifest: Manifest) -> DataFrame:
    """The rows of a manifest's folders; pinned to it, whatever is written meanwhile."""
    paths = version_paths(path, manifest)
    reader = spark.read.schema(f"{schema}, version string").option("basePath", path)
    if not paths:
        return spark.createDataFrame([], schema)
    return reader.parquet(*paths).drop("version")


def raw_files(spark: SparkSession, path: str, ingest_date: str | None = None) -> list[str]:
    """The raw layer's files, of a stream's folder those that its log has."""
    names = [unquote(name) for name in spark.read.schema(RAW).parquet(path).inputFiles()]
    if not ingest_date:
        return names
    folder = f"/ingest_date={_day(ingest_date).isoformat()}/"
    return [name for name in names if folder in name]


def raw_table(spark: SparkSession, path: str, ingest_date: str | None = None) -> DataFrame:
    """The raw layer, optionally one partition of it.

    Compacted dates are read from their compacted files, and what arrived for them since
    from its own.
    """
    path = path.rstrip("/")
    base = f"{path}/{COMPACTED}"
    manifest = read_manifest(spark, base)
    if manifest is None:
        return on_ingest_date(spark.read.schema(RAW).parquet(path), ingest_date)
    rows = manifest_rows(spark, base, RAW, manifest)
    left = files_not_in(spark, raw_files(spark, path, ingest_date), ledger(spark, base, manifest))
    if left:
        rest = spark.read.schema(RAW).option("basePath", path).parquet(*left)
        rows = rows.unionByName(rest)
    return on_ingest_date(rows, ingest_date)


def raw_rows_of(spark: SparkSession, path: str, files: list[str]) -> DataFrame:
    """The rows of some of the raw layer's files."""
    if not files:
        return spark.createDataFrame([], RAW)
    return spark.read.schema(RAW).option("basePath", path).parquet(*files)


def raw_stream(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """The raw layer as a stream of its files."""
    reader = spark.readStream.schema(RAW)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def curated_table(spark: SparkSession, path: str) -> DataFrame:
    """The curated layer; the declared types keep a label like ``007`` text.

    A layer with manifests is read as the newest one has it.
    """
    path = path.rstrip("/")
    manifest = read_manifest(spark, path)
    if manifest is None:
        return spark.read.schema(CURATED).parquet(path)
    return manifest_rows(spark, path, CURATED, manifest)


def curated_version(spark: SparkSession, path: str, number: int) -> DataFrame:
    """The curated layer as an earlier manifest has it."""
    path = path.rstrip("/")
    manifest = read_manifest(spark, path, number)
    return manifest_rows(spark, path, CURATED, manifest)


def lines_csv(spark: SparkSession, path: str) -> DataFrame:
    """Line reference table: names from the header, every column text, quotes doubled."""
    return spark.read.option("header", True).option("escape", '"').csv(path)


def stops_csv(spark: SparkSession, path: str) -> DataFrame:
    """Stop reference table: UTF-8, quotes doubled inside quoted values."""
    return (
        spark.read.option("header", True)
        .option("encoding", "UTF-8")
        .option("escape", '"')
        .option("multiLine", True)
        .csv(path)
    )


def message_lines(spark: SparkSession, path: str) -> DataFrame:
    """``message`` for each line of text files that is not blank."""
    lines = spark.read.text(path).withColumnRenamed("value", "message")
    return lines.where(F.trim("message") != "")
