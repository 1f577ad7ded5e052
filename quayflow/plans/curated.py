"""Raw layer to curated layer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayflow.functions.times import TimeMode
from quayflow.operators.counts import counted
from quayflow.operators.lines import is_broadcast, join_lines, on_marked_lines, roi_only
from quayflow.operators.passages import (
    explode_visits,
    lift_deliveries,
    parse_events,
    project_passages,
    with_line_ref,
)
from quayflow.schemas import CURATED, LINE_COLUMNS
from quayflow.sinks.files import Overwrite, write_curated, write_version
from quayflow.sources.manifest import (
    Manifest,
    files_not_in,
    ledger,
    publish,
    read_manifest,
    write_ledger,
    written_folders,
)
from quayflow.sources.tables import lines_csv, manifest_rows, raw_files, raw_rows_of, raw_table


def enriched_rows(visits: DataFrame, lines: DataFrame, times: TimeMode = "tolerant") -> DataFrame:
    """The 26 columns of all visits; those on unknown lines have no line columns.

    All visits stay, so the projection comes before the join: its columns take fewer bytes
    in a shuffle than the parsed visits.
    """
    return join_lines(project_passages(visits, times), lines)


def curated_rows(visits: DataFrame, lines: DataFrame, times: TimeMode = "tolerant") -> DataFrame:
    """The 26 columns of the visits on lines of interest.

    The join comes before the projection, so times and texts are read only for
    the visits that stay. Where the lines are too many to broadcast, visits that are
    surely on none of interest are left out before the join's shuffle.
    """
    if not is_broadcast(lines):
        visits = on_marked_lines(visits, roi_only(lines))
    return project_passages(roi_only(join_lines(visits, lines)), times, LINE_COLUMNS)


def _no_envelope() -> Column:
    """Documents of which no declared field could be read."""
    names = ("event_source", "event_version", "producer_ts_raw", "monitoring_ref", "deliveries")
    return F.coalesce(*[F.col(name).cast("string") for name in names]).isNull()


def refresh_curated(
    spark: SparkSession,
    raw_path: str,
    lines_path: str,
    curated_path: str,
    *,
    ingest_date: str | None = None,
    times: TimeMode = "tolerant",
    overwrite: Overwrite = "static",
) -> dict[str, int]:
    """Rebuild the curated layer, or one date of it, and count rows on the way.

    One action: the counts come from the write itself, so nothing is parsed twice.
    """
    lifted, events = counted(
        lift_deliveries(parse_events(raw_table(spark, raw_path, ingest_date))),
        unreadable=F.count_if(_no_envelope()),
    )
    visits = with_line_ref(explode_visits(lifted))
    rows, curated = counted(curated_rows(visits, lines_csv(spark, lines_path), times))
    write_curated(rows, curated_path, overwrite, ingest_date)
    return {
        "raw_rows": events.get["rows"],
        "unreadable_rows": events.get["unreadable"],
        "curated_rows": curated.get["rows"],
    }


def refresh_versions(
    spark: SparkSession,
    raw_path: str,
    lines_path: str,
    curated_path: str,
    *,
    ingest_date: str | None = None,
    times: TimeMode = "tolerant",
    incremental: bool = False,
) -> dict[str, int]:
    """Write a new version of the curated layer, whole, of one date, or of new raw files only.

    Readers see the layer as before until the version's manifest is there, and after a
    failure still. ``incremental`` parses only raw files that no earlier version was made
    from and adds their rows; the lines must be those of the earlier versions, else a whole
    refresh is due. The counts come from the files read and written, not from tasks, which
    may run twice.
    """
    raw_path, curated_path = raw_path.rstrip("/"), curated_path.rstrip("/")
    before = read_manifest(spark, curated_path) or Manifest()
    files = raw_files(spark, raw_path, ingest_date)
    if incremental:
        files = files_not_in(spark, files, ledger(spark, curated_path, before))
    if incremental and not files:
        return {"raw_files": 0, "raw_rows": 0, "curated_rows": 0}
    version = before.new_version()
    raw = raw_rows_of(spark, raw_path, files)
    visits = with_line_ref(explode_visits(lift_deliveries(parse_events(raw))))
    rows = curated_rows(visits, lines_csv(spark, lines_path), times)
    write_version(rows, curated_path, version, "roi_label")
    write_ledger(spark, curated_path, version, files)
    folders = written_folders(spark, curated_path, version)
    if incremental:
        after = before.added(version, folders)
    else:
        only = f"ingest_date={ingest_date}" if ingest_date else None
        after = before.replaced(version, folders, only)
    publish(spark, curated_path, after)
    written = Manifest(folders={folder: [version] for folder in folders})
    return {
        "raw_files": len(files),
        "raw_rows": raw.count(),
        "curated_rows": manifest_rows(spark, curated_path, CURATED, written).count(),
    }
