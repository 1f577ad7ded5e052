"""Raw dates of many small files to few large ones."""

from __future__ import annotations

from pyspark.sql import SparkSession

from quayflow.sinks.files import write_date
from quayflow.sources.manifest import (
    Manifest,
    files_not_in,
    ledger,
    publish,
    read_manifest,
    write_ledger,
    written_folders,
)
from quayflow.sources.storage import delete, file_sizes
from quayflow.sources.tables import COMPACTED, raw_files, raw_rows_of

TARGET_BYTES = 256 << 20


def compact_raw(
    spark: SparkSession, path: str, ingest_date: str, target_bytes: int = TARGET_BYTES
) -> dict[str, int]:
    """Join the files of a closed date into as few as ``target_bytes`` allow.

    The rows are not shuffled. The stream's files and its log stay as they are, so the
    stream and what reads its folder go on as before; ``raw_table`` reads the compacted files
    from the moment their manifest is there. Files that arrive for the date later are read on
    their own until the date is compacted again, which then takes only those.
    """
    path = path.rstrip("/")
    base = f"{path}/{COMPACTED}"
    before = read_manifest(spark, base) or Manifest()
    listed = raw_files(spark, path, ingest_date)
    files = files_not_in(spark, listed, ledger(spark, base, before))
    if not files:
        return {"files": 0, "compacted_files": 0}
    sizes = file_sizes(spark, f"{path}/ingest_date={ingest_date}")
    total = sum(sizes[name.rpartition("/")[2]] for name in files)
    version = before.new_version()
    # the scan packs small files into partitions of about equal size, which are joined here
    n_files = -(-total // target_bytes)
    rows = raw_rows_of(spark, path, files).coalesce(n_files)
    write_date(rows, base, version, ingest_date)
    write_ledger(spark, base, version, files)
    publish(spark, base, before.added(version, written_folders(spark, base, version)))
    return {"files": len(files), "compacted_files": n_files}


def remove_originals(spark: SparkSession, path: str) -> int:
    """Delete the small files that compacted ones replace.

    After that the layer must be read by ``raw_table``: the stream's log still names the
    files. Refreshes of new files only must have read them before.
    """
    path = path.rstrip("/")
    base = f"{path}/{COMPACTED}"
    manifest = read_manifest(spark, base) or Manifest()
    names = ledger(spark, base, manifest).distinct().toLocalIterator()
    n = 0
    for row in names:
        delete(spark, row.file)
        n += 1
    return n
