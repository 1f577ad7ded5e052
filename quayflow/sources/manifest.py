"""Manifests: which folders of a layer its readers see, and what source files are in them.

A layer with a manifest keeps each write in folders of its own, ``ingest_date=D/version=V``.
A manifest names the versions that make up each date. It is one small file that appears
whole under a number one above the last, so readers see a layer before or after a write and
never between, a failed write is not seen at all, and of two writers at a time one fails.

What source files a version was made from is a table, its ledger, beside the folders. File
names are compared by Spark; only the names of files still to be read go to the driver,
which needs them for reading.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from quayflow.sources.storage import child_names, delete, read_text, write_new

MANIFESTS = "_manifest"
LEDGERS = "_ledger"


@dataclass(frozen=True)
class Manifest:
    """``folders`` has the versions of each date's folder, ``ledgers`` those whose source
    files are part of the layer."""

    number: int = 0
    folders: dict[str, list[str]] = field(default_factory=dict)
    ledgers: list[str] = field(default_factory=list)

    def new_version(self) -> str:
        """A name no other write has, not even a failed one."""
        return f"{self.number + 1:08d}-{uuid.uuid4().hex[:8]}"

    def replaced(self, version: str, folders: list[str], only: str | None = None) -> Manifest:
        """After ``version`` took the place of all there was, or of one folder."""
        kept = {} if only is None else {f: v for f, v in self.folders.items() if f != only}
        ledgers = [version] if only is None else [*self.ledgers, version]
        return Manifest(self.number + 1, kept | {f: [version] for f in folders}, ledgers)

    def added(self, version: str, folders: list[str]) -> Manifest:
        """After ``version`` was added to what there was."""
        grown = {f: [*self.folders.get(f, []), version] for f in folders}
        return Manifest(self.number + 1, self.folders | grown, [*self.ledgers, version])


def _numbers(spark: SparkSession, path: str) -> list[str]:
    names = child_names(spark, f"{path}/{MANIFESTS}")
    return [name for name in names if name.endswith(".json") and not name.startswith(".")]


def read_manifest(spark: SparkSession, path: str, number: int | None = None) -> Manifest | None:
    """The newest manifest of a layer, or one by its number; None for a layer without any."""
    names = _numbers(spark, path)
    if not names:
        return None
    name = names[-1] if number is None else f"{number:08d}.json"
    return Manifest(**json.loads(read_text(spark, f"{path}/{MANIFESTS}/{name}")))


def publish(spark: SparkSession, path: str, manifest: Manifest) -> None:
    """Make a manifest the newest; ``FileExistsError`` if another writer was faster."""
    text = json.dumps(
        {"number": manifest.number, "folders": manifest.folders, "ledgers": manifest.ledgers}
    )
    write_new(spark, f"{path}/{MANIFESTS}/{manifest.number:08d}.json", text)


def written_folders(spark: SparkSession, path: str, version: str) -> list[str]:
    """The dates' folders that have a version."""
    names = [name for name in child_names(spark, path) if name.startswith("ingest_date=")]
    return [n for n in names if f"version={version}" in child_names(spark, f"{path}/{n}")]


def version_paths(path: str, manifest: Manifest) -> list[str]:
    """The folders that readers of a manifest read."""
    return [f"{path}/{f}/version={v}" for f, versions in manifest.folders.items() for v in versions]


def write_ledger(spark: SparkSession, path: str, version: str, files: list[str]) -> None:
    rows = spark.createDataFrame([(name,) for name in files], "file string")
    rows.write.parquet(f"{path}/{LEDGERS}/version={version}")


def ledger(spark: SparkSession, path: str, manifest: Manifest) -> DataFrame:
    """``file`` for each source file in the layer."""
    paths = [f"{path}/{LEDGERS}/version={version}" for version in manifest.ledgers]
    if not paths:
        return spark.createDataFrame([], "file string")
    return spark.read.schema("file string").parquet(*paths)


def files_not_in(spark: SparkSession, files: list[str], known: DataFrame) -> list[str]:
    """Those of ``files`` that a ledger does not have."""
    listed = spark.createDataFrame([(name,) for name in files], "file string")
    return sorted(row.file for row in listed.join(known, "file", "left_anti").collect())


def remove_unreferenced(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete versions that none of the last ``keep`` manifests names, and older manifests.

    Readers of an older manifest must be done, and no write may be under way.
    """
    names = _numbers(spark, path)
    kept = [read_manifest(spark, path, int(name[:-5])) for name in names[-keep:]]
    seen = {p for manifest in kept for p in version_paths(path, manifest)}
    gone = []
    for folder in child_names(spark, path):
        if folder.startswith("ingest_date="):
            versions = [f"{path}/{folder}/{name}" for name in child_names(spark, f"{path}/{folder}")]
            gone += [version for version in versions if version not in seen]
    ledgers = {f"version={version}" for manifest in kept for version in manifest.ledgers}
    names_there = child_names(spark, f"{path}/{LEDGERS}")
    gone += [f"{path}/{LEDGERS}/{name}" for name in names_there if name not in ledgers]
    gone += [f"{path}/{MANIFESTS}/{name}" for name in names[:-keep]]
    for name in gone:
        delete(spark, name)
    return gone
