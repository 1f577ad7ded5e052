"""Layers with manifests: incremental refresh, readers during a refresh, compaction."""

from collections import Counter
from datetime import date, datetime

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from quayflow.plans import curated as curated_plan
from quayflow.plans.compaction import compact_raw, remove_originals
from quayflow.plans.curated import refresh_curated, refresh_versions
from quayflow.schemas import RAW
from quayflow.sinks.files import write_raw
from quayflow.sources import manifest as manifests
from quayflow.sources.manifest import Manifest, publish, read_manifest, remove_unreferenced
from quayflow.sources.tables import curated_table, curated_version, raw_files, raw_table
from test_events import event, visit
from test_lines import LINES
from test_streaming import add_records, ingest

DAYS = [date(2026, 1, 1), date(2026, 1, 2), date(2026, 1, 3)]


def raw_rows(spark, day, offsets):
    ts = datetime(day.year, day.month, day.day, 12)
    rows = [("k", event([{"MonitoredStopVisit": [visit(f"{day}-{o}")]}]), "t", 0, o, ts, ts, day) for o in offsets]
    return spark.createDataFrame(rows, RAW)


@pytest.fixture
def layer(spark, tmp_path):
    lines = str(tmp_path / "lines")
    rows = [("STIF:Line::C1:", "RER A", "A", "A", "rail"), ("STIF:Line::C2:", "B", "B", "B", "rail")]
    spark.createDataFrame(rows, LINES).write.option("header", True).csv(lines)
    return str(tmp_path / "raw"), lines, str(tmp_path / "curated")


def items(df):
    return Counter(row.item_identifier for row in df.select("item_identifier").collect())


def full(spark, raw, lines, tmp_path):
    path = str(tmp_path / "full")
    refresh_curated(spark, raw, lines, path)
    return Counter(map(tuple, curated_table(spark, path).collect()))


def test_incremental_equals_full_and_reads_only_new_files(spark, tmp_path, layer, monkeypatch):
    raw, lines, curated = layer
    read = []
    rows_of = curated_plan.raw_rows_of

    def spy(spark, path, files):
        rows = rows_of(spark, path, files)
        read.append({f.rpartition("/")[2] for f in rows.inputFiles()})
        return rows

    monkeypatch.setattr(curated_plan, "raw_rows_of", spy)
    write_raw(raw_rows(spark, DAYS[0], range(4)).union(raw_rows(spark, DAYS[1], range(3))), raw)
    before = {f.rpartition("/")[2] for f in raw_files(spark, raw)}
    counts = refresh_versions(spark, raw, lines, curated, incremental=True)
    assert (counts["raw_rows"], counts["curated_rows"]) == (7, 7)
    write_raw(raw_rows(spark, DAYS[1], range(10, 12)).union(raw_rows(spark, DAYS[2], range(2))), raw)
    counts = refresh_versions(spark, raw, lines, curated, incremental=True)
    assert (counts["raw_rows"], counts["curated_rows"]) == (4, 4)
    assert read[0] == before and read[1] and not read[1] & before
    assert refresh_versions(spark, raw, lines, curated, incremental=True)["raw_files"] == 0
    rows = curated_table(spark, curated)
    assert Counter(map(tuple, rows.collect())) == full(spark, raw, lines, tmp_path)
    assert rows.columns[-2:] == ["ingest_date", "roi_label"]
    # the untouched date's files are those of the first version
    manifest = read_manifest(spark, curated)
    assert [len(manifest.folders[f"ingest_date={day}"]) for day in DAYS] == [1, 2, 1]


def test_one_date_and_whole_refresh_replace(spark, tmp_path, layer):
    raw, lines, curated = layer
    write_raw(raw_rows(spark, DAYS[0], range(3)).union(raw_rows(spark, DAYS[1], range(3))), raw)
    refresh_versions(spark, raw, lines, curated)
    refresh_versions(spark, raw, lines, curated, ingest_date="2026-01-02")
    refresh_versions(spark, raw, lines, curated, incremental=True)
    assert sum(items(curated_table(spark, curated)).values()) == 6
    refresh_versions(spark, raw, lines, curated)
    assert set(items(curated_table(spark, curated)).values()) == {1}
    gone = remove_unreferenced(spark, curated, keep=1)
    assert gone and set(items(curated_table(spark, curated)).values()) == {1}
    assert remove_unreferenced(spark, curated, keep=1) == []


def test_readers_see_the_old_version_whole_during_and_after_a_failure(spark, layer, monkeypatch):
    raw, lines, curated = layer
    write_raw(raw_rows(spark, DAYS[0], range(3)), raw)
    refresh_versions(spark, raw, lines, curated)
    reader = curated_table(spark, curated)
    want = items(reader)
    write_raw(raw_rows(spark, DAYS[0], range(10, 13)), raw)
    during = []

    def fail(spark_, path, version):
        # all files of the new version are there, its manifest is not
        during.append(items(curated_table(spark, curated)))
        raise OSError("lost")

    monkeypatch.setattr(curated_plan, "written_folders", fail)
    with pytest.raises(OSError):
        refresh_versions(spark, raw, lines, curated, incremental=True)
    monkeypatch.undo()
    assert during == [want] and items(reader) == want
    assert items(curated_table(spark, curated)) == want
    # what the failed refresh left is not part of the next one
    refresh_versions(spark, raw, lines, curated, incremental=True)
    assert set(items(curated_table(spark, curated)).values()) == {1}
    assert sum(items(curated_table(spark, curated)).values()) == 6
    # a reader that began before stays with its version, which can be read by number
    assert items(reader) == want == items(curated_version(spark, curated, 1))


def test_two_writers_cannot_publish_the_same_number(spark, tmp_path):
    path = str(tmp_path / "layer")
    publish(spark, path, Manifest(1, {"ingest_date=2026-01-01": ["a"]}, ["a"]))
    with pytest.raises(FileExistsError):
        publish(spark, path, Manifest(1, {}, []))
    assert read_manifest(spark, path).ledgers == ["a"]
    assert manifests.child_names(spark, f"{path}/_manifest") == ["00000001.json"]


def test_layers_without_rows(spark, layer):
    raw, lines, curated = layer
    write_raw(raw_rows(spark, DAYS[0], range(2)).withColumn("raw_json", F.lit("broken")), raw)
    counts = refresh_versions(spark, raw, lines, curated)
    assert (counts["raw_rows"], counts["curated_rows"]) == (2, 0)
    assert curated_table(spark, curated).count() == 0
    with pytest.raises(ValueError, match="manifests"):
        refresh_curated(spark, raw, lines, curated)


def test_compaction_of_a_streams_dates(spark, tmp_path):
    """The stream goes on; readers see each row once, from few files."""
    raw = str(tmp_path / "raw")
    for batch in range(6):
        add_records(spark, tmp_path / "in", [f"{batch}-{i}" for i in range(5)], 5 * batch)
        ingest(spark, tmp_path)
    want = Counter(map(tuple, raw_table(spark, raw).collect()))
    day = raw_table(spark, raw).first().ingest_date.isoformat()
    assert len(raw_files(spark, raw, day)) == 6
    counts = compact_raw(spark, raw, day)
    assert counts == {"files": 6, "compacted_files": 1}
    rows = raw_table(spark, raw)
    assert len(rows.inputFiles()) == 1
    assert Counter(map(tuple, rows.collect())) == want and rows.dtypes == spark.createDataFrame([], RAW).dtypes
    assert compact_raw(spark, raw, day)["files"] == 0
    # late files of the date are read beside the compacted ones, and the log is as it was
    add_records(spark, tmp_path / "in", ["late"], 100)
    ingest(spark, tmp_path)
    assert raw_table(spark, raw).count() == 31 == spark.read.schema(RAW).parquet(raw).count()
    assert len(raw_table(spark, raw).inputFiles()) == 2
    assert raw_table(spark, raw, day).count() == 31 and raw_table(spark, raw, "2020-01-01").count() == 0
    assert remove_originals(spark, raw) == 6
    assert raw_table(spark, raw).count() == 31
    assert compact_raw(spark, raw, day)["files"] == 1
    assert raw_table(spark, raw).count() == 31
    # the stream starts again where it was
    add_records(spark, tmp_path / "in", ["next"], 101)
    ingest(spark, tmp_path)
    assert raw_table(spark, raw).count() == 32


def test_compacted_files_are_bounded(spark, tmp_path):
    raw = str(tmp_path / "raw")
    for _ in range(8):
        write_raw(raw_rows(spark, DAYS[0], range(200)).coalesce(1), raw)
    total = sum((tmp_path / "raw/ingest_date=2026-01-01" / f.rpartition("/")[2]).stat().st_size for f in raw_files(spark, raw))
    counts = compact_raw(spark, raw, "2026-01-01", target_bytes=total // 2)
    assert counts["compacted_files"] in (2, 3)
    assert len(raw_table(spark, raw).inputFiles()) <= counts["compacted_files"]
    assert raw_table(spark, raw).count() == 1600


def test_a_compacted_date_is_not_sorted(spark, tmp_path, monkeypatch):
    """A write that is partitioned by columns sorted all of a file's documents."""
    raw = str(tmp_path / "raw")
    for n in range(2):
        write_raw(raw_rows(spark, DAYS[0], range(n, 9)), raw)
    want = Counter(map(tuple, raw_table(spark, raw).collect()))
    monkeypatch.setattr(DataFrameWriter, "partitionBy", lambda *columns: pytest.fail("sorts"))
    compact_raw(spark, raw, "2026-01-01")
    assert Counter(map(tuple, raw_table(spark, raw).collect())) == want
    assert all("_compacted" in name for name in raw_table(spark, raw).inputFiles())
