"""The join with the line table, and the curated layer on disk."""

from collections import Counter
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from quayflow.operators.lines import is_broadcast, join_lines, on_marked_lines, roi_only
from quayflow.operators.passages import passages, project_passages, visits_of
from quayflow.plans.curated import curated_rows, enriched_rows, refresh_curated
from quayflow.schemas import CURATED, LINE_COLUMNS, RAW
from quayflow.sinks.files import write_curated
from quayflow.sources.tables import curated_table, on_ingest_date
from test_events import event, visit

LINES = (
    "siri_line_ref string, roi_label string, name string, short_name string, "
    "transport_mode string"
)
KEYS = "kafka_topic string, kafka_partition int, kafka_offset bigint, line_ref string"


@pytest.fixture
def lines(spark):
    return spark.createDataFrame(
        [
            ("STIF:Line::C1:", "RER A", "A", "A", "rail"),
            ("STIF:Line::C2:", None, "B", "B", "rail"),
            ("STIF:Line::C3:", "Bus 1", "1", "1", "bus"),
            ("STIF:Line::C3:", "Bus 1", "1 bis", "1", "bus"),
        ],
        LINES,
    )


REFS = [
    "STIF:Line::C1:",
    "STIF:Line::C2:",
    "STIF:Line::C3:",
    "STIF:Line::C1",
    "stif:line::c1:",
    "STIF:Line::C9:",
    None,
]


@pytest.mark.parametrize("salt", [None, 1, 4])
def test_join_matches_exactly(spark, lines, salt):
    facts = spark.createDataFrame([("t", 0, i, ref) for i, ref in enumerate(REFS)], KEYS)
    joined = join_lines(facts, lines, salt=salt)
    assert joined.columns == [*facts.columns, "roi_label", "name", "short_name", "transport_mode"]
    names = sorted((row.kafka_offset, row.name) for row in joined.collect() if row.name)
    assert names == [(0, "A"), (1, "B"), (2, "1"), (2, "1 bis")]
    assert joined.count() == len(REFS) + 1
    assert sorted(row.kafka_offset for row in roi_only(joined).collect()) == [0, 2, 2]


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_same_rows_with_and_without_broadcast(spark, lines, threshold):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        facts = spark.range(5000).select(
            F.lit("t").alias("kafka_topic"),
            F.lit(0).alias("kafka_partition"),
            F.col("id").alias("kafka_offset"),
            F.when(F.col("id") % 3 == 0, "STIF:Line::C1:")
            .when(F.col("id") % 3 == 1, F.lit(None))
            .otherwise("STIF:Line::C3:")
            .alias("line_ref"),
        )
        assert roi_only(join_lines(facts, lines)).count() == 1667 + 2 * 1666
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def raw_rows(spark, days=("2026-01-01", "2026-01-02")):
    rows = []
    for number, day in enumerate(days):
        moment = datetime.combine(date.fromisoformat(day), datetime.min.time())
        for offset, ref in enumerate(REFS):
            document = event([{"MonitoredStopVisit": [visit(offset, LineRef={"value": ref})]}])
            rows.append(("k", document, "t", number, offset, moment, moment, moment.date()))
        rows.append(("k", "{broken", "t", number, 99, moment, moment, moment.date()))
    return spark.createDataFrame(rows, RAW)


def schema_of(df):
    return {field.name: field.dataType.simpleString() for field in df.schema.fields}


def test_curated_columns(spark, lines):
    expected = dict(column.split() for column in CURATED.split(", "))
    visits = visits_of(raw_rows(spark))
    assert schema_of(curated_rows(visits, lines)) == expected
    assert curated_rows(visits, lines).columns == list(expected)
    assert passages(raw_rows(spark)).columns == list(expected)[:22]
    assert curated_rows(visits, lines).count() == 6
    assert enriched_rows(visits, lines).count() == 2 * (len(REFS) + 2)


def test_write_replaces_only_its_partitions(spark, lines, tmp_path):
    curated = curated_rows(visits_of(raw_rows(spark)), lines)
    path = str(tmp_path / "curated")
    write_curated(curated, path)
    assert curated_table(spark, path).count() == 6
    assert schema_of(curated_table(spark, path)) == schema_of(curated)
    first_day = on_ingest_date(curated, "2026-01-01").where("short_name = 'A'")
    write_curated(first_day.withColumn("name", F.lit("new")), path, "dynamic")
    names = {
        (str(row.ingest_date), row.roi_label): row.name
        for row in curated_table(spark, path).where("roi_label = 'RER A'").collect()
    }
    assert names == {("2026-01-01", "RER A"): "new", ("2026-01-02", "RER A"): "A"}
    assert curated_table(spark, path).count() == 6
    write_curated(first_day, path, "static")
    assert curated_table(spark, path).count() == 1


def test_refresh_leaves_no_rows_of_labels_that_are_gone(spark, lines, tmp_path):
    curated = curated_rows(visits_of(raw_rows(spark)), lines)
    path = str(tmp_path / "curated")
    write_curated(curated, path)
    whole = curated_table(spark, path).collect()
    day = on_ingest_date(curated, "2026-01-01")
    write_curated(day.where("roi_label = 'none left'"), path, ingest_date="2026-01-01")
    rows = curated_table(spark, path).collect()
    assert rows and {str(r.ingest_date) for r in rows} == {"2026-01-02"}
    assert len(rows) == sum(str(r.ingest_date) == "2026-01-02" for r in whole)
    write_curated(day, path, ingest_date="2026-01-01")
    assert Counter(curated_table(spark, path).collect()) == Counter(whole)
    write_curated(curated.where("short_name = 'A'"), path)
    assert {r.short_name for r in curated_table(spark, path).collect()} == {"A"}


def test_labels_that_look_like_numbers_stay_text(spark, lines, tmp_path):
    curated = curated_rows(visits_of(raw_rows(spark)), lines)
    path = str(tmp_path / "curated")
    write_curated(curated.withColumn("roi_label", F.lit("007")), path)
    assert {r.roi_label for r in curated_table(spark, path).collect()} == {"007"}


def test_hot_partition_is_split_and_small_ones_are_not(spark, lines, tmp_path):
    """One label of one date with most rows: several tasks write it, none of the others."""
    row = curated_rows(visits_of(raw_rows(spark, ["2026-01-01"])), lines).where("name = 'A'")
    numbers = spark.range(0, 200_800, 1, 8)
    rows = numbers.crossJoin(F.broadcast(row)).select(
        F.sha2(F.col("id").cast("string"), 256).alias("item_identifier"),
        F.when(F.col("id") % 251 == 0, "Bus 1").otherwise("RER A").alias("roi_label"),
        *[name for name in row.columns if name not in ("item_identifier", "roi_label")],
    )
    advisory = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(advisory)
    spark.conf.set(advisory, "2m")
    try:
        path = tmp_path / "curated"
        write_curated(rows, str(path))
    finally:
        spark.conf.set(advisory, before)
    files = {
        folder.name: len(list(folder.glob("*.parquet")))
        for folder in (path / "ingest_date=2026-01-01").iterdir()
        if folder.is_dir()
    }
    assert files["roi_label=RER A"] > 2
    assert files["roi_label=Bus 1"] == 1
    assert curated_table(spark, str(path)).count() == 200_800


def test_refresh_job(spark, lines, tmp_path):
    raw, csv, curated = (str(tmp_path / name) for name in ("raw", "lines", "curated"))
    raw_rows(spark).write.partitionBy("ingest_date").parquet(raw)
    lines.write.option("header", True).csv(csv)
    counts = refresh_curated(spark, raw, csv, curated)
    assert counts == {"raw_rows": 16, "unreadable_rows": 2, "curated_rows": 6}
    again = refresh_curated(spark, raw, csv, curated, ingest_date="2026-01-02")
    assert again == {"raw_rows": 8, "unreadable_rows": 1, "curated_rows": 3}
    assert curated_table(spark, curated).count() == 6
    strict = refresh_curated(spark, raw, csv, curated, times="strict", overwrite="static")
    assert strict["curated_rows"] == 6
    assert curated_table(spark, curated).where("expected_departure_time is not null").count() == 0


@pytest.mark.parametrize("text", ["2026-13-01", "yesterday", "2026/01/01"])
def test_wrong_date_is_reported(spark, text):
    with pytest.raises(ValueError, match="yyyy-MM-dd"):
        on_ingest_date(spark.createDataFrame([], RAW), text)


@pytest.mark.parametrize("text", [None, ""])
def test_no_date_keeps_all(spark, text):
    raw = spark.createDataFrame([], RAW)
    assert on_ingest_date(raw, text) is raw


def test_salt_must_be_positive(spark, lines):
    with pytest.raises(ValueError, match="salt"):
        join_lines(spark.createDataFrame([], KEYS), lines, salt=0)


def test_visits_on_no_line_of_interest_do_not_reach_a_shuffled_join(spark):
    refs = [f"STIF:Line::C{i}:" for i in range(1000)] + [None]
    visits = spark.createDataFrame([(ref, i) for i, ref in enumerate(refs * 2)], "line_ref string, n int")
    few = [(ref, "x") for ref in refs[:50]] + [(refs[0], "again"), (None, "x")]
    lines = spark.createDataFrame(few, "siri_line_ref string, roi_label string")
    kept = Counter(row.line_ref for row in on_marked_lines(visits, lines).collect())
    assert all(kept[ref] == 2 for ref in refs[:50])
    assert sum(kept.values()) <= 110
    assert on_marked_lines(visits, lines).columns == visits.columns
    assert on_marked_lines(visits, lines.limit(0)).count() == 0


def test_curated_rows_are_the_same_with_a_shuffled_join(spark, lines):
    visits = visits_of(raw_rows(spark))
    broadcast = Counter(map(str, curated_rows(visits, lines).collect()))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert not is_broadcast(lines)
        rows = curated_rows(visits, lines)
        assert "mark_bits" in rows._jdf.queryExecution().toString()
        assert Counter(map(str, rows.collect())) == broadcast
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture
def many_lines(spark):
    """Lines beyond the broadcast threshold; one occurs twice."""
    number = F.col("id") % 1999
    lines = spark.range(2000).select(
        F.concat(F.lit("STIF:Line::C"), number, F.lit(":")).alias("siri_line_ref"),
        *[F.concat(F.lit(f"{name} "), "id").alias(name) for name in LINE_COLUMNS],
    )
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    size = int(str(lines._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    spark.conf.set(key, str(size // 4))
    yield lines
    spark.conf.set(key, before)


def joins_of(df):
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return {name for name in ("ShuffledHashJoin", "SortMergeJoin", "BroadcastHashJoin") if name in text}


def test_left_join_of_many_lines_sorts_no_visits(spark, many_lines):
    """Sorting the visits for a merge spilled them at size."""
    enriched = enriched_rows(visits_of(raw_rows(spark)), many_lines)
    assert joins_of(enriched) == {"ShuffledHashJoin"}
    assert enriched.columns == [name.split()[0] for name in CURATED.split(", ")]
    expected = Counter()
    held = {}
    for row in many_lines.collect():
        held.setdefault(row.siri_line_ref, []).append(tuple(row)[1:])
    for row in passages(raw_rows(spark)).collect():
        for line in held.get(row.line_ref, [(None,) * 4]):
            expected[(*row, *line)] += 1
    assert Counter(map(tuple, enriched.collect())) == expected


def test_left_join_moves_columns_not_parsed_visits(spark, many_lines):
    plan = enriched_rows(visits_of(raw_rows(spark)), many_lines)._jdf.queryExecution()
    visits = plan.optimizedPlan().toString().partition("Join LeftOuter")[2]
    assert visits.strip().splitlines()[1].strip(" :+-").startswith("Project [ingest_date")


def test_salted_join_of_many_lines_sorts_no_visits(spark, many_lines):
    visits = project_passages(visits_of(raw_rows(spark)))
    plain, salted = join_lines(visits, many_lines), join_lines(visits, many_lines, salt=2)
    assert joins_of(salted) == {"ShuffledHashJoin"}
    assert Counter(map(tuple, salted.collect())) == Counter(map(tuple, plain.collect()))
