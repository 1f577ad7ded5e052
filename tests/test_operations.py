"""Offsets, repeated reports and departure indicators on small hand-made tables."""

import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quayflow.operators import kpis, offsets
from quayflow.operators.visits import last_reports
from quayflow.plans import operations
from quayflow.streaming.control import wait
from quayflow.streaming.departure_kpis import start_departure_kpis
from quayflow.streaming.visit_reports import start_visit_reports

# --- offsets

RECORD = "kafka_topic string, kafka_partition int, kafka_offset bigint, value string"


def offset_rows():
    generator = random.Random(4)
    rows = []
    for topic, partition, start, n in (("a", 0, 0, 200_000), ("a", 1, 5, 70_000), ("b", 0, 10**12, 3000)):
        lost = set(generator.sample(range(n), n // 50)) | set(range(n // 3, n // 3 + n // 6))
        if partition == 0:
            lost |= set(range(32_768 - 3, 32_768 + 2)) | set(range(3 * 32_768, 5 * 32_768))
        for i in range(n):
            if i not in lost:
                times = generator.choice([1] * 500 + [2, 5])
                rows += [(topic, partition, start + i)] * times
    rows += [("c", 0, 7)] + [("d", 0, 32_768 * 4096 * i + 9) for i in range(4)] * 2
    return rows


def brute(rows):
    arrived = defaultdict(Counter)
    for topic, partition, offset in rows:
        arrived[topic, partition][offset] += 1
    report = []
    for key, counts in arrived.items():
        found = sorted(counts)
        for a, b in zip(found, found[1:], strict=False):
            if b > a + 1:
                report.append(("missing", *key, a + 1, b - 1, 0))
        report += [("repeated", *key, o, o, n) for o, n in counts.items() if n > 1]
    return sorted(report)


def test_offset_report_equals_brute_force(spark):
    rows = offset_rows()
    odd = [(None, 0, 1, "x"), ("a", None, 1, "x"), ("a", 0, None, "x")]
    df = spark.createDataFrame([(*r, "x") for r in rows] + odd, RECORD).repartition(6)
    names = ["kind", "kafka_topic", "kafka_partition", "first_offset", "last_offset", "n_records"]
    found = offsets.offset_report(df).select(names).collect()
    assert sorted(tuple(r) for r in found) == brute(rows)
    for row in offsets.offset_summary(df).collect():
        own = [o for t, p, o in rows if (t, p) == (row.kafka_topic, row.kafka_partition)]
        assert (row.first_offset, row.last_offset) == (min(own), max(own))
        assert (row.n_records, row.n_offsets) == (len(own), len(set(own)))
        assert row.n_missing == max(own) - min(own) + 1 - len(set(own))
        assert row.n_repeated == len(own) - len(set(own))
    assert offsets.offset_report(df.limit(0)).count() == 0


def test_whole_cells_are_not_read_record_by_record(spark):
    """Cells without holes and repeats count by their bitmaps alone."""
    df = spark.range(200_000).select(
        F.lit("t").alias("kafka_topic"), F.lit(0).alias("kafka_partition"), F.col("id").alias("kafka_offset")
    )
    cells = offsets.offset_cells(df)
    assert cells.count() == 7 and cells.where("last - first + 1 > n_offsets").isEmpty()
    assert offsets.missing_offsets(df).isEmpty() and offsets.repeated_offsets(df).isEmpty()


# --- reports of a visit

VISIT = (
    "monitoring_ref string, item_identifier string, recorded_at_time timestamp, kafka_timestamp timestamp, "
    "kafka_topic string, kafka_partition int, kafka_offset bigint, departure_status string"
)
START = datetime(2026, 1, 2, 3, 0, 0)


def visit_rows(seed, n):
    generator = random.Random(seed)
    rows = []
    for i in range(n):
        at = START + timedelta(minutes=generator.randrange(0, 1500))
        ref, item = generator.choice("AB"), f"i{generator.randrange(6)}"
        status = generator.choice(["onTime", "delayed"])
        rows.append((ref, item, at, at + timedelta(seconds=generator.randrange(3)), "t", 0, seed * 1000 + i, status))
    return rows


def expected_reports(rows, gap):
    groups = defaultdict(list)
    for r in rows:
        if None not in r[:3]:
            groups[r[:2]].append(r)
    out = []
    for own in groups.values():
        own.sort(key=lambda r: (r[2], r[3], *r[4:7]))
        visit = [own[0]]
        for row in own[1:] + [None]:
            if row is None or row[2] - visit[-1][2] > gap:
                out.append((visit[-1][6], len(visit), visit[0][2], visit[-1][2] + gap))
                visit = []
            visit.append(row)
    return sorted(out)


def reports(df):
    names = ["kafka_offset", "n_reports", "first_reported", "settled_at"]
    return sorted(tuple(r) for r in df.select(names).collect())


def test_last_report_of_each_visit(spark):
    rows = visit_rows(1, 300)
    # a minute's clock never meets a gap of half minutes exactly
    gap = timedelta(minutes=40, seconds=30)
    odd = [("A", None, START, START, "t", 0, 1, "x"), ("A", "i1", None, START, "t", 0, 2, "x"), (None,) * 8]
    df = spark.createDataFrame(rows + odd, VISIT)
    found = last_reports(df, gap="40 minutes 30 seconds")
    assert reports(found) == expected_reports(rows, gap)
    assert found.columns[:8] == df.columns
    assert reports(last_reports(df.limit(0))) == []


def visits_stream(spark, tmp_path):
    query = start_visit_reports(
        spark.readStream.schema(VISIT).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")),
        str(tmp_path / "out"),
        str(tmp_path / "checkpoint"),
        gap="40 minutes 30 seconds",
        delay="2 hours",
        available_now=True,
    )
    assert wait(query, 180)
    return query.recentProgress


def test_stream_of_reports_restarts_and_equals_the_batch(spark, tmp_path):
    """Files in order of time, read one by one, by two runs of the query."""
    rows = sorted(visit_rows(2, 400), key=lambda r: r[2])
    gap = timedelta(minutes=40, seconds=30)
    parts = [rows[i : i + 80] for i in range(0, 400, 80)]
    # reports a bit out of order, over the border of files
    parts[0][-1], parts[1][0] = parts[1][0], parts[0][-1]
    for number, part in enumerate(parts[:3]):
        spark.createDataFrame(part, VISIT).coalesce(1).write.parquet(str(tmp_path / f"in/part={number}"))
    visits_stream(spark, tmp_path)
    first = reports(spark.read.parquet(str(tmp_path / "out")))
    assert first == [r for r in expected_reports(sum(parts[:3], []), gap) if r in first] and first
    for number, part in enumerate(parts[3:], 3):
        spark.createDataFrame(part, VISIT).coalesce(1).write.parquet(str(tmp_path / f"in/part={number}"))
    progress = visits_stream(spark, tmp_path)
    watermark = max(r[2] for r in rows) - timedelta(hours=2)
    every = expected_reports(rows, gap)
    settled = [r for r in every if r[3] <= watermark]
    assert reports(spark.read.parquet(str(tmp_path / "out"))) == settled
    # only the visits that are open at the watermark are kept
    assert progress[-1].stateOperators[0].numRowsTotal == len(every) - len(settled)


def test_state_of_reports_is_on_disk(spark, tmp_path):
    """Not in the executors' memory; the session's other streams keep theirs as before."""
    before = dict(spark.conf.getAll)
    rows = visit_rows(2, 40)
    spark.createDataFrame(rows, VISIT).coalesce(1).write.parquet(str(tmp_path / "in/part=0"))
    progress = visits_stream(spark, tmp_path)
    assert "rocksdbPutLatency" in progress[0].stateOperators[0].customMetrics
    assert dict(spark.conf.getAll) == before


# --- indicators

DEPARTURES = "roi_label string, line_ref string, direction_ref string, stop_point_name string, expected_departure_time timestamp, recorded_at_time timestamp, departure_status string"


def departure_rows(n):
    generator = random.Random(9)
    rows = []
    for _ in range(n):
        at = START + timedelta(seconds=generator.randrange(0, 30 * 86400))
        line = generator.choice(["1"] * 9 + ["2"])
        rows.append((f"L{line}", line, generator.choice("AR"), generator.choice("xy"), at, at - timedelta(seconds=generator.randrange(900)), generator.choice(["onTime", "delayed", None])))
    rows += [("L1", "1", "A", "x", None, START, None), ("L1", None, "A", "x", START, START, None)]
    return rows


def test_headways_over_days(spark):
    rows = departure_rows(600) + [("L3", "3", "A", "x", START + timedelta(days=d), START, "onTime") for d in (0, 3, 3, 9)]
    df = spark.createDataFrame(rows, DEPARTURES)
    groups = defaultdict(list)
    for r in rows:
        if None not in r[1:5]:
            groups[r[1:4]].append(r[4])
    want = Counter()
    for own in groups.values():
        own.sort()
        want[None] += 1
        want.update(int((b - a).total_seconds()) for a, b in zip(own, own[1:], strict=False))
    want[None] += 2
    found = kpis.headways(df)
    assert found.columns == [*df.columns, "headway_seconds"]
    assert Counter(r.headway_seconds for r in found.collect()) == want


def test_merged_sketches_keep_the_rank_error(spark):
    """Quantiles of merged sketches are as near the exact ranks as those of one sketch."""
    generator = random.Random(3)
    rows = [("L", START + timedelta(seconds=i), int(generator.lognormvariate(6, 1)), "onTime") for i in range(60_000)]
    df = spark.createDataFrame(rows, "roi_label string, expected_departure_time timestamp, v long, departure_status string")
    ranks = [0.05, 0.25, 0.5, 0.75, 0.9, 0.99]
    values = sorted(r[2] for r in rows)
    merged = kpis.merge_kpis(kpis.departure_kpis(df, "v", "5 minutes"), "30 days")
    for table in (merged, kpis.departure_kpis(df, "v", "30 days")):
        row = kpis.with_quantiles(table, ranks).collect()
        assert len(row) == 1 and row[0].n_values == 60_000 and row[0].sum_value == sum(values)
        for rank, value in zip(ranks, row[0].quantiles, strict=True):
            below = sum(v < value for v in values) / len(values)
            up_to = sum(v <= value for v in values) / len(values)
            assert below <= rank + 0.025 and up_to >= rank - 0.025


def test_indicators_without_values(spark):
    df = spark.createDataFrame(departure_rows(0), DEPARTURES).withColumn("v", F.lit(None).cast("bigint"))
    found = kpis.with_quantiles(kpis.departure_kpis(df, "v", "1 hour")).collect()
    assert [(r.n_departures, r.n_values, r.quantiles) for r in found] == [(1, 0, None)]


def test_late_departures_count_until_their_window_closes(spark, tmp_path):
    def add(number, minutes):
        rows = [("L", "1", "A", "x", START + timedelta(minutes=m), START, "onTime") for m in minutes]
        spark.createDataFrame(rows, DEPARTURES).coalesce(1).write.parquet(str(tmp_path / f"in/part={number}"))
        query = start_departure_kpis(
            spark.readStream.schema(DEPARTURES).parquet(str(tmp_path / "in")),
            str(tmp_path / "out"),
            str(tmp_path / "checkpoint"),
            window="1 hour",
            delay="30 minutes",
            available_now=True,
        )
        assert wait(query, 180)
        rows = spark.read.parquet(str(tmp_path / "out")).select("period.start", "n_departures", "min_value").collect()
        return sorted((int((r.start - START).total_seconds()) // 3600, r.n_departures, r.min_value) for r in rows)

    assert add(0, [0, 10, 70]) == []
    # 50 is late, but the first hour is open until 90 has been seen
    assert add(1, [50, 80]) == []
    assert add(2, [95]) == [(0, 3, 0)]
    # 20 is dropped; 100 counts in the second hour
    assert add(3, [20, 100, 200]) == [(0, 3, 0), (1, 4, 4200)]


@pytest.mark.parametrize("query", [operations.offset_totals, operations.daily_kpis, operations.visit_reports])
def test_plans_have_no_python(spark, sf_dir, query):
    plan = query(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "MapInArrow" not in plan
