"""As-of lines, keyword tables and hot lines against plain Python."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quayflow.operators import keywords as keywords_module
from quayflow.operators.hot_lines import hot_lines, join_hot_lines, seen_lines, shares_of, widths
from quayflow.operators.keywords import match_keywords
from quayflow.operators.lines import join_lines
from quayflow.operators.validity import join_lines_as_of, with_validity
from quayflow.streaming.control import wait
from quayflow.streaming.curated_stream import HotLines, start_curated_stream
from quayflow.sources.tables import raw_stream
from test_events import event, visit
from test_lines import LINES

START = datetime(2026, 1, 1)
CHANGES = "siri_line_ref string, valid_from timestamp, roi_label string, name string, short_name string, transport_mode string"
VISITS = "line_ref string, recorded_at_time timestamp, item_identifier string"


def day(n):
    return None if n is None else START + timedelta(days=n)


def test_as_of_join_equals_a_search(spark):
    generator = random.Random(1)
    changes = [("A", None, "a0"), ("A", day(10), "a1"), ("A", day(200), "a2"), ("B", day(-3), "b0"), ("B", day(40), None), ("C", day(900), "c0"), ("A", day(10), "a0x")]
    rows = [(ref, at, label, f"name {label}", "s", "m") for ref, at, label in changes]
    lines = with_validity(spark.createDataFrame(rows, CHANGES))
    times = [None, -400, -3, 0, 9.99999, 10, 39, 40, 199, 200, 800] + [generator.uniform(-100, 500) for _ in range(60)]
    visits = [(ref, day(t), f"{ref}{i}") for i, t in enumerate(times) for ref in ("A", "B", "C", "D", None)]
    history = {"A": [(None, "a0"), (day(10), "a1"), (day(200), "a2")], "B": [(day(-3), "b0"), (day(40), None)], "C": [(day(900), "c0")]}

    def label(ref, at):
        valid = [x for start, x in history.get(ref, []) if at is not None and (start is None or start <= at)]
        return valid[-1] if valid else None

    df = spark.createDataFrame(visits, VISITS)
    for bin_days in (1, 30, 1000):
        joined = join_lines_as_of(df, lines, bin_days=bin_days)
        assert joined.columns == [*df.columns, "roi_label", "name", "short_name", "transport_mode"]
        got = {r.item_identifier: r.roi_label for r in joined.collect()}
        assert got == {item: label(ref, at) for ref, at, item in visits}
        assert joined.count() == len(visits)
    assert join_lines_as_of(df.limit(0), lines).count() == 0
    assert join_lines_as_of(df, lines.limit(0)).where("roi_label IS NOT NULL").count() == 0


def test_as_of_join_is_an_equality_join(spark):
    lines = with_validity(spark.createDataFrame([("A", None, "a", "n", "s", "m")], CHANGES))
    df = spark.createDataFrame([("A", START, "x")], VISITS)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = join_lines_as_of(df, lines)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def broadcasts(df):
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().partition("== Initial Plan ==")[0]
    return [line for line in final.splitlines() if "BroadcastExchange" in line]


def test_as_of_join_does_not_repeat_short_histories(spark):
    """A line that never changes was repeated for each month of the visits' times."""
    ids = spark.range(200)
    lines = with_validity(ids.selectExpr("concat('L', id) siri_line_ref", "CAST(NULL AS TIMESTAMP) valid_from", "'a' roi_label", "'n' name", "'s' short_name", "'m' transport_mode"))
    visits = ids.selectExpr("concat('L', id) line_ref", "timestamp_seconds(id * 2000000) recorded_at_time", "string(id) item_identifier")
    joined = join_lines_as_of(visits, lines)
    assert joined.where("roi_label = 'a'").count() == 200
    assert "explode(sequence" not in joined._jdf.queryExecution().optimizedPlan().toString()


def test_as_of_join_of_a_long_history(spark):
    rows = [("A", day(n), f"a{n}", "n", "s", "m") for n in range(0, 400, 2)]
    rows += [(f"B{n}", None, "b", "n", "s", "m") for n in range(300)]
    lines = with_validity(spark.createDataFrame(rows, CHANGES))
    refs = ["A", "B7", "C", None]
    visits = [(ref, day(t), f"{ref}{t}") for ref in refs for t in (-50, -0.5, 0, 1.5, 2, 61, 399.5, 4000, None)]
    for bin_days in (1, 30, 1000):
        joined = join_lines_as_of(spark.createDataFrame(visits, VISITS), lines, bin_days=bin_days)
        assert broadcasts(joined) == []
        got = {r.item_identifier: r.roi_label for r in joined.collect()}

        def label(ref, t):
            if t is None or ref not in ("A", "B7") or (ref == "A" and t < 0):
                return None
            return "b" if ref == "B7" else f"a{min(398, int(t) // 2 * 2)}"

        assert got == {f"{ref}{t}": label(ref, t) for ref in refs for t in (-50, -0.5, 0, 1.5, 2, 61, 399.5, 4000, None)}


NAMES = "stop int, name_norm string"


def test_names_grams_are_never_broadcast(spark, monkeypatch):
    """The grams of short names were taken for a small table and sent to the driver."""
    names = spark.range(50).selectExpr("int(id) stop", "concat('place n', id, ' street') name_norm")
    keywords = spark.range(500).selectExpr("concat('n', id, ' s') keyword")
    keywords = keywords.union(keywords)
    want = Counter((i, f"n{i} s") for i in range(50) for _ in range(2))
    for most, n in ((keywords_module.BROADCAST_BYTES, 1), (0, 0)):
        monkeypatch.setattr(keywords_module, "BROADCAST_BYTES", most)
        found = match_keywords(names, keywords)
        exchanges = broadcasts(found)
        assert len(exchanges) == n
        assert not any("stop" in line for line in exchanges)
        assert Counter((r.stop, r.keyword) for r in found.collect()) == want


def test_keywords_equal_contains(spark):
    generator = random.Random(2)
    letters = "abcé 🚋"
    names = [(i, "".join(generator.choice(letters) for _ in range(generator.randrange(0, 25)))) for i in range(200)]
    names += [(900, None), (901, ""), (902, "gare de lyon"), (902, "gare de lyon")]
    words = ["", None, "gare", "gare de lyon", "e l", "x", "🚋", "é a"]
    words += ["".join(generator.choice(letters) for _ in range(generator.randrange(1, 9))) for _ in range(300)]
    pairs = [(w, f"station {i}") for i, w in enumerate(words + ["gare"])]
    found = match_keywords(spark.createDataFrame(names, NAMES), spark.createDataFrame(pairs, "keyword string, station string"))
    assert found.columns == ["stop", "name_norm", "keyword", "station"]
    want = Counter((s, n, w, x) for s, n in names for w, x in pairs if w and n is not None and w in n)
    assert Counter(map(tuple, found.collect())) == want
    alone = match_keywords(spark.createDataFrame(names, NAMES), spark.createDataFrame([(w,) for w, _ in pairs], "keyword string"))
    assert Counter(map(tuple, alone.collect())) == Counter((s, n, w) for s, n, w, _ in want.elements())
    none = spark.createDataFrame([("",)], "keyword string")
    assert match_keywords(spark.createDataFrame(names, NAMES), none).count() == 0


def test_a_hundred_thousand_keywords(spark):
    """The index equals ``contains``; few candidates are compared whole."""
    keywords = spark.range(100_000).select(F.concat(F.lit("place n"), F.col("id"), F.lit(" st")).alias("keyword"))
    names = spark.range(3000).select(
        F.col("id").cast("int").alias("stop"),
        F.concat(F.lit("this is place n"), F.col("id") * 61, F.lit(" street of the town")).alias("name_norm"),
    )
    found = match_keywords(names, keywords)
    got = {(r.stop, r.keyword) for r in found.collect()}
    assert got == {(i, f"place n{i * 61} st") for i in range(3000) if i * 61 < 100_000}


RECORDS = "kafka_topic string, kafka_partition int, kafka_offset bigint, line_ref string"


def test_one_line_with_nine_tenths_is_spread(spark):
    lines = spark.createDataFrame([(f"L{i}", f"r{i}", "n", "s", "m") for i in range(50)], LINES)
    rows = [("t", i % 3, i, "L1" if i % 10 else f"L{i % 47}") for i in range(5000)]
    rows += [("t", 0, 9000 + i, None) for i in range(20)]
    df = spark.createDataFrame(rows, RECORDS)
    found = {r.line_ref: r.share for r in hot_lines(df).collect()}
    assert set(found) == {"L1"} and found["L1"] == pytest.approx(0.9, abs=0.01)
    width = widths(found, 8)
    assert width == {"L1": 7}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = join_hot_lines(df, lines, width)
        sizes = [r["count"] for r in joined.where("line_ref = 'L1'").groupBy(F.spark_partition_id()).count().collect()]
        got = Counter(map(tuple, joined.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert got == Counter(map(tuple, join_lines(df, lines).collect()))
    assert len(sizes) >= 3 and max(sizes) < 4500 * 0.6
    assert Counter(map(tuple, join_hot_lines(df, lines, {}).collect())) == got
    assert hot_lines(df.limit(0)).count() == 0


def test_stream_learns_hot_lines_and_restarts(spark, tmp_path):
    lines = spark.createDataFrame([("STIF:Line::C1:", "RER A", "A", "A", "rail"), ("STIF:Line::C2:", "B", "B", "B", "rail")], LINES)
    hot = HotLines()

    def add(number, n_hot):
        documents = [event([{"MonitoredStopVisit": [visit(f"{number}-{i}", LineRef={"value": "STIF:Line::C1:" if i < n_hot else f"STIF:Line::C{2 + i}:"})]}]) for i in range(10)]
        rows = [("k", text, "t", 0, 100 * number + i, START, START, START.date()) for i, text in enumerate(documents)]
        from quayflow.schemas import RAW

        spark.createDataFrame(rows, RAW).coalesce(1).write.mode("append").partitionBy("ingest_date").parquet(str(tmp_path / "raw"))
        query = start_curated_stream(
            raw_stream(spark, str(tmp_path / "raw")), lines, str(tmp_path / "out"), str(tmp_path / "checkpoint"),
            hot=hot, tasks=8, available_now=True,
        )
        assert wait(query, 120)
        return spark.read.parquet(str(tmp_path / "out")).count()

    assert add(0, 9) == 9
    # each line of the batch is hot at a share of 5 %
    assert hot.shares["STIF:Line::C1:"] == pytest.approx(0.9)
    assert add(1, 9) == 18
    assert add(2, 0) == 18 + 1
    assert hot.shares["STIF:Line::C1:"] == pytest.approx(0.45)


def test_lines_are_counted_while_visits_are_read(spark):
    rows = [("t", i % 3, i, "L1" if i % 10 else f"L{i % 47}") for i in range(5000)]
    rows += [("t", 0, 9000 + i, None) for i in range(2000)]
    df = spark.createDataFrame(rows, RECORDS)
    counted, seen = seen_lines(df, 0.3)
    assert Counter(map(tuple, counted.collect())) == Counter(map(tuple, df.collect()))
    assert shares_of(seen, 0.3) == {r.line_ref: pytest.approx(r.share) for r in hot_lines(df, 0.3).collect()}
    for nothing in (df.limit(0), df.where("line_ref IS NULL")):
        counted, seen = seen_lines(nothing)
        counted.collect()
        assert not shares_of(seen)


def test_stream_keeps_no_visits(spark, tmp_path, monkeypatch):
    """Batches are parsed once, into the write; only the lines and their marks are kept."""
    from quayflow.schemas import RAW

    lines = spark.createDataFrame([(f"STIF:Line::C{i}:", "A" if i else None, "A", "A", "rail") for i in range(9)], LINES)
    kept, persist = [], type(lines).persist
    monkeypatch.setattr(type(lines), "persist", lambda df, *a: kept.append(df.columns) or persist(df, *a))
    documents = [event([{"MonitoredStopVisit": [visit(f"{i}-{j}", LineRef={"value": f"STIF:Line::C{i % 10}:"}) for j in range(2)]}]) for i in range(40)]
    rows = [("k", text, "t", 0, i, START, START, START.date()) for i, text in enumerate([*documents, "#", None])]
    for part in (rows[::2], rows[1::2], [("k", None, "t", 0, 99, START, START, START.date())]):
        spark.createDataFrame(part, RAW).coalesce(1).write.mode("append").partitionBy("ingest_date").parquet(str(tmp_path / "raw"))
    hot = HotLines(0.01)
    query = start_curated_stream(
        raw_stream(spark, str(tmp_path / "raw"), 1), lines, str(tmp_path / "out"), str(tmp_path / "checkpoint"),
        hot=hot, tasks=8, available_now=True,
    )
    assert wait(query, 180)
    found = Counter(r.line_ref for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert found == {f"STIF:Line::C{i}:": 8 for i in range(1, 9)}
    assert hot.shares and kept == [lines.columns, ["mark_word", "mark_bits"]]
