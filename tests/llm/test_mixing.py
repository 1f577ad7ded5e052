"""Targets and samples against a plain version and the SQL."""

import math
from collections import defaultdict

import pytest
from compare import difference, duckdb_rows, spark_rows

from quayflow.llm import mixing
from quayflow.llm.blocks import read_documents

SCHEMA = "doc_id long, text string, source string, key string, target int, size string"
LABELS = "doc_id long, quality int, toxic int"


def fair(sizes):
    """Water-filling by repeated sharing; sizes by source in code point order, None last."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in full)
        free = [s for s in names if s not in full]
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = {s for s in free if share[s] >= 3 * sizes[s]}
        if not over:
            return {s: 3 * sizes[s] if s in full else share[s] for s in names}
        full |= over
        if full == set(names):
            return {s: 3 * sizes[s] for s in names}


ROWS = (
    [(i, "w " * (1 + i % 7), "b") for i in range(300)]
    + [(1000 + i, "a b c", "a") for i in range(5)]
    + [(2000 + i, "x\x0by", None) for i in range(20)]
    + [(3000, None, "c"), (3001, "", "c"), (3002, " \t", "É")]
    + [(4000, "long " * 20_000, "d"), (4001, "one", "d"), (4001, "one", "d"), (None, "p q", "d")]
)


def frames(spark, rows=ROWS):
    docs = spark.createDataFrame([(i, t, s, "k", 1, "z") for i, t, s in rows], SCHEMA)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(0, 250)] + [(3, 0, 0)], LABELS)
    return docs, labels


def test_targets_and_sample(spark):
    docs, labels = frames(spark)
    rows = mixing.mix(docs, labels).collect()
    assert len(rows) == len(ROWS)
    sizes = defaultdict(int)
    for _, text, source in ROWS:
        sizes[source] += len((text or "").split())
    want = fair(sizes)
    source_of = {i: s for i, _, s in ROWS}
    taken, largest = defaultdict(int), defaultdict(int)
    for row in rows:
        source = source_of[row.doc_id]
        assert row.source_size == sizes[source]
        assert row.target == pytest.approx(want[source])
        assert row.taken == row.copies * row.size <= 3 * row.size
        taken[source] += row.taken
        largest[source] = max(largest[source], row.size)
    for source in sizes:
        assert abs(taken[source] - want[source]) <= largest[source] / 2
    again = mixing.mix(docs.repartition(7), labels.repartition(3)).collect()
    assert sorted(rows, key=str) == sorted(again, key=str)


def test_many_sources(spark):
    rows = [(i, "w " * (1 + (i * i) % 50), f"s{i % 40}") for i in range(400)]
    rows = [(i, t * (30 if s == "s7" else 1), s) for i, t, s in rows]
    docs, labels = frames(spark, rows)
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(text.split())
    want = fair(sizes)
    sums = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    for row in mixing.targets(sums).collect():
        assert row.target == pytest.approx(want[row.source])
    assert math.isclose(sum(want.values()), sum(sizes.values()))


def test_good_documents_come_first(spark):
    """Of two thousand equal documents, those of higher weight are taken more often."""
    rows = [(i, "a b", "s1" if i % 4 else "s0") for i in range(2000)]
    docs = spark.createDataFrame([(i, t, s, "k", 1, "z") for i, t, s in rows], SCHEMA)
    labels = spark.createDataFrame([(i, int(i % 3 == 0), 0) for i in range(2000)], LABELS)
    mixed = mixing.mix(docs, labels).collect()
    share = lambda good: [r.copies for r in mixed if (r.doc_id % 3 == 0) is good and r.doc_id % 4]
    assert sum(share(True)) / len(share(True)) > sum(share(False)) / len(share(False)) + 0.3


def test_mix_equals_sql(spark, sf_dir):
    ours = mixing.mix(read_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    assert difference(spark_rows(ours), duckdb_rows(mixing.MIX_SQL, sf_dir)) is None


def test_no_rows(spark):
    docs, labels = frames(spark)
    assert mixing.mix(docs.limit(0), labels).count() == 0
    blank = docs.filter("source = 'c'")
    assert {(r.target, r.taken) for r in mixing.mix(blank, labels).collect()} == {(0.0, 0)}


def test_rows_without_ids_have_keys_of_their_own(spark):
    """They spread over the ranges of keys, so no window holds them all."""
    rows = [(None, f"text {i} words", "s") for i in range(300)]
    docs, labels = frames(spark, rows)
    keys = {r.key for r in mixing.keyed(docs.select("doc_id", "text", "source"), labels).collect()}
    assert len(keys) == 300
