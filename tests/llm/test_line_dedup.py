"""Dropped lines against brute force, also for keys cut over many ranges."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quayflow.llm import line_dedup

SCHEMA = "doc_id long, text string, lines string, block string, keep int, kind int"
BLANKS = " \t\n\x0b\x0c\r"
LONG = "this line stands in very many documents é"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    split = [(i, (t or "").split("\n")) for i, t in rows]
    holders = defaultdict(set)
    keys = [[line.strip(BLANKS).translate(LOWER) for line in lines] for _, lines in split]
    for (i, _), own in zip(split, keys, strict=True):
        for key in own:
            if len(key) >= 40:
                holders[key].add(i)
    rank = lambda i: (i is not None, i or 0)
    largest = {k: max(ids, key=rank) for k, ids in holders.items() if len(ids) >= 5}
    out = []
    for (i, lines), own in zip(split, keys, strict=True):
        kept = [x for x, k in zip(lines, own, strict=True) if k not in largest or largest[k] == i]
        digest = hashlib.sha256("\n".join(kept).encode()).hexdigest()
        out.append((i, len(lines), len(lines) - len(kept), digest))
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y", 1, 2) for i, t in rows], SCHEMA)


def got(df):
    return sorted((tuple(r) for r in line_dedup.line_digest(df).collect()), key=str)


def odd_rows():
    generator = random.Random(5)
    pool = [f"{LONG} number {n}" for n in range(12)] + ["short", "", "  ", "x" * 39, "É" * 40, "é" * 40]
    rows = []
    for i in range(120):
        lines = [generator.choice(pool) for _ in range(generator.randrange(0, 12))]
        lines = [generator.choice(["", " ", "\t\r", "\x0b"]) + x.upper() * (generator.random() < 0.2) + x * 1 for x in lines]
        rows.append((i, "\n".join(lines)))
    rows += [(i, f"{LONG}\n{LONG}\n{i}\n  {LONG}") for i in range(200, 260)]
    rows += [(300, None), (301, ""), (302, "\n"), (303, "\n\n" + LONG + "\n"), (303, LONG), (303, LONG)]
    rows += [(None, LONG), (None, f"{LONG}\nno id"), (-5, LONG), (400, "z" * 100_000 + "\n" + LONG)]
    rows += [(500 + i, "four documents hold this line, which is not enough") for i in range(4)]
    rows += [(504, "FOUR documents hold this line, which is not enough" * 2)]
    return rows


@pytest.mark.parametrize("partitions", [1, 7])
def test_digest_equals_brute_force(spark, partitions):
    rows = odd_rows()
    df = frame(spark, rows).repartition(partitions)
    assert got(df) == brute(rows)
    assert got(df.limit(0)) == []


@pytest.mark.parametrize("range_rows", [1, 5, 40, 1000])
def test_hot_key_over_many_ranges(spark, range_rows):
    """One key in most documents, rows without id among them, is cut into many ranges."""
    rows = [(i % 300 if i % 50 else None, f"{LONG}\nown line of document number {i} that is quite long") for i in range(700)]
    rows += [(i, f"the second very common line of all of these texts\n{i}") for i in range(40)]
    df = frame(spark, rows)
    marked = line_dedup.line_bitmaps(df, range_rows=range_rows)
    seen = marked.select("doc_id", "lines.n_lines", "lines.n_dropped").collect()
    assert sorted((tuple(r) for r in seen), key=str) == [r[:3] for r in brute(rows)]


@pytest.mark.parametrize("batch", [1, 2, 3, 7, 100])
def test_stream_over_batches(batch):
    """Batches may cut runs and documents anywhere; partitions may begin within a run."""
    generator = np.random.default_rng(batch)
    for _ in range(40):
        high = np.sort(generator.integers(0, 4, 60))
        doc = generator.integers(0, 8, 60)
        order = np.lexsort((-doc, high))
        high, doc = high[order], doc[order]
        line = np.arange(60, dtype=np.int32)
        cut = sorted(generator.integers(0, 61, 2).tolist())
        found = []
        for a, b in zip([0, *cut], [*cut, 60], strict=True):
            table = pa.table(
                {
                    "high": high[a:b],
                    "low": np.zeros(b - a, np.int64),
                    "doc_id": pa.array(doc[a:b], mask=doc[a:b] == 0),
                    "block": np.zeros(b - a, np.int64),
                    "line": line[a:b],
                }
            )
            for out in line_dedup._Stream(3).run(iter(table.to_batches(max_chunksize=batch))):
                found += out.to_pylist()
        tops = defaultdict(set)
        for r in found:
            if r["kind"] == line_dedup.BORDER:
                tops[r["high"]].add(r["doc_id"])
        gone = {r["line"] for r in found if r["kind"] == line_dedup.DROP}
        for r in found:
            if r["kind"] == line_dedup.OPEN and len(tops[r["high"]]) >= 3:
                largest = max(tops[r["high"]], key=lambda d: d or 0)
                if r["doc_id"] != largest:
                    gone.add(r["line"])
        want = set()
        for k in range(4):
            docs = set(doc[high == k].tolist())
            if len(docs) >= 3:
                want |= set(line[(high == k) & (doc != max(docs))].tolist())
        assert gone == want


def test_other_columns_stay_and_bitmaps_apply(spark):
    rows = odd_rows()
    df = frame(spark, rows)
    marked = line_dedup.line_bitmaps(df)
    assert marked.columns == ["doc_id", "text", "block", "keep", "kind", "lines"]
    out = line_dedup.without_lines(marked)
    assert out.columns == ["doc_id", "text", "block", "keep", "kind"]
    seen = out.withColumn("digest", F.sha2(F.coalesce("text", F.lit("")), 256)).collect()
    assert sorted(((r.doc_id, r.digest) for r in seen), key=str) == sorted(((r[0], r[3]) for r in brute(rows)), key=str)
    assert {(r.block, r.keep, r.kind) for r in seen} == {("y", 1, 2)}


def test_layout_with_few_buckets_allowed(spark):
    """Beyond Spark's largest number of buckets a bucket holds more blocks."""
    rows = odd_rows()
    key = "spark.sql.sources.bucketing.maxBuckets"
    before = spark.conf.get(key)
    spark.conf.set(key, "3")
    try:
        assert got(frame(spark, rows).repartition(5)) == brute(rows)
    finally:
        spark.conf.set(key, before)


def test_text_of_25_megabytes(spark):
    rows = [(i, "\n".join(f"line number {n} of a very long text of lines" for n in range(600_000))) for i in range(2)]
    rows += [(10 + i, "line number 7 of a very long text of lines") for i in range(4)]
    assert got(frame(spark, rows)) == brute(rows)
