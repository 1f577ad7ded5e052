"""Fingerprints and groups against brute force."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from quayflow.llm import components as components_module
from quayflow.llm import simhash
from quayflow.llm.blocks import read_documents
from quayflow.llm.components import components

SCHEMA = "doc_id long, text string, fingerprint int, component string"


def fingerprint(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def smallest(nodes, linked):
    """Component names by plain search; nodes are (value, id) rows."""
    name = {}
    for start in nodes:
        if start in name:
            continue
        seen, queue = {start}, [start]
        while queue:
            at = queue.pop()
            for other in nodes:
                if other not in seen and linked(at, other):
                    seen.add(other)
                    queue.append(other)
        for node in seen:
            name[node] = seen
    return name


def expected(rows):
    prints = [fingerprint(t) for _, t in rows]
    groups = smallest(set(prints), lambda a, b: (a ^ b).bit_count() <= 3)
    out = []
    for (doc_id, _), own in zip(rows, prints, strict=True):
        ids = [i for (i, _), p in zip(rows, prints, strict=True) if p in groups[own] and i is not None]
        out.append((doc_id, f"{own:016x}", min(ids, default=None)))
    return sorted(out, key=str)


def got(df, **options):
    rows = simhash.near_duplicates(df, **options).collect()
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in rows), key=str)


def edited(base, seed):
    generator = random.Random(seed)
    words = base.split()
    words[generator.randrange(len(words))] = "other"
    return " ".join(words)


BASE = " ".join(f"word{i * i % 997}" for i in range(300))
ROWS = [
    (1, None),
    (2, ""),
    (3, " \t\x0b"),
    (None, "alone here now"),
    (5, "One two"),
    (6, "one\n two"),
    (7, "one two three"),
    (7, "one two three"),
    (8, "É Straße\x85x y"),
    (9, "x" * 50_000),
] + [(100 + i, edited(BASE, i)) for i in range(60)]


@pytest.mark.parametrize("group", [simhash.GROUP, 8])
def test_groups_equal_brute_force(spark, group):
    df = spark.createDataFrame([(i, t, 0, "") for i, t in ROWS], SCHEMA)
    assert got(df, group=group) == expected(ROWS)
    assert got(df.limit(0)) == []


def test_whole_table(spark, sf_dir):
    docs = read_documents(spark, sf_dir)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert got(docs) == expected(rows)


def test_long_document_in_chunks(monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK", 7)
    values = ["a b c d e f g h i j k l m n", "", "q", BASE]
    prints = simhash.fingerprints(pa.array(values))
    assert prints.tolist() == [fingerprint(v) for v in values]


@pytest.mark.parametrize("group", [simhash.GROUP, 40])
def test_dense_fingerprints(spark, group):
    """Many fingerprints around one: chains of small steps, beyond a group's size."""
    generator = np.random.default_rng(3)
    center = int(generator.integers(1 << 62))
    values = {center}
    for _ in range(400):
        value = center
        for bit in generator.integers(0, 64, generator.integers(1, 9)):
            value ^= 1 << int(bit)
        values.add(value)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "fingerprint long")
    named = {r.node: r.component for r in components(simhash.similar_links(df, group)).collect()}
    groups = smallest(values, lambda a, b: (a ^ b).bit_count() <= 3)
    back = dict(zip(values, signed, strict=True))
    for value in values:
        ours = named.get(back[value], back[value])
        assert ours == min(back[v] for v in groups[value])


@pytest.mark.parametrize("size", [1, 5, 10, 20])
def test_groups_that_start_at_a_batch_border(size):
    """Each run has whole groups, or rows of one group that are all marked as cut."""
    keys = np.repeat([1, 2, 3, 4], [5, 40, 5, 30])
    table = pa.table({"key": keys, "fingerprint": np.arange(len(keys))})
    runs = list(simhash._runs(table.to_batches(max_chunksize=size), 12))
    assert np.concatenate([k for k, _, _ in runs]).tolist() == keys.tolist()
    for key in (2, 4):
        assert all(cut and set(k.tolist()) == {key} for k, _, cut in runs if key in k)
    for key in (1, 3):
        assert sum(key in k for k, _, _ in runs) == 1
        assert not any(cut for k, _, cut in runs if key in k)


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(0, 40)] + [(1000, i) for i in range(900, 960)] + [(5, 5)]
    found = components(spark.createDataFrame([*chain, (None, 3)], "a long, b long")).collect()
    assert {(r.node, r.component) for r in found} == {(i, 0) for i in range(41)} | {
        (i, 900) for i in [*range(900, 960), 1000]
    }
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    rounds = []
    kept = components_module.stored
    monkeypatch.setattr(components_module, "stored", lambda df, name: (rounds.append(name), kept(df, name))[1])
    links = spark.range(9_999).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    found = components(links)
    assert found.count() == 10_000 and found.filter("component <> 0").isEmpty()
    assert rounds.count("parents") <= 12


def test_one_of_each_keeps_columns(spark):
    df = spark.createDataFrame([(i, t, 0, "") for i, t in ROWS], SCHEMA)
    kept = simhash.one_of_each(df)
    assert kept.columns == df.columns
    ids = sorted(str(r.doc_id) for r in kept.collect())
    assert ids == sorted({str(c) for _, _, c in expected(ROWS)})
