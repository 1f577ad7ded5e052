"""Fingerprints of documents and their edits."""

import hashlib
import random

import numpy as np
import pytest
import xxhash

from quayflow.llm import parsing
from quayflow.llm.blocks import read_documents

SCHEMA = "doc_id long, text string, fingerprint int, part string"


def plain(rows):
    """Edited texts in id order without Spark."""
    signed = lambda t: (xxhash.xxh64_intdigest(t) + 2**63) % 2**64 - 2**63
    ordered = sorted(((i is not None, i or 0, signed(t or ""), t or "") for i, t in rows))
    text = [t for *_, t in ordered]
    out = []
    for k, (has, i, _, t) in enumerate(ordered):
        n = len(t) // 4
        following = text[(k + 1) % len(text)]
        edited = t[: len(t) - n] + following[:n]
        a, b, c = parsing.sketches([t, edited, following])
        out.append(
            (
                i if has else None,
                len(t),
                hashlib.sha256(edited.encode()).hexdigest(),
                a.astype(">u2").tobytes().hex(),
                b.astype(">u2").tobytes().hex(),
                float(parsing.likeness(a[None], b[None])[0]),
                float(parsing.likeness(a[None], c[None])[0]),
            )
        )
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in parsing.fingerprints(df).collect()), key=str)


ROWS = [
    (5, "Straße über 中文字 😀😀😀😀 end"),
    (1, None),
    (2, ""),
    (9, "x" * 60_000),
    (-3, "word " * 20_000),
    (7, "twice"),
    (7, "twice"),
    (7, "other text of the same id"),
    (100, "ab" * 500),
]


@pytest.mark.parametrize("rows", [ROWS, [*ROWS, (None, "no id"), (None, "aa")], ROWS[:1], [(None, "z")]])
def test_rows_equal_plain_version(spark, rows):
    df = spark.createDataFrame([(i, t, 0, "") for i, t in rows], SCHEMA).repartition(3)
    assert got(df) == plain(rows)


@pytest.mark.parametrize("range_bytes", [100, 1000, 20_000])
def test_rows_without_ids_fill_several_ranges(spark, monkeypatch, range_bytes):
    """Rows of no id, some alike, and of one id are cut into ranges as any others."""
    monkeypatch.setattr(parsing, "LEAST_RANGES", 1)
    rows = [(None, f"text number {i % 70} without an id") for i in range(200)]
    rows += [(4, f"text {i} of one id") for i in range(100)] + [(i, "x") for i in range(3)]
    df = spark.createDataFrame([(i, t, 0, "") for i, t in rows], SCHEMA).repartition(3)
    assert got(df) == plain(rows)


def test_whole_table_and_no_rows(spark, sf_dir):
    docs = read_documents(spark, sf_dir)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    result = got(docs)
    assert result == plain(rows)
    assert np.mean([r[5] for r in result]) > np.mean([r[6] for r in result]) + 0.2
    assert got(docs.limit(0)) == []


def test_equal_substrings_share_names_wherever_they_lie():
    generator = random.Random(1)
    letters = "abcdefghij é"
    middle = "".join(generator.choice(letters) for _ in range(3000))
    names = []
    for _ in range(5):
        around = ["".join(generator.choice(letters) for _ in range(generator.randrange(1, 400))) for _ in "ab"]
        text = around[0] + middle + around[1]
        symbols = parsing.mix(np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64))
        starts = np.array([0])
        for _ in range(2):
            symbols, starts = parsing.next_level(symbols, starts)
        names.append(set(symbols.tolist()))
    common = set.intersection(*names)
    assert len(common) > 3000 / 30


def test_phrases_have_bounded_length_and_documents_do_not_mix():
    generator = np.random.default_rng(0)
    symbols = parsing.mix(generator.integers(0, 4, 50_000).astype(np.uint64))
    starts = np.array([0, 1, 2, 5000])
    names, at = parsing.next_level(symbols.copy(), starts)
    assert len(symbols) / 20 < len(names) < len(symbols) / 2
    for k in range(4):
        ends = [*starts[1:], len(symbols)]
        alone, _ = parsing.next_level(symbols[starts[k] : ends[k]].copy(), np.array([0]))
        assert (names[at[k] :][: len(alone)] == alone).all()
