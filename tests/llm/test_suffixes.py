"""Suffix arrays and removed passages against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from quayflow.llm import suffixes
from quayflow.llm.blocks import read_documents

SCHEMA = "doc_id long, text string, repeats int, block string"


def brute(rows, length=400):
    data = [(t or "").encode() for _, t in rows]
    windows = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for (doc_id, _), d in zip(rows, data, strict=True):
        gone = np.zeros(len(d) + 1, bool)
        for i in range(len(d) - length + 1):
            if windows[d[i : i + length]] > 1:
                gone[i : i + length] = True
        spans = int((gone[1:] < gone[:-1]).sum())
        kept = bytes(b for b, g in zip(d, gone, strict=False) if not g)
        out.append((doc_id, len(d), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r)[:5] for r in suffixes.repeat_digest(df).collect()), key=str)


def prose(seed, n):
    generator = random.Random(seed)
    return " ".join("".join(generator.choice("abcdeé") for _ in range(generator.randrange(1, 9))) for _ in range(n))


PASSAGE = prose(7, 90)
ROWS = [
    (1, prose(1, 200) + PASSAGE + prose(2, 100)),
    (2, PASSAGE),
    (3, prose(3, 50) + PASSAGE[10:] + prose(4, 50) + PASSAGE[:450]),
    (4, prose(5, 300)),
    (5, prose(5, 300)),
    (None, prose(5, 299)),
    (6, "ab" * 1500),
    (7, "x" * 401),
    (7, "y" * 400),
    (8, None),
    (9, ""),
    (10, "short"),
    (11, "\x00\x01" + PASSAGE[:399]),
    (12, "z" * 700 + prose(8, 4000)),
    (13, prose(8, 4000)),
    (14, "é" * 199 + "abc" + "é" * 199),
    (15, "é" * 199 + "abc" + "é" * 199 + "d"),
]


@pytest.mark.parametrize("partitions", [1, 4])
def test_removed_bytes_equal_brute_force(spark, partitions):
    df = spark.createDataFrame([(i, t, 0, "") for i, t in ROWS], SCHEMA).repartition(partitions)
    assert got(df) == brute(ROWS)
    assert got(df.limit(0)) == []


def test_frequent_anchors_are_divided(spark):
    rows = [(i, prose(100 + i % 9, 40) + PASSAGE[:380] + prose(200 + i % 7, 40)) for i in range(40)]
    df = spark.createDataFrame([(i, t, 0, "") for i, t in rows], SCHEMA)
    found = suffixes.remove_repeats(df, often=5).select("doc_id", "repeats.n_removed").collect()
    assert sorted(tuple(r) for r in found) == sorted((r[0], r[2]) for r in brute(rows))


def test_common_passage_in_many_surroundings(spark):
    """No bucket gets the surroundings of a passage that each document has elsewhere."""
    rows = [(i, prose(1000 + i, 60) + PASSAGE[:380] + prose(2000 + i, 60)) for i in range(300)]
    rows += [(1000 + i, prose(1, 40) + PASSAGE[:390] + prose(2, 40)) for i in range(2)]
    data = np.frombuffer("".join(t for _, t in rows).encode(), np.uint8)
    ends = np.cumsum([len(t.encode()) for _, t in rows])
    runs = suffixes.anchor_runs(data, ends)
    windows, wide, narrow = suffixes.window_hashes(data, runs[2], runs[3])
    rows_of = suffixes._window_rows(wide, narrow, windows, np.full(len(windows), 400), 16)
    loads = [len(suffixes.unpack(message)[0]) for _, message in rows_of]
    assert len(loads) == 16 and max(loads) < 1.2 * np.mean(loads)
    df = spark.createDataFrame([(i, t, 0, "") for i, t in rows], SCHEMA)
    seen = suffixes.remove_repeats(df, often=5).select("doc_id", "repeats.n_removed", "repeats.n_spans")
    assert sorted(tuple(r) for r in seen.collect()) == sorted((r[0], r[2], r[3]) for r in brute(rows))


def brute_phrases(rows, phrase, length=400):
    """Bytes gone by windows of so many bytes or words; with ``length=0`` those in phrases."""
    data = [(t or "").encode() for _, t in rows]
    found = [[m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", d)] for d in data]
    lists = [[d[a:b] for a, b in spans] for d, spans in zip(data, found, strict=True)]
    windows = Counter(d[i : i + 400] for d in data for i in range(len(d) - 399))
    runs = Counter(tuple(x[i : i + phrase]) for x in lists for i in range(len(x) - phrase + 1))
    out = []
    for (doc_id, _), d, spans, own in zip(rows, data, found, lists, strict=True):
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - 399 if length else 0):
            gone[i : i + 400] |= windows[d[i : i + 400]] > 1
        for i in range(len(own) - phrase + 1):
            gone[spans[i][0] : spans[i + phrase - 1][1]] |= runs[tuple(own[i : i + phrase])] > 1
        out.append((doc_id, int(gone.sum())))
    return sorted(out, key=str)


@pytest.mark.parametrize("often", [suffixes.OFTEN, 2])
def test_phrases_equal_brute_force(spark, often):
    words = prose(9, 60).split()
    rows = [
        *ROWS,
        (20, prose(21, 80) + " " + " ".join(words[:51]) + " " + prose(22, 30)),
        (21, prose(23, 80) + "\n" + "\t ".join(words[:51])),
        (22, " ".join(words[1:51]) + " " + prose(24, 80)),
        (23, " ".join(f"{i % 7}" for i in range(70))),
    ]
    df = spark.createDataFrame([(i, t, 0, "") for i, t in rows], SCHEMA)
    found = suffixes.remove_repeats(df, often=often, phrase=51).select("doc_id", "repeats.n_removed")
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute_phrases(rows, 51)


def test_stage_cuts_passages_of_51_words(spark, sf_dir):
    passage = " ".join(f"p{i}" for i in range(51))  # 193 bytes
    rows = [(i, f"{prose(30 + i, 60)} {passage} {prose(40 + i, 60)}") for i in range(2)]
    df = spark.createDataFrame([(i, t, "", "", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    cut = corpus_pipeline.without_repeats(spark, df, sf_dir).collect()
    assert sorted((r.doc_id, r.text) for r in cut) == [(i, t.replace(passage, "")) for i, t in rows]


def test_window_hashes_over_slices(monkeypatch):
    data = np.frombuffer((prose(3, 900) + prose(3, 900)).encode(), np.uint8)
    first, last = np.array([3, 2500]), np.array([2600, len(data) - 400])
    whole = suffixes.window_hashes(data, first, last)
    monkeypatch.setattr(suffixes, "SLICE", 700)
    cut = suffixes.window_hashes(data, first, last)
    assert all((x == y).all() for x, y in zip(whole, cut, strict=True))
    assert whole[0].tolist() == list(range(3, len(data) - 399))
    equal = Counter(zip(whole[1].tolist(), whole[2].tolist(), strict=True))
    raw = data.tobytes()
    assert sorted(equal.values()) == sorted(Counter(raw[i : i + 400] for i in whole[0].tolist()).values())


def test_whole_table(spark, sf_dir):
    docs = read_documents(spark, sf_dir)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    found = suffixes.repeat_digest(docs).collect()
    assert sorted((tuple(r)[:5] for r in found), key=str) == brute(rows)
    assert {r.doc_id: r.n_phrase_bytes for r in found} == dict(brute_phrases(rows, 51, 0))


def test_other_columns_stay(spark):
    df = spark.createDataFrame([(i, t, 5, "b") for i, t in ROWS], SCHEMA)
    out = suffixes.remove_repeats(df)
    assert out.columns == ["doc_id", "text", "block", "repeats"]
    rows = out.collect()
    assert {r.block for r in rows} == {"b"}
    assert all(r.text == bytes(r.repeats.kept).decode("utf-8", "ignore") for r in rows)


@pytest.mark.parametrize(("digit", "shorter"), [(10, 0.9), (4, 0.9), (3, 0.0)])
def test_long_suffix_arrays(monkeypatch, digit, shorter):
    """Several levels of names, of many digits, and names sorted by doubling."""
    monkeypatch.setattr(suffixes, "DIGIT", digit)
    monkeypatch.setattr(suffixes, "SHORTER", shorter)
    words = prose(11, 400)
    for raw in (words + words[50:], "ab" * 900, "a" * 900, "aab" * 300 + "aac" * 300, prose(12, 900)):
        text = np.append(np.frombuffer(raw.encode(), np.uint8), 0).astype(np.uint8)
        data = text.tobytes()
        assert suffixes.suffix_array(text).tolist() == sorted(range(len(data)), key=lambda i: data[i:])


def test_suffix_array_and_common_prefixes():
    generator = np.random.default_rng(1)
    for _ in range(200):
        n, k = int(generator.integers(1, 60)), int(generator.integers(1, 4))
        text = np.append(generator.integers(1, 1 + k, n), 0).astype(np.uint8)
        raw = text.tobytes()
        want = sorted(range(n + 1), key=lambda i: raw[i:])
        array = suffixes.suffix_array(text)
        assert array.tolist() == want
        shared = suffixes.common_prefixes(text, array, np.array([0]), 1000)
        for a, b in zip(want[1:], want, strict=False):
            x, y = raw[a:], raw[b:]
            assert shared[a] == next((i for i in range(min(len(x), len(y))) if x[i] != y[i]), min(len(x), len(y)))


def test_long_document_in_pieces(monkeypatch):
    data = np.frombuffer(prose(3, 3000).encode(), np.uint8)
    ends = np.array([200, 900, len(data)])
    whole = suffixes.anchor_runs(data, ends)
    monkeypatch.setattr(suffixes, "PIECE", 2000)
    monkeypatch.setattr(suffixes, "SLICE", 1000)
    cut = suffixes.anchor_runs(data, ends)

    def windows(runs):
        return {s: int(k) for k, _, a, b in zip(*runs, strict=True) for s in range(a, b + 1)}

    assert windows(whole) == windows(cut)
    assert set(windows(cut)) == {*range(200, 501), *range(900, len(data) - 399)}
