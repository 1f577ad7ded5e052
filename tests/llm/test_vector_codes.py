"""Codes against plain integers, for vectors of any size and length."""

import hashlib
import math
from fractions import Fraction

import numpy as np
import pytest

from quayflow.llm import vector_codes

SCHEMA = "vec_id long, embedding array<double>, label int, code string, error string"


def brute(rows, n_parts=16, n_entries=64, rounds=2):
    kept = [(i, v, label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = max(1, -(-max((len(v) for _, v, _ in kept), default=0) // n_parts))
    cut = []
    for i, v, label in kept:
        whole = [math.floor(Fraction(x) * 256) for x in v] + [0] * (width * n_parts - len(v))
        cut.append((i, label, [whole[p * width : (p + 1) * width] for p in range(n_parts)]))
    first = sorted(zip(kept, cut, strict=True), key=lambda r: (r[0][0] is None, r[0][0] or 0, r[0][1]))[:n_entries]
    books = [[c[2][p] for _, c in first] for p in range(n_parts)]

    def near(part, book):
        return min((sum((x - y) ** 2 for x, y in zip(part, e, strict=True)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            owned = [[] for _ in book]
            for _, _, parts in cut:
                owned[near(parts[p], book)[1]].append(parts[p])
            books[p] = [[sum(c) // len(o) for c in zip(*o, strict=True)] if o else e for o, e in zip(owned, book, strict=True)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out, sums = [], {}
    for i, label, parts in cut:
        best = [near(part, book) for part, book in zip(parts, books, strict=True)]
        error = sum(d for d, _ in best)
        if error < 1 << 63:
            sums[label] = sums.get(label, 0) + error
        out.append((i, "".join(f"{k:02x}" for _, k in best), error if error < 1 << 63 else None, label))
    return sorted(((i, c, e, sums.get(label), digest) for i, c, e, label in out), key=str)


def rows_of(seed, n, size, scale=1.0):
    generator = np.random.default_rng(seed)
    centers = generator.normal(size=(5, size))
    values = (centers[generator.integers(0, 5, n)] + 0.1 * generator.normal(size=(n, size))) * scale
    labels = generator.integers(0, 3, n).tolist()
    return [(i, v, label if i % 11 else None) for i, (v, label) in enumerate(zip(values.tolist(), labels, strict=True))]


ODD = [
    (1000, None, 1),
    (1001, [0.5, None, 1.0], 1),
    (1002, [float("nan")] * 32, 1),
    (1003, [float("inf")] * 32, None),
    (1004, [float("-inf")] * 32, 2),
    (1005, [], 2),
    (1006, [0.25, -0.001], None),
    (None, [0.5] * 32, 0),
    (None, [0.25] * 32, 0),
    (3, [0.5] * 32, 0),
    (3, [0.5] * 32, 0),
    (-1, [-0.0] * 32, 0),
]


def got(spark, rows, partitions=3):
    df = spark.createDataFrame([(i, v, label, "c", "e") for i, v, label in rows], SCHEMA).repartition(partitions)
    return sorted((tuple(r) for r in vector_codes.code_digest(df).collect()), key=str)


@pytest.mark.parametrize("n,size", [(300, 32), (40, 48), (90, 16), (70, 37)])
def test_codes_equal_brute_force(spark, n, size):
    rows = rows_of(size, n, size) + (ODD if size == 32 else [])
    assert got(spark, rows) == brute(rows)


@pytest.mark.parametrize("scale", [1e5, 1e9, 1e30, 1e306])
def test_large_components_are_exact(spark, scale):
    rows = rows_of(2, 80, 32, scale) + [(200, [1e-3] * 32, 1), (201, [-scale] * 32, 1)]
    assert got(spark, rows) == brute(rows)


def test_sums_of_one_cell_beyond_64_bits(spark):
    rows = [(i, [3.9e8] * 32, 0) for i in range(70)] + [(100 + i, [float(2**52)] * 32, 0) for i in range(900)]
    assert got(spark, rows, 1) == brute(rows)


def test_empty_tables(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert vector_codes.code_digest(df).collect() == []
    unusable = spark.createDataFrame([(1, None, 1, "", "")], SCHEMA)
    assert vector_codes.code_digest(unusable).collect() == []


def test_transform_keeps_distances_in_order_of_sequency():
    generator = np.random.default_rng(1)
    for width in (1, 2, 3, 4, 7, 16):
        a, b = generator.integers(-500, 500, (2, 40, width))
        size = vector_codes.padded_width(width)
        ours = ((vector_codes.transformed(a) - vector_codes.transformed(b)) ** 2).sum(1)
        assert (ours == size * ((a - b) ** 2).sum(1)).all()
        basis = vector_codes.transformed(np.eye(size, dtype=np.int64)).T
        assert [int((np.diff(row) != 0).sum()) for row in basis] == list(range(size))


def test_ties_go_to_the_lower_index():
    entries = vector_codes.transformed(np.array([[5, 5], [1, 0], [0, 1], [1, 0], [-1, 0]]))
    parts = vector_codes.transformed(np.array([[0, 0], [1, 1], [1, 0], [9, 9]]))
    codes, sums = vector_codes.nearest(parts, entries)
    assert codes.tolist() == [1, 1, 1, 0] and (sums // 2).tolist() == [1, 1, 0, 32]
