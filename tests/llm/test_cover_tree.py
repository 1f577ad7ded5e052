"""Links and components of vectors against all pairs."""

import numpy as np
import pytest

from quayflow.llm import cover_tree

SCHEMA = "vec_id long, embedding array<float>, label int, point string, cell int"


def brute(rows, cosine=0.98):
    def unit(v):
        if v is None or not len(v) or None in v or not np.all(np.isfinite(v)) or not np.any(v):
            return None
        x = np.array(v, np.float32).astype(np.float64)
        return x / np.linalg.norm(x)

    units = [unit(v) for _, v, _ in rows]
    n = len(rows)
    near = np.zeros((n, n), bool)
    for i in range(n):
        for j in range(n):
            if i != j and units[i] is not None and units[j] is not None and rows[i][2] is not None:
                if rows[i][2] == rows[j][2] and len(units[i]) == len(units[j]):
                    near[i, j] = units[i] @ units[j] >= cosine
    group = list(range(n))
    for _ in range(n):
        new = [min([group[i], *(group[j] for j in np.flatnonzero(near[i]))]) for i in range(n)]
        if new == group:
            break
        group = new
    out = []
    for i, (vec_id, _, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(n) if group[j] == group[i] and rows[j][0] is not None]
        name = min(ids, default=None)
        out.append((vec_id, int(near[i].sum()), name, vec_id is not None and vec_id == name))
    return sorted(out, key=str)


def got(spark, rows, **options):
    df = spark.createDataFrame([(i, v, k, "p", 1) for i, v, k in rows], SCHEMA)
    return sorted((tuple(r) for r in cover_tree.near_vectors(df, **options).collect()), key=str)


def clustered(n, dimensions, seed, spread):
    generator = np.random.default_rng(seed)
    centers = generator.normal(size=(6, dimensions))
    rows = []
    for i in range(n):
        c = centers[generator.integers(6)]
        v = c * generator.uniform(0.5, 2) + generator.normal(size=dimensions) * spread * np.linalg.norm(c)
        rows.append((i * 3 + 1, v.astype(np.float32).tolist(), int(generator.integers(2))))
    rows += [(5000 + i, rows[0][1], rows[0][2]) for i in range(15)]
    return rows


ODD = [
    (None, [1.0, 0.0], 1),
    (1, [1.0, 0.0], 1),
    (2, [2.0, 0.0], 1),
    (3, [2.0, 0.0], None),
    (4, None, 1),
    (5, [], 1),
    (6, [0.0, 0.0], 1),
    (7, [float("nan"), 1.0], 1),
    (8, [float("inf"), 1.0], 1),
    (9, [None, 1.0], 1),
    (10, [1.0, 0.0, 0.0], 1),
    (11, [1e30, 1e29], 1),
    (12, [1.0, 0.19], 1),
    (12, [1.0, 0.19], 1),
    (13, [1e-30, 1e-31], 1),
]


def test_odd_rows(spark):
    assert got(spark, ODD) == brute(ODD)
    assert got(spark, []) == []


@pytest.mark.parametrize(("dimensions", "spread", "cell"), [(16, 0.05, 20), (16, 0.02, 1024), (4, 0.1, 12), (16, 0.3, 30)])
def test_links_equal_all_pairs(spark, dimensions, spread, cell):
    rows = clustered(150, dimensions, 3, spread)
    assert got(spark, rows, cell=cell) == brute(rows)


def test_whole_label_groups(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    ours = sorted((tuple(r) for r in cover_tree.near_vectors(df).collect()), key=str)
    assert ours == brute(rows)


def test_traversal_prunes(monkeypatch):
    """Far clusters are not compared point by point."""
    generator = np.random.default_rng(2)
    centers = np.eye(8)
    points = np.repeat(centers, 60, 0) + generator.normal(size=(480, 8)) * 0.01
    points /= np.linalg.norm(points, axis=1)[:, None]
    tree = cover_tree.CoverTree(points)
    whole, compare = cover_tree.linked(tree, tree, 0.98)
    compared = sum(len(tree.points[a]) * len(tree.points[b]) for a, b in zip(*compare, strict=True))
    counted = sum(len(tree.points[a]) * len(tree.points[b]) for a, b in zip(*whole, strict=True))
    assert compared + counted < 480 * 480 / 4
    assert counted > 0


def apart(n, dimensions, seed=4):
    """Unit vectors that lie about equally far from each other."""
    vectors = np.random.default_rng(seed).normal(size=(n, dimensions))
    return vectors / np.linalg.norm(vectors, axis=1)[:, None]


def split(spark, vectors, **limits):
    rows = [(i, "c", True, 1, v.tobytes()) for i, v in enumerate(vectors)]
    points = spark.createDataFrame(rows, cover_tree.POINTS)
    return cover_tree._split(points, float(np.sqrt(2 - 2 * 0.98)), **limits)


def test_vectors_far_apart_are_moved_a_few_times(spark):
    """Cells hold what a task may hold, so vectors that visit every cell visit few."""
    vectors = apart(2500, 8)
    leaves, children = split(spark, vectors, cell=cover_tree.CELL)
    assert children is None and leaves.count() == len(vectors)


def test_cells_of_wide_vectors_are_split_by_bytes(spark):
    vectors = apart(1200, 128)
    leaves, children = split(spark, vectors, cell=cover_tree.CELL, most=1 << 20)
    assert leaves.count() == 0 and children.filter("home").count() == len(vectors)


def test_no_linked_vector_is_beyond_a_plane():
    """A good part of the visits that covering radii allow is left out, and no link is."""
    vectors, radius = apart(800, 8), float(np.sqrt(2 - 2 * 0.98))
    copies = vectors + 0.05 * apart(800, 8, seed=5)
    vectors = np.concatenate([vectors, copies / np.linalg.norm(copies, axis=1)[:, None]])
    centers = vectors[:16]
    home = cover_tree._chords(vectors, centers).argmin(1)
    beyond = cover_tree._beyond(vectors, centers, radius)
    a, b = np.nonzero(vectors @ vectors.T >= 0.98)
    assert len(a) > 2 * len(vectors) and (home[a] != home[b]).any()
    assert not beyond[a, home[b]].any()
    assert beyond.mean() > 0.3
