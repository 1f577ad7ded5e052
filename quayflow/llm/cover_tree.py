"""Exact near-duplicate vectors by dual traversal of cover trees.

Vectors of one label are unit vectors; those within ``radius`` (the chord of the cosine)
link. The upper tree is built by Spark, level by level: a cell with more than ``CELL``
vectors, or ``CELL_BYTES`` of them, is split by up to ``PIVOTS`` of its vectors, each vector
is at home with the nearest one, and the children's covering radii are the largest distances
found. Vectors also visit the other cells that may hold a link, those whose centre is not
farther than covering radius plus link radius, and that lie within the link radius of every
plane halfway between the cell's centre and another, so pairs of subtrees are pruned as the
levels descend. In a leaf cell the vectors at home, in parts of ``GUESTS``, and batches of
visitors get nested cover levels with halving radii; pairs of nodes are pruned by centre
distance less both covering radii, counted without distances if even the farthest pair
links, and compared at the leaves.

Where vectors lie so far apart that nothing is pruned, each visits all cells of its label:
what is moved and stored grows with the vectors times the cells, and the comparisons with
the square, so cells are as large as a task may hold.

Equal vectors of a label are one point with a count. Every vector at home meets all it
links to, so link counts need no second pass; for components each task passes on links
that connect its points, not all pairs.

Vectors that are null, zero, or hold null or non-finite components, and those without a
label, link with nothing; vectors of different length neither; equal ids are rows of
their own, null ids are counted as links but name no component; extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayflow.llm.blocks import stored
from quayflow.llm.components import components

CELL = 16_384
CELL_BYTES = 8 << 20
PIVOTS = 8
LEVELS = 24
LEAF = 24
GUESTS = 1024  # visitors that get a tree of their own
SLACK = 1e-9
POINTS = "point long, cell string, home boolean, times long, vector binary"


def _units(batches):
    """Unit vectors as bytes of doubles; null where a vector links with nothing."""
    for batch in batches:
        out = []
        for values in batch.column("embedding").to_pylist():
            unit = None
            if values is not None and len(values) and None not in values:
                vector = np.array(values, np.float64)
                size = np.abs(vector).max()
                if np.isfinite(size) and size > 0:
                    vector /= size
                    unit = (vector / np.sqrt(vector @ vector)).tobytes()
            out.append(unit)
        yield pa.RecordBatch.from_pydict(
            {
                "vec_id": batch.column("vec_id"),
                "label": batch.column("label"),
                "vector": pa.array(out, pa.binary()),
            }
        )


def _matrix(vectors) -> np.ndarray:
    values = [v.as_py() for v in vectors]
    return np.frombuffer(b"".join(values)).reshape(len(values), -1)


def _chords(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of unit vectors, each of a to each of b."""
    return np.sqrt(np.maximum(2 - 2 * (a @ b.T), 0))


def _by_cell(batch) -> list[tuple[str, np.ndarray]]:
    cells = np.array(batch.column("cell").to_pylist(), object)
    names, at = np.unique(cells, return_inverse=True)
    return [(name, np.flatnonzero(at == i)) for i, name in enumerate(names)]


def _to_nearest(batches):
    """Vectors at home in a split cell with the nearest child and the distance to it."""
    for batch in batches:
        number = np.zeros(batch.num_rows, np.int32)
        far = np.zeros(batch.num_rows)
        for _, rows in _by_cell(batch):
            centers = _matrix(batch.column("pivots")[int(rows[0])].values)
            chords = _chords(_matrix(batch.column("vector").take(pa.array(rows))), centers)
            number[rows], far[rows] = chords.argmin(1), chords.min(1)
        names = [f"{c}.{n}" for c, n in zip(batch.column("cell").to_pylist(), number, strict=True)]
        yield pa.RecordBatch.from_pydict(
            {
                **{n: batch.column(n) for n in ("point", "home", "times", "vector")},
                "parent": batch.column("cell"),
                "cell": pa.array(names, pa.string()),
                "child": pa.array(number, pa.int32()),
                "far": far,
            }
        )


def _beyond(vectors: np.ndarray, centers: np.ndarray, radius: float) -> np.ndarray:
    """Where a vector links with none that is at home with a centre.

    Those are on the centre's side of the planes halfway to the other centres, and a link
    reaches ``radius`` over a plane at most.
    """
    along = vectors @ centers.T
    reach = (radius + SLACK) * _chords(centers, centers) + SLACK
    beyond = np.zeros(along.shape, bool)
    for i in range(len(centers)):
        beyond |= along[:, i : i + 1] - along > reach[i]
    return beyond


def _visits(radius: float):
    """The children of their cell that vectors must visit besides their home."""

    def visits(batches):
        for batch in batches:
            cells, keep = [], []
            own = batch.column("own").to_numpy(False)
            for name, rows in _by_cell(batch):
                children = batch.column("children")[int(rows[0])].as_py()
                centers = np.frombuffer(b"".join(c["center"] for c in children)).reshape(len(children), -1)
                reach = np.array([c["far"] for c in children]) + radius + SLACK
                vectors = _matrix(batch.column("vector").take(pa.array(rows)))
                numbers = np.array([c["child"] for c in children])
                near = (_chords(vectors, centers) <= reach) & ~_beyond(vectors, centers, radius)
                near &= own[rows][:, None] != numbers[None, :]
                visitor, child = np.nonzero(near)
                keep += rows[visitor].tolist()
                cells += [f"{name}.{n}" for n in numbers[child].tolist()]
            taken = batch.select(["point", "times", "vector"]).take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_pydict(
                {
                    "point": taken.column("point"),
                    "cell": pa.array(cells, pa.string()),
                    "home": pa.array([False] * len(keep)),
                    "times": taken.column("times"),
                    "vector": taken.column("vector"),
                }
            )

    return visits


def _split(points: DataFrame, radius: float, cell: int, most: int = CELL_BYTES) -> tuple[DataFrame, DataFrame | None]:
    """One level: (points of cells that are leaves, points in the children of the others)."""
    sizes = points.filter("home").groupBy("cell").agg(
        F.count(F.lit(1)).alias("count"), F.sum(F.length("vector")).alias("bytes")
    )
    # a part is held as one tree however wide its vectors are
    sizes = sizes.filter((F.col("count") > cell) | ((F.col("bytes") > most) & (F.col("count") > GUESTS)))
    big = stored(sizes.select("cell"), "cells")
    if big.isEmpty():
        return points, None
    leaves = points.join(big, "cell", "left_anti")
    split = points.join(big, "cell", "left_semi")
    homes = split.filter("home")
    # a few vectors of each cell, by hashes of their number: combined before the shuffle
    seeds = [F.min_by("vector", F.xxhash64("point", F.lit(i))).alias(f"p{i}") for i in range(PIVOTS)]
    pivots = homes.groupBy("cell").agg(*seeds)
    pivots = pivots.select("cell", F.array_distinct(F.array(*[f"p{i}" for i in range(PIVOTS)])).alias("pivots"))
    pivots = stored(pivots, "pivots")
    schema = "point long, home boolean, times long, vector binary, parent string, cell string, child int, far double"
    homes = stored(homes.join(pivots, "cell").mapInArrow(_to_nearest, schema), "homes")
    children = homes.groupBy("parent", "child").agg(F.max("far").alias("far")).join(
        pivots.withColumnRenamed("cell", "parent"), "parent"
    )
    child = F.struct("child", "far", F.expr("pivots[child]").alias("center"))
    children = children.groupBy(F.col("parent").alias("cell")).agg(F.collect_list(child).alias("children"))
    own = homes.select("point", "times", "vector", F.col("parent").alias("cell"), F.col("child").alias("own"))
    guests = split.filter("NOT home").select("point", "times", "vector", "cell", F.lit(-1).alias("own"))
    visiting = own.unionByName(guests).join(children, "cell").mapInArrow(_visits(radius), POINTS)
    below = homes.select("point", "cell", "home", "times", "vector").unionByName(visiting)
    return leaves, stored(below, "level")


class CoverTree:
    """Nested levels of unit vectors: centre, covering radius, children or points of nodes."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.center: list[int] = []
        self.far: list[float] = []
        self.children: list[list[int]] = []
        self.points: list[np.ndarray] = []
        if len(vectors):
            rows = np.arange(len(vectors))
            self._node(rows, _chords(vectors, vectors[:1])[:, 0], 1.0)
        self.far_of = np.array(self.far)
        self.center_of = np.array(self.center, np.int64)
        counts = np.array([len(c) for c in self.children], np.int64)
        self.leaf = counts == 0
        self.n_children = counts
        self.first_child = np.cumsum(counts) - counts
        self.child = np.array([c for own in self.children for c in own], np.int64)

    def below(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Children of nodes, and the place of each one's parent among them."""
        counts = self.n_children[nodes]
        parent = np.repeat(np.arange(len(nodes)), counts)
        place = np.arange(len(parent)) - np.repeat(np.cumsum(counts) - counts, counts)
        return self.child[self.first_child[nodes][parent] + place], parent

    def _node(self, rows: np.ndarray, chords: np.ndarray, reach: float) -> int:
        """A node of ``rows`` whose centre, the first, is ``chords`` away from them."""
        number = len(self.center)
        self.center.append(int(rows[0]))
        self.far.append(float(chords.max()))
        self.children.append([])
        self.points.append(rows)
        if len(rows) <= LEAF or chords.max() <= SLACK:
            return number
        while reach >= chords.max():
            reach /= 2
        # centres farther than the reach from each other; the others join the nearest
        best, owner = chords.copy(), np.zeros(len(rows), np.int64)
        centers = [0]
        while best.max() > reach:
            new = int(best.argmax())
            centers.append(new)
            away = _chords(self.vectors[rows], self.vectors[rows[new : new + 1]])[:, 0]
            owner[away < best] = len(centers) - 1
            best = np.minimum(best, away)
        for i, c in enumerate(centers):
            mine = np.flatnonzero(owner == i)
            mine = np.concatenate([[c], mine[mine != c]])
            self.children[number].append(self._node(rows[mine], best[mine], reach / 2))
        return number


def linked(a: CoverTree, b: CoverTree, cosine: float):
    """Pairs of leaf nodes to compare, and pairs of nodes that link throughout."""
    radius = np.sqrt(2 - 2 * cosine)
    left, right = np.zeros(1, np.int64), np.zeros(1, np.int64)
    whole, compare = [], []
    centers = _chords(a.vectors[a.center_of], b.vectors[b.center_of])
    while len(left):
        apart = centers[left, right]
        both = a.far_of[left] + b.far_of[right]
        inside = apart + both <= radius - 1e-6
        whole.append((left[inside], right[inside]))
        open_ = ~inside & (apart - both <= radius + SLACK)
        left, right = left[open_], right[open_]
        done = a.leaf[left] & b.leaf[right]
        compare.append((left[done], right[done]))
        left, right = left[~done], right[~done]
        # the node with the larger radius is replaced by its children
        first = ~a.leaf[left] & (b.leaf[right] | (a.far_of[left] >= b.far_of[right]))
        down, parent = a.below(left[first])
        other, partner = b.below(right[~first])
        left, right = (
            np.concatenate([down, left[~first][partner]]),
            np.concatenate([right[first][parent], other]),
        )
    return [tuple(np.concatenate(p) for p in zip(*parts, strict=True)) for parts in (whole, compare)]


class _Forest:
    """Union-find that keeps the links that joined two sets."""

    def __init__(self):
        self.parent: dict[int, int] = {}
        self.links: list[tuple[int, int]] = []

    def root(self, x: int) -> int:
        parent = self.parent
        while (p := parent.setdefault(x, x)) != x:
            parent[x] = parent.setdefault(p, p)
            x = parent[x]
        return x

    def join(self, x: int, y: int) -> None:
        a, b = self.root(x), self.root(y)
        if a != b:
            self.parent[a] = b
            self.links.append((x, y))


def _meet(a, ids_a, links, b, ids_b, times_b, cosine, forest) -> None:
    """Count what the points of tree a link to in tree b; equal points are not counted."""
    whole, compare = linked(a, b, cosine)
    for n, m in zip(*(x.tolist() for x in whole), strict=True):
        rows, others = a.points[n], b.points[m]
        links[rows] += times_b[others].sum()
        same = np.isin(ids_a[rows], ids_b[others])
        if same.any():
            place = {int(i): k for k, i in enumerate(ids_b[others])}
            for r in rows[same].tolist():
                links[r] -= times_b[others[place[int(ids_a[r])]]]
        for i in ids_a[rows].tolist() + ids_b[others].tolist():
            forest.join(i, int(ids_b[others[0]]))
    left, right = compare
    if not len(left):
        return
    order = np.argsort(left, kind="stable")
    nodes, starts = np.unique(left[order], return_index=True)
    for n, partners in zip(nodes.tolist(), np.split(right[order], starts[1:]), strict=True):
        others = np.concatenate([b.points[m] for m in partners.tolist()])
        rows = a.points[n]
        hit = a.vectors[rows] @ b.vectors[others].T >= cosine
        hit &= ids_a[rows][:, None] != ids_b[others][None, :]
        links[rows] += hit @ times_b[others]
        found = np.flatnonzero(hit.any(0))
        if not len(found):
            continue
        # one link to each set of linked points is enough
        roots = np.array([forest.root(i) for i in ids_b[others[found]].tolist()])
        for r in np.flatnonzero(hit.any(1)).tolist():
            near = np.flatnonzero(hit[r, found])
            _, sets = np.unique(roots[near], return_index=True)
            for c in found[near[sets]].tolist():
                forest.join(int(ids_a[rows[r]]), int(ids_b[others[c]]))


def _pieces(batches):
    for batch in batches:
        for start in range(0, batch.num_rows, GUESTS):
            yield batch.slice(start, GUESTS)


def _leaf(cosine: float):
    """Links of the vectors at home in each cell; rows come sorted, those at home first."""

    def finish(state):
        ids, times, links, forest = state["ids"], state["times"], state["links"], state["forest"]
        n, joined = len(ids), forest.links
        return pa.RecordBatch.from_pydict(
            {
                "point": pa.array(np.concatenate([ids, [a for a, _ in joined]]).astype(np.int64)),
                "n_links": pa.array([*(links + times - 1).tolist(), *[None] * len(joined)], pa.int64()),
                "other": pa.array([None] * n + [b for _, b in joined], pa.int64()),
            }
        )

    def leaf(batches):
        state = None
        for batch in _pieces(batches):
            for name, rows in _by_cell(batch):
                part = batch.take(pa.array(rows))
                home = np.array(part.column("home").to_pylist(), bool)
                if state is None or state["name"] != name:
                    if state:
                        yield finish(state)
                    state = {"name": name, "trees": [], "forest": _Forest()}
                    state |= {"ids": np.zeros(0, np.int64), "times": np.zeros(0, np.int64), "links": np.zeros(0, np.int64)}
                for at_home in (True, False):
                    chosen = part.filter(pa.array(home == at_home))
                    if not chosen.num_rows:
                        continue
                    ids = chosen.column("point").to_numpy(False)
                    times = chosen.column("times").to_numpy(False)
                    tree = CoverTree(_matrix(chosen.column("vector")))
                    if at_home:
                        state["ids"] = np.concatenate([state["ids"], ids])
                        state["times"] = np.concatenate([state["times"], times])
                        state["links"] = np.concatenate([state["links"], np.zeros(len(ids), np.int64)])
                        state["trees"].append((tree, len(state["ids"]) - len(ids), len(state["ids"])))
                        for other, low, high in state["trees"]:
                            pairs = [(other, low, high, tree, ids, times)]
                            if other is not tree:
                                own = state["trees"][-1]
                                old = state["ids"][low:high], state["times"][low:high]
                                pairs.append((tree, own[1], own[2], other, *old))
                            for a, x, y, b, ids_b, times_b in pairs:
                                _meet(a, state["ids"][x:y], state["links"][x:y], b, ids_b, times_b, cosine, state["forest"])
                    else:
                        for other, low, high in state["trees"]:
                            _meet(other, state["ids"][low:high], state["links"][low:high], tree, ids, times, cosine, state["forest"])
        if state:
            yield finish(state)

    return leaf


def near_vectors(vectors: DataFrame, cosine: float = 0.98, cell: int = CELL) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for ``vectors(vec_id, embedding, label)``."""
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("embedding"),
        F.col("label").cast("string").alias("label"),
    )
    rows = stored(rows.mapInArrow(_units, "vec_id long, label string, vector binary"), "units")
    fits = rows.filter("label IS NOT NULL AND vector IS NOT NULL")
    alone = rows.filter("label IS NULL OR vector IS NULL")
    distinct = fits.groupBy("label", "vector").agg(
        F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("times")
    )
    numbered = stored(distinct.withColumn("point", F.monotonically_increasing_id()), "points")
    group = F.concat_ws(":", F.length("vector"), "label")
    points = numbered.select("point", group.alias("cell"), F.lit(True).alias("home"), "times", "vector")
    radius = float(np.sqrt(2 - 2 * cosine))
    leaves = None
    for level in range(LEVELS + 1):
        limits = (cell, CELL_BYTES) if level < LEVELS else (1 << 62, 1 << 62)
        at_rest, points = _split(points, radius, *limits)
        leaves = at_rest if leaves is None else leaves.unionByName(at_rest)
        if points is None:
            break
    met = leaves.repartition("cell").sortWithinPartitions("cell", F.desc("home"))
    found = stored(met.mapInArrow(_leaf(cosine), "point long, n_links long, other long"), "links")
    links = found.filter("other IS NOT NULL").select(F.col("point").alias("a"), F.col("other").alias("b"))
    names = components(links).toDF("point", "component")
    named = (
        numbered.select("point", "label", "vector", "first")
        .join(names, "point", "left")
        .withColumn("component", F.coalesce("component", "point"))
    )
    smallest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    counts = found.filter("other IS NULL").groupBy("point").agg(F.sum("n_links").alias("n_links"))
    classes = named.join(smallest, "component").join(counts, "point").select(
        "label", "vector", "n_links", "component_id"
    )
    joined = fits.join(classes, ["label", "vector"]).select("vec_id", "n_links", "component_id")
    single = alone.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return joined.unionByName(single).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    )
