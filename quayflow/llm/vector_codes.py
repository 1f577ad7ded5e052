"""Compress vectors to short codes with integer codebooks, exactly.

A component x is the integer floor(256 x). Vectors are cut into equal consecutive parts and
each part position has a codebook; a part's code is its nearest entry by squared Euclidean
distance, the lowest index among ties. Codebooks start as the parts of the vectors with the
smallest ids and are moved to the floored means of their parts a fixed number of rounds.

The nearest entry is found on Walsh-Hadamard transforms of the parts and the entries, padded
with zeros to a power of two P. The transform keeps squared distances but for the factor P
and gathers what a slowly varying part holds in the first coefficients by sequency (number
of sign changes). So the squared differences are added up coefficient by coefficient, and an
entry is out as soon as its sum exceeds the whole distance of the entry that was nearest by
the first one. All sums are integers: of 64 bits where the numbers allow it, else Python's.

Each round is one pass over the vectors without a shuffle of them: a task adds up its parts
by entry and sends those sums. The driver gets the sums of one codebook, which are as many
as the codebook's components however many vectors there are.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayflow.llm.blocks import column, stored

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2
SLICE = 1 << 20  # components that are coded at a time
LIMB = 30  # bits of the pieces in which sums beyond 64 bits are sent
COUNT = -1  # stands for a position where a row holds a count


# --- numbers


def padded_width(width: int) -> int:
    return 1 << (width - 1).bit_length()


def by_sequency(size: int) -> np.ndarray:
    """Rows of the Hadamard matrix in order of their sign changes."""
    row = np.arange(size)
    signs = np.bitwise_count(row[:, None] & row) & 1
    return np.argsort(np.count_nonzero(np.diff(signs, axis=1), axis=1), kind="stable")


def transformed(values: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform along the last axis, zero-padded, in order of sequency."""
    size = padded_width(values.shape[-1])
    out = np.zeros((*values.shape[:-1], size), values.dtype)
    out[..., : values.shape[-1]] = values
    half = 1
    while half < size:
        pairs = out.reshape(*out.shape[:-1], size // (2 * half), 2, half)
        low, high = pairs[..., 0, :].copy(), pairs[..., 1, :].copy()
        pairs[..., 0, :] = low + high
        pairs[..., 1, :] = low - high
        half *= 2
    return out[..., by_sequency(size)]


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry and P times its squared distance, of transformed parts."""
    step = parts[:, :1] - entries[:, 0]
    sums = step * step
    number = np.arange(len(parts))
    guess = sums.argmin(1)
    rest = parts[:, 1:] - entries[guess, 1:]
    most = sums[number, guess] + (rest * rest).sum(1)
    part, entry = np.nonzero(sums <= most[:, None])
    sums = sums[part, entry]
    for k in range(1, parts.shape[1]):
        step = parts[part, k] - entries[entry, k]
        sums = sums + step * step
        stays = sums <= most[part]
        part, entry, sums = part[stays], entry[stays], sums[stays]
    least = np.minimum.reduceat(sums, np.searchsorted(part, number))
    ties = np.flatnonzero(sums == least[part])
    first = ties[np.searchsorted(part[ties], number)]
    return entry[first], least


def _wide(values: np.ndarray, width: int) -> bool:
    """Whether P times squared distances of such numbers may not fit 64 bits."""
    bits = (60 - 2 * (padded_width(width) - 1).bit_length()) // 2
    return values.dtype == object or bool(values.size and np.abs(values).max() >= 1 << bits)


def _integer(x: float) -> int:
    """floor(SCALE * x), also where the product is not a double."""
    return int(x) * SCALE if abs(x) >= 1 << 53 else math.floor(x * SCALE)


def integers(vectors: pa.Array, n_parts: int, width: int) -> np.ndarray:
    """Lists as an array of (vector, part, position); shorter ones are padded with zeros."""
    size = n_parts * width
    offsets = vectors.offsets.to_numpy().astype(np.int64)
    flat = vectors.values.slice(int(offsets[0]), int(offsets[-1] - offsets[0]))
    flat = flat.to_numpy(zero_copy_only=False).astype(np.float64)
    if flat.size and np.abs(flat).max() >= float(1 << 46):
        scaled = np.array([_integer(x) for x in flat.tolist()], object)
    else:
        scaled = np.floor(flat * SCALE).astype(np.int64)
    lengths = np.diff(offsets)
    if (lengths == size).all():
        return scaled.reshape(-1, n_parts, width)
    out = np.zeros((len(lengths), size), scaled.dtype)
    out[np.arange(size) < lengths[:, None]] = scaled
    return out.reshape(-1, n_parts, width)


def assigned(values: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes and squared distances of each vector's parts; books: (part, entry, position)."""
    width = values.shape[2]
    wide = _wide(values, width) or _wide(books, width)
    kind = object if wide else np.int64
    parts, entries = transformed(values.astype(kind)), transformed(books.astype(kind))
    codes = np.empty(values.shape[:2], np.int64)
    errors = np.empty(values.shape[:2], kind)
    for p in range(values.shape[1]):
        codes[:, p], errors[:, p] = nearest(parts[:, p], entries[p])
    return codes, errors // padded_width(width)


# --- the table


def _slices(batches, n_parts: int, width: int):
    rows = max(1, SLICE // (n_parts * width))
    for batch in batches:
        table = pa.Table.from_batches([batch])
        for at in range(0, batch.num_rows, rows):
            part = table.slice(at, rows)
            yield part, integers(column(part, "embedding"), n_parts, width)


def _partial_sums(books: np.ndarray):
    """A task's sums of parts by entry: cells are numbered by part, entry and position."""
    n_parts, n_entries, width = books.shape

    def partial_sums(batches):
        counts = np.zeros(n_parts * n_entries, np.int64)
        sums = np.zeros((n_parts * n_entries, width), np.int64)
        for _, values in _slices(batches, n_parts, width):
            codes, _ = assigned(values, books)
            if _wide(values, width) or np.abs(sums).max() >= 1 << 61:
                values, sums = values.astype(object), sums.astype(object)
            cell = (codes + np.arange(n_parts) * n_entries).ravel()
            order = np.argsort(cell, kind="stable")
            used, first, times = np.unique(cell[order], return_index=True, return_counts=True)
            counts[used] += times
            sums[used] += np.add.reduceat(values.reshape(-1, width)[order], first, axis=0)
        cell = np.flatnonzero(counts)
        rows = [(c, COUNT, 0, n) for c, n in zip(cell.tolist(), counts[cell].tolist(), strict=True)]
        for c in cell.tolist():
            for position, value in enumerate(sums[c].tolist()):
                limb = 0
                while abs(value) >= 1 << 62:
                    rows.append((c, position, limb, value & ((1 << LIMB) - 1)))
                    value, limb = value >> LIMB, limb + 1
                rows.append((c, position, limb, value))
        if rows:
            names = ("cell", "position", "limb", "value")
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64())
            columns = [pa.array(values, kind) for values, kind in zip(zip(*rows), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=list(names))

    return partial_sums


def moved_books(vectors: DataFrame, books: np.ndarray) -> np.ndarray:
    """Each entry as the floored mean of the parts nearest to it; entries without any stay."""
    parts = vectors.select("embedding").mapInArrow(
        _partial_sums(books), "cell int, position int, limb int, value bigint"
    )
    total = F.sum(F.col("value").cast("decimal(38,0)")).alias("total")
    # as many rows as the codebooks have components (times limbs, if sums are very large)
    rows = parts.groupBy("cell", "position", "limb").agg(total).collect()
    counts: dict[int, int] = {}
    sums: dict[tuple[int, int], int] = {}
    for cell, position, limb, value in rows:
        if position == COUNT:
            counts[cell] = int(value)
        else:
            sums[cell, position] = sums.get((cell, position), 0) + (int(value) << (LIMB * limb))
    moved = books.astype(object).reshape(-1, books.shape[2])
    for (cell, position), value in sums.items():
        moved[cell, position] = value // counts[cell]
    return _narrow(moved.reshape(books.shape))


def _narrow(values: np.ndarray) -> np.ndarray:
    """64-bit numbers where they fit."""
    return values if max(map(abs, values.ravel().tolist()), default=0) >> 62 else values.astype(np.int64)


def kept_vectors(vectors: DataFrame) -> DataFrame:
    """``vec_id, embedding, label`` of the rows whose vector is whole and finite."""
    unusable: Column = F.exists(
        "embedding",
        lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")),
    )
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding", "label")
    return rows.filter(F.col("embedding").isNotNull() & ~unusable)


def first_books(kept: DataFrame, n_parts: int, n_entries: int) -> np.ndarray:
    """The parts of the vectors with the smallest ids, by part, entry and position."""
    longest = kept.agg(F.max(F.size("embedding")).alias("n")).first()["n"] or 0
    width = max(1, -(-longest // n_parts))
    order = [F.col("vec_id").asc_nulls_last(), F.col("embedding")]
    rows = kept.select("vec_id", "embedding").orderBy(*order).limit(n_entries).collect()
    vectors = pa.array([row["embedding"] for row in rows], pa.list_(pa.float64()))
    values = integers(vectors, n_parts, width) if rows else np.zeros((0, n_parts, width), np.int64)
    return np.ascontiguousarray(values.transpose(1, 0, 2))


def books_digest(books: np.ndarray) -> str:
    """SHA-256 of the components as decimal text by part, entry and position."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def _coding(books: np.ndarray):
    n_parts, _, width = books.shape

    def coding(batches):
        for table, values in _slices(batches, n_parts, width):
            codes, errors = assigned(values, books)
            hexed = [row.tobytes().hex() for row in codes.astype(np.uint8)]
            whole = [sum(row) for row in errors.tolist()]
            yield pa.RecordBatch.from_arrays(
                [
                    column(table, "vec_id"),
                    column(table, "label"),
                    pa.array(hexed, pa.string()),
                    pa.array([e if e < 1 << 63 else None for e in whole], pa.int64()),
                ],
                names=["vec_id", "label", "code", "error"],
            )

    return coding


def vector_codes(
    vectors: DataFrame, n_parts: int = PARTS, n_entries: int = ENTRIES, rounds: int = ROUNDS
) -> tuple[DataFrame, np.ndarray]:
    """``vec_id, label, code, error`` of the usable rows of ``vectors``, and the codebooks.

    ``vectors(vec_id, embedding, label)``; ``n_entries`` is 256 at most. Rows whose vector is
    null or holds null or non-finite components are left out. Vectors are padded with zeros
    to the longest one and to a multiple of ``n_parts``. Null ids come last among the
    smallest; rows of equal ids go by their vectors. ``code`` has two hex digits for each
    part, ``error`` is the sum of the squared distances, null where it exceeds 64 bits.
    Fewer rows than entries give as many entries; no rows give none. Extra columns are
    ignored. The codebooks are an array by part, entry and position.
    """
    kept = kept_vectors(vectors)
    books = first_books(kept, n_parts, n_entries)
    for _ in range(rounds):
        books = moved_books(kept, books)
    label = kept.schema["label"].dataType.simpleString()
    schema = f"vec_id bigint, label {label}, code string, error bigint"
    return kept.mapInArrow(_coding(books), schema), books


def code_digest(vectors: DataFrame) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` for each usable row.

    ``label_error`` is the sum of ``error`` over the rows of the same label, null labels
    together, and leaves out errors that are null; null where it exceeds 64 bits.
    """
    coded, books = vector_codes(vectors)
    coded = stored(coded, "codes")
    sums = coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("label_sum"))
    joined = coded.alias("c").join(sums.alias("s"), F.expr("c.label <=> s.label"))
    return joined.select(
        "c.vec_id",
        "c.code",
        "c.error",
        F.col("s.label_sum").try_cast("bigint").alias("label_error"),
        F.lit(books_digest(books)).alias("codebooks_sha256"),
    )


def _round_sql(old: str, new: str) -> str:
    return f"""
{new}_near AS (
  SELECT vec_id, part, min(d * {ENTRIES} + entry) AS best FROM (
    SELECT vec_id, part, entry, sum((c.x - e.x) * (c.x - e.x))::BIGINT AS d
    FROM parts c JOIN {old} e USING (part, pos) GROUP BY vec_id, part, entry)
  GROUP BY vec_id, part),
{new} AS (
  SELECT e.part, e.entry, e.pos, coalesce(m.x, e.x) AS x
  FROM {old} e LEFT JOIN (
    SELECT part, best % {ENTRIES} AS entry, pos, floor(sum(x) / count(*))::BIGINT AS x
    FROM parts JOIN {new}_near USING (vec_id, part) GROUP BY ALL) m USING (part, entry, pos))"""


# ``code_digest`` in DuckDB SQL, for tables with distinct ids and vectors of one length.
CODES_SQL = f"""
WITH kept AS (
  SELECT vec_id, label, embedding AS v, len(embedding) // {PARTS} AS width,
    row_number() OVER (ORDER BY vec_id) - 1 AS number
  FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
places AS (SELECT *, unnest(range(0, len(v))) AS i FROM kept),
parts AS (
  SELECT vec_id, label, number, i // width AS part, i % width AS pos,
    floor({SCALE} * v[i + 1]::DOUBLE)::BIGINT AS x FROM places),
e0 AS (SELECT part, number AS entry, pos, x FROM parts WHERE number < {ENTRIES}),
{_round_sql("e0", "e1")},
{_round_sql("e1", "e2")},
{_round_sql("e2", "e3")},
codes AS (
  SELECT vec_id, any_value(label) AS label, sum(best // {ENTRIES})::BIGINT AS error,
    string_agg(printf('%02x', best % {ENTRIES}), '' ORDER BY part) AS code
  FROM e3_near JOIN kept USING (vec_id) GROUP BY vec_id),
books AS (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY part, entry, pos)) AS digest FROM e2)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
  digest AS codebooks_sha256
FROM codes, books
"""
