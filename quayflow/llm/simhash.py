"""SimHash fingerprints and near-duplicate groups by deletion-variant signatures.

Fingerprints within ``3`` bits are found from two segments of 32 bits: one of them
differs by at most one bit, so both fingerprints share a variant of it in which that
bit is blanked. Each distinct fingerprint is indexed under its 2 x 32 variants, equal
variants meet by an equality shuffle, and the distance is verified.

Where many fingerprints meet, only links that join them are kept (a search through the
group, no pairs written). A group beyond ``GROUP`` is dealt again by the bytes of the
other segment, of which one must be equal, and one that still is by its hexadecimal digits,
of which five must be, so no distance of 3 or less is lost and every search is bounded.

Null texts count as empty, whose fingerprint is zero and linked like any other; a null
``doc_id`` takes the smallest id linked to it, or null; repeated rows give a row each;
extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayflow.llm.blocks import blocks, column, stored, texts, words
from quayflow.llm.components import components

SEED = 42
SHINGLE = 3
DISTANCE = 3
GROUP = 20_000
SMALL = 16
CHUNK = 1 << 18
BYTES = [255 << 8 * i for i in range(4)]
DIGITS = [sum(15 << 4 * i for i in five) for five in combinations(range(8), 5)]


def fingerprints(values: pa.Array) -> np.ndarray:
    """64-bit fingerprints of lower-cased texts."""
    ids, offsets, distinct = words(values)
    joined = pc.binary_join(pc.ascii_split_whitespace(pc.ascii_trim_whitespace(values)), " ")
    data = b"".join(value.encode() for value in joined.to_pylist())
    n_words = np.diff(offsets)
    length = pc.binary_length(distinct).to_numpy().astype(np.int64)[ids]
    doc = np.repeat(np.arange(len(n_words)), n_words)
    full = np.cumsum(n_words > 0) - 1  # documents with words have no blank at their end
    start = np.cumsum(length + 1) - length - 1 - full[doc]
    end = start + length
    left = offsets[1:][doc] - np.arange(len(ids))  # words from here to the document's end
    whole = (left == n_words[doc]) & (left < SHINGLE)
    first = np.flatnonzero((left >= SHINGLE) | whole)
    last = first + np.minimum(left[first], SHINGLE) - 1
    ones = np.zeros((len(n_words), 64), np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(first), CHUNK):
        some, until = first[at : at + CHUNK], last[at : at + CHUNK]
        spans = zip(start[some].tolist(), end[until].tolist(), strict=True)
        hashes = np.array([digest(data[a:b], SEED) for a, b in spans], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        cuts = np.flatnonzero(np.diff(doc[some], prepend=-1))
        ones[doc[some[cuts]]] += np.add.reduceat(bits, cuts, axis=0, dtype=np.int32)
    n_shingles = np.bincount(doc[first], minlength=len(n_words))
    set_bits = (2 * ones > n_shingles[:, None]).astype(np.uint8)
    return np.packbits(set_bits, axis=1, bitorder="little").view(np.uint64).reshape(-1)


def _fingerprint_rows(batches):
    for table in blocks(batches, size=8 << 20):
        prints = fingerprints(texts(table, lower=True))
        yield pa.RecordBatch.from_pydict(
            {"doc_id": column(table, "doc_id"), "fingerprint": prints.view(np.int64)}
        )


def document_fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint`` (the 64 bits as a signed number)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInArrow(_fingerprint_rows, "doc_id long, fingerprint long")


def variants(prints: DataFrame) -> DataFrame:
    """``key, fingerprint``: each segment with each of its bits blanked."""
    number = F.col("number")
    segment = F.expr("shiftrightunsigned(fingerprint, CAST(number DIV 32 AS INT) * 32) & 4294967295L")
    blanked = F.expr("~shiftleft(1L, CAST(number % 32 AS INT))")
    return prints.select(
        "fingerprint", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("number")
    ).select(
        (F.shiftleft(number.cast("long"), 32).bitwiseOR(segment.bitwiseAND(blanked))).alias("key"),
        "fingerprint",
    )


def _runs(batches, limit: int):
    """Rows sorted by key as whole groups; (keys, fingerprints, is the group cut)."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    held_rows, cut_key = 0, None
    for batch in batches:
        key = batch.column("key").to_numpy(False)
        value = batch.column("fingerprint").to_numpy(False).view(np.uint64)
        if not len(key):
            continue
        last = int(np.searchsorted(key, key[-1], "left"))
        if last:  # all groups but the batch's last are complete
            parts = [*held, (key[:last], value[:last])]
            keys, values = (np.concatenate(part) for part in zip(*parts, strict=True))
            if cut_key is not None:
                n = int(np.searchsorted(keys, cut_key, "right"))
                if n:
                    yield keys[:n], values[:n], True
                keys, values, cut_key = keys[n:], values[n:], None
            if len(keys):
                yield keys, values, False
            held, held_rows = [], 0
        elif held and held[-1][0][-1] != key[0]:  # the group held ended with its batch
            keys, values = (np.concatenate(part) for part in zip(*held, strict=True))
            yield keys, values, cut_key is not None
            held, held_rows, cut_key = [], 0, None
        elif cut_key is not None and cut_key != key[0]:
            cut_key = None
        held.append((key[last:], value[last:]))
        held_rows += len(key) - last
        if held_rows > limit:
            keys, values = (np.concatenate(part) for part in zip(*held, strict=True))
            cut_key, held, held_rows = keys[0], [], 0
            yield keys, values, True
    if held:
        keys, values = (np.concatenate(part) for part in zip(*held, strict=True))
        yield keys, values, cut_key is not None


def _close(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b) <= DISTANCE


def spanning_links(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join all values connected within the distance: a search from each."""
    left = np.unique(values)
    sources, targets = [], []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            node = queue.pop()
            near = _close(left, node)
            found = left[near]
            if len(found):
                sources.append(np.full(len(found), node))
                targets.append(found)
                queue.extend(found)
                left = left[~near]
    if not sources:
        return values[:0], values[:0]
    return np.concatenate(sources), np.concatenate(targets)


def _group_links(keys: np.ndarray, values: np.ndarray):
    """Links within each group of equal, sorted keys."""
    starts = np.flatnonzero(np.diff(keys, prepend=keys[0] - 1))
    sizes = np.diff(np.append(starts, len(keys)))
    remaining = np.repeat(starts + sizes, sizes) - np.arange(len(keys)) - 1
    small = np.repeat(sizes <= SMALL, sizes)
    for step in range(1, SMALL):
        at = np.flatnonzero(small & (remaining >= step))
        at = at[_close(values[at], values[at + step])]
        if len(at):
            yield values[at], values[at + step]
    for start, size in zip(starts[sizes > SMALL], sizes[sizes > SMALL], strict=True):
        yield spanning_links(values[start : start + size])


def _links(limit: int):
    def links(batches):
        for keys, values, cut in _runs(batches, limit):
            if cut:
                yield _link_rows(values, None, keys)
                continue
            parts = list(_group_links(keys, values))
            if parts:
                a, b = (np.concatenate(part) for part in zip(*parts, strict=True))
                pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0)
                yield _link_rows(pairs[:, 0], pairs[:, 1], None)

    return links


def _link_rows(a, b, keys):
    none = pa.nulls(len(a), pa.int64())
    return pa.RecordBatch.from_pydict(
        {
            "a": np.ascontiguousarray(a).view(np.int64),
            "b": none if b is None else np.ascontiguousarray(b).view(np.int64),
            "cut": none if keys is None else keys,
        }
    )


def _met(keyed: DataFrame, *keys: str) -> DataFrame:
    """Deal rows by key and sort them, so that a task sees a key's rows in a run."""
    return keyed.repartition(*keys).sortWithinPartitions("key", "fingerprint")


def similar_links(prints: DataFrame, group: int = GROUP) -> DataFrame:
    """``a, b``: links that connect the distinct fingerprints within the distance."""
    schema = "a long, b long, cut long"
    met = _met(variants(prints), "key").mapInArrow(_links(group), schema)
    found = stored(met, "variants")
    links = found.filter("cut IS NULL").select("a", "b")
    cut = found.filter("cut IS NOT NULL")
    if cut.isEmpty():
        return links
    # the other segment: the first 32 variants blank bits of the low one
    low = F.shiftright("cut", 32) < 32
    found = stored(_met(_dealt(cut, low, BYTES), "key").mapInArrow(_links(group), schema), "pieces")
    links, cut = links.union(found.filter("cut IS NULL").select("a", "b")), found.filter("cut IS NOT NULL")
    if cut.isEmpty():
        return links
    low = F.col("cut").bitwiseAND(F.lit(1)) == 1
    # 5 equal digits leave 12 bits and a blanked one: at most 8,192 fingerprints meet
    split = _met(_dealt(cut, low, DIGITS), "key").mapInArrow(_links(1 << 62), schema)
    return links.union(split.select("a", "b"))


def _dealt(cut: DataFrame, low: Column, masks: list[int]) -> DataFrame:
    """Fingerprints of cut groups under their other segment's bits in each mask.

    The key's last bit tells which segment it was that was blanked.
    """
    segment = F.when(low, F.shiftrightunsigned("a", 32)).otherwise(F.col("a"))
    each = cut.select("a", "cut", low.alias("low"), segment.alias("segment"), F.explode(F.lit(masks)).alias("mask"))
    key = F.xxhash64("cut", "mask", F.col("segment").bitwiseAND(F.col("mask")))
    marked = key.bitwiseAND(F.lit(-2)).bitwiseOR(F.col("low").cast("long"))
    return each.select(marked.alias("key"), F.col("a").alias("fingerprint"))


def near_duplicates(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """``doc_id, fingerprint`` (16 hex digits) and ``component_id`` for each row."""
    prints = stored(document_fingerprints(docs), "fingerprints")
    distinct = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first"))
    distinct = stored(distinct, "distinct")
    names = components(similar_links(distinct.select("fingerprint"), group))
    named = distinct.join(names.toDF("fingerprint", "component"), "fingerprint", "left").select(
        "fingerprint", "first", F.coalesce("component", "fingerprint").alias("component")
    )
    smallest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    of_print = named.join(smallest, "component").select("fingerprint", "component_id")
    return prints.join(of_print, "fingerprint").select(
        "doc_id", hexadecimal("fingerprint").alias("fingerprint"), "component_id"
    )


def hexadecimal(name: str) -> Column:
    return F.lpad(F.lower(F.hex(name)), 16, "0")


def one_of_each(docs: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """The rows of ``docs`` whose id names their group, one row for each group.

    ``groups`` has ``doc_id, component_id`` for each row; by default it is
    ``near_duplicates``. Rows without an id are kept unless a row with an id is in their
    group. Of rows that share an id the one with the smallest text is kept.
    """
    groups = near_duplicates(docs) if groups is None else groups
    kept = groups.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    kept = kept.select(F.col("doc_id").alias("kept_id")).distinct()
    ranked = docs.join(kept, F.col("doc_id").eqNullSafe(F.col("kept_id")), "left_semi")
    repeated = (
        ranked.groupBy("doc_id").count().filter("count > 1 AND doc_id IS NOT NULL").select("doc_id")
    )
    if repeated.isEmpty():
        return ranked
    row = F.struct(*[F.col(f"`{name}`") for name in docs.columns])
    order = F.struct(F.col("text"), F.to_json(row))
    once = ranked.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(
        F.min_by(row, order).alias("_row")
    )
    once = once.select("_row.*")
    return ranked.join(repeated, "doc_id", "left_anti").select(docs.columns).unionByName(
        once.select(docs.columns)
    )
