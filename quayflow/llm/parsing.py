"""Document fingerprints by locally consistent parsing.

A level turns runs of a symbol into one symbol, labels every symbol by deterministic
coin tossing against its left neighbour until few labels are left, and cuts phrases at
the labels' local maxima; phrases are named by a hash of their symbols and are the next
level's symbols. A cut depends on a few symbols around it only, so equal substrings have
equal phrases inside wherever they lie. The names of one level are a document's set of
features; each of ``BINS`` bins keeps the smallest name that falls into it, and the
share of equal bins estimates how alike two documents are.

For edited texts each document needs the next one in id order. Rows are range-partitioned
and sorted by id, text hash and place in the input, so that rows of one id, or without any,
fill several ranges as others do. A range's rows are read in order; its last row and its
first text are set aside, and the last row of each range meets the first text of the next.

Null texts count as empty, with an empty fingerprint (likeness 1 to each other); null
ids come first; equal ids are in the order of their texts' hashes (signed XXH64); of a
single row the next is the row itself; extra columns are ignored; an empty table gives no
rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quayflow.llm.blocks import mix, stored, text_bytes, texts

BINS = 64
LEVEL = 2
RANGE_BYTES = 8 << 20
LEAST_RANGES = 64
SLICE = 1 << 19  # code points parsed at once
SLICE_BYTES = 4 << 20  # text of the rows fingerprinted at once
ROWS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def _tosses() -> np.ndarray:
    """Coin tossing on labels below 128, as a table by (left label, own label)."""
    left, own = np.meshgrid(np.arange(128), np.arange(128), indexing="ij")
    differ = np.where(left == own, 1, left ^ own)
    bit = np.bitwise_count(((differ & -differ) - 1).astype(np.uint64)).astype(np.int64)
    return (2 * bit + (own >> bit & 1)).astype(np.uint8).ravel()


_TOSS = _tosses()


def next_level(symbols: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Phrase names of concatenated documents and where the documents start in them.

    ``starts`` holds the first position of each document; none is empty.
    """
    if not len(symbols):
        return symbols, starts
    first = np.zeros(len(symbols), bool)
    first[starts] = True
    # runs
    change = first.copy()
    change[1:] |= symbols[1:] != symbols[:-1]
    at = np.flatnonzero(change)
    length = np.diff(np.append(at, len(symbols)))
    symbols = symbols[at]
    long = length > 1
    symbols[long] = mix(symbols[long] ^ mix(length[long].astype(np.uint64)))
    first = first[at]
    # labels: twice the lowest bit that differs from the left, plus its value
    differ = np.empty_like(symbols)
    differ[1:] = symbols[1:] ^ symbols[:-1]
    differ[first] = 1
    differ[differ == 0] = 1
    low = differ & (~differ + np.uint64(1))
    bit = np.bitwise_count(low - np.uint64(1))
    label = 2 * bit + ((symbols & low) != 0)
    label = label.astype(np.uint16)
    label[first] = symbols[first] & np.uint64(1)
    for _ in range(3):
        tossed = np.empty_like(label)
        tossed[1:] = _TOSS[(label[:-1] << 7) + label[1:]]
        tossed[first] = label[first] & 1
        label = tossed
    # a phrase starts at each local maximum and at the document's start
    top = np.zeros(len(label), bool)
    top[1:-1] = (label[1:-1] > label[:-2]) & (label[1:-1] >= label[2:])
    top[1:] &= ~first[:-1]
    top[:-1] &= ~first[1:]
    cut = np.flatnonzero(top | first)
    place = np.arange(len(symbols)) - np.repeat(cut, np.diff(np.append(cut, len(symbols))))
    names = np.add.reduceat(mix(symbols ^ mix(place.astype(np.uint64))), cut)
    return mix(names), np.searchsorted(cut, np.flatnonzero(first))


def sketches(values: list[str], level: int = LEVEL) -> np.ndarray:
    """A row of ``BINS`` 16-bit values for each text; 0 marks an empty bin."""
    out = np.zeros((len(values), BINS), np.uint16)
    at = 0
    while at < len(values):
        end, size = at, 0
        while end < len(values) and (end == at or size + len(values[end]) <= SLICE):
            size += len(values[end])
            end += 1
        out[at:end] = _sketch_slice(values[at:end], level)
        at = end
    return out


def _sketch_slice(values: list[str], level: int) -> np.ndarray:
    lengths = np.array([len(v) for v in values], np.int64)
    rows = np.flatnonzero(lengths)
    out = np.zeros((len(values), BINS), np.uint16)
    if not len(rows):
        return out
    coded = "".join(values).encode("utf-32-le")
    symbols = mix(np.frombuffer(coded, np.uint32).astype(np.uint64))
    starts = (np.cumsum(lengths) - lengths)[rows]
    for _ in range(level):
        symbols, starts = next_level(symbols, starts)
    row = np.repeat(rows, np.diff(np.append(starts, len(symbols))))
    names = mix(symbols)
    value = (names >> np.uint64(48)).astype(np.uint16)
    least = np.full(len(values) * BINS, 65535, np.uint16)
    np.minimum.at(least, row * BINS + (names % np.uint64(BINS)).astype(np.int64), np.maximum(value, 1))
    full = np.zeros(len(values) * BINS, bool)
    full[row * BINS + (names % np.uint64(BINS)).astype(np.int64)] = True
    return np.where(full, least, 0).reshape(-1, BINS).astype(np.uint16)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal bins among those that either has; 1 where neither has any."""
    used = ((a > 0) | (b > 0)).sum(1)
    same = ((a == b) & (a > 0)).sum(1)
    return np.where(used > 0, same / np.maximum(used, 1), 1.0)


def _hex(sketch: np.ndarray) -> list[str]:
    return [row.astype(">u2").tobytes().hex() for row in sketch]


def edited_text(text: str, following: str) -> str:
    """The last quarter replaced by as much of the next document's beginning."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def _packed(batches: Iterator[pa.RecordBatch]):
    """Rows with their texts compressed and a hash of each text; ``turn`` tells equal ones apart."""
    compress = zstandard.ZstdCompressor(level=1).compress
    for number, batch in enumerate(batches):
        coded = [text.encode() for text in texts(pa.Table.from_batches([batch])).to_pylist()]
        hashes = np.array([xxhash.xxh64_intdigest(text) for text in coded], np.uint64)
        first = (TaskContext.get().partitionId() << 40) + (number << 20)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(hashes.view(np.int64)),
                pa.array(first + np.arange(len(coded))),
                pa.array([compress(text) for text in coded], pa.binary()),
            ],
            names=["doc_id", "hash", "turn", "body"],
        )


def _result(ids: pa.Array, text: list[str], level: int) -> pa.RecordBatch:
    """Fingerprints of all texts but the last, which only follows."""
    edited = [edited_text(a, b) for a, b in zip(text[:-1], text[1:], strict=True)]
    own, changed = sketches(text, level), sketches(edited, level)
    columns = [
        ids,
        pa.array([len(t) for t in text[:-1]], pa.int64()),
        pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited], pa.string()),
        pa.array(_hex(own[:-1]), pa.string()),
        pa.array(_hex(changed), pa.string()),
        pa.array(likeness(own[:-1], changed)),
        pa.array(likeness(own[:-1], own[1:])),
    ]
    return pa.RecordBatch.from_arrays(columns, names=[name.split()[0] for name in ROWS.split(", ")])


def _in_order(level: int):
    """Fingerprints of a partition's sorted rows; its first text and last row are its border."""

    def in_order(batches):
        expand = zstandard.ZstdDecompressor().decompress
        part = TaskContext.get().partitionId()
        head, last_id, last = None, None, None
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                text, size = [], 0
                begin = at
                while at < batch.num_rows and size < SLICE_BYTES:
                    text.append(expand(batch.column("body")[at].as_py()).decode())
                    size += len(text[-1])
                    at += 1
                ids = batch.column("doc_id").slice(begin, at - begin)
                if last is None:
                    head, known = text[0], ids.slice(0, len(text) - 1)
                else:
                    text = [last, *text]
                    known = pa.concat_arrays([pa.array([last_id], pa.int64()), ids.slice(0, len(ids) - 1)])
                if len(text) > 1:
                    yield _bordered(_result(known, text, level), None, None, None)
                last_id, last = ids[-1].as_py(), text[-1]
        if last is not None:
            empty = pa.RecordBatch.from_pylist([{"doc_id": last_id}], _schema())
            compress = zstandard.ZstdCompressor(level=1).compress
            yield _bordered(empty, part, compress(last.encode()), compress(head.encode()))

    return in_order


def _schema() -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}
    pairs = (column.split() for column in ROWS.split(", "))
    return pa.schema([(name, kinds[kind]) for name, kind in pairs])


def _bordered(rows: pa.RecordBatch, part, last, head) -> pa.RecordBatch:
    n = rows.num_rows
    columns = [
        pa.array([part] * n, pa.int32()),
        pa.array([last] * n, pa.binary()),
        pa.array([head] * n, pa.binary()),
    ]
    names = [*rows.schema.names, "part", "last", "head"]
    return pa.RecordBatch.from_arrays([*rows.columns, *columns], names=names)


def _at_borders(level: int):
    def at_borders(batches):
        expand = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for i in range(batch.num_rows):
                text = [expand(batch.column(c)[i].as_py()).decode() for c in ("last", "head")]
                yield _result(batch.column("doc_id").slice(i, 1), text, level)

    return at_borders


def fingerprints(docs: DataFrame, level: int = LEVEL, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Fingerprints of ``docs(doc_id, text)`` and of their edited texts."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    n = max(LEAST_RANGES, text_bytes(docs) // range_bytes)
    order = [F.col("doc_id").asc_nulls_first(), "hash", "turn"]
    packed = docs.mapInArrow(_packed, "doc_id long, hash long, turn long, body binary")
    ranges = packed.repartitionByRange(n, *order).sortWithinPartitions(*order)
    schema = f"{ROWS}, part int, last binary, head binary"
    found = stored(ranges.select("doc_id", "body").mapInArrow(_in_order(level), schema), "fingerprints")
    # a row for each range: the last row of one is followed by the first text of the next
    ends = found.filter("part IS NOT NULL").select("doc_id", "part", "last", "head")
    place = F.row_number().over(W.orderBy("part")) - 1
    numbered = stored(ends.select("part", place.alias("place")), "ranges")
    n_parts = numbered.count()
    ends = ends.join(numbered, "part")
    following = ends.select(F.pmod(F.col("place") - 1, F.lit(max(1, n_parts))).alias("place"), "head")
    pairs = ends.select("doc_id", "last", "place").join(following, "place")
    borders = pairs.select("doc_id", "last", "head").mapInArrow(_at_borders(level), ROWS)
    return found.filter("part IS NULL").drop("part", "last", "head").union(borders)
