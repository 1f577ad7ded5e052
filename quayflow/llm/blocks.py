"""Blocks of whole documents inside tasks, packed messages and stored tables.

A block is a run of consecutive rows of one task with a bounded sum of text bytes
(one longer document is a block of its own), so a task's memory does not depend on
the size of its partition.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayflow.session import scratch_path

BLOCK_BYTES = 16 << 20


def blocks(
    batches: Iterator[pa.RecordBatch], column: str = "text", size: int = BLOCK_BYTES
) -> Iterator[pa.Table]:
    """Cut and join Arrow batches into tables of about ``size`` bytes of ``column``."""
    held: list[pa.RecordBatch] = []
    held_bytes = 0
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(False)
        ends = np.cumsum(lengths, dtype=np.int64)
        start = done = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(ends, done + size - held_bytes, "right"))
            if end <= start and not held:
                end = start + 1
            if end > start:
                held.append(batch.slice(start, end - start))
                held_bytes += int(ends[end - 1]) - done
                start, done = end, int(ends[end - 1])
            if start < batch.num_rows:
                yield pa.Table.from_batches(held)
                held, held_bytes = [], 0
    if held:
        yield pa.Table.from_batches(held)


def column(table: pa.Table, name: str) -> pa.Array:
    """One contiguous array of a block's column."""
    values = table.column(name).combine_chunks()
    if isinstance(values, pa.ChunkedArray):
        values = pa.concat_arrays(values.chunks) if values.num_chunks else pa.array([], values.type)
    return values


def texts(table: pa.Table, name: str = "text", lower: bool = False) -> pa.Array:
    """Texts without nulls (null: empty), A-Z lower-cased on request."""
    values = pc.fill_null(column(table, name), "")
    return pc.ascii_lower(values) if lower else values


def words(values: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words between ASCII white space: local numbers, document offsets, distinct words."""
    lists = pc.ascii_split_whitespace(values)
    offsets = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.values.slice(int(offsets[0]), int(offsets[-1] - offsets[0]))
    coded = flat.dictionary_encode()
    ids = coded.indices.to_numpy(False)
    offsets -= offsets[0]
    empty = pc.index(coded.dictionary, pa.scalar("", coded.dictionary.type)).as_py()
    if empty >= 0:
        keep = ids != empty
        offsets = np.concatenate([[0], np.cumsum(keep)])[offsets]
        ids = ids[keep]
    return ids, offsets, coded.dictionary


def runs(sorted_values: np.ndarray):
    """Each distinct value of a sorted array with the bounds of its run."""
    values, starts = np.unique(sorted_values, return_index=True)
    ends = np.append(starts[1:], len(sorted_values))
    return zip(values.tolist(), starts.tolist(), ends.tolist(), strict=False)


def segment_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of each document's values; documents without any give zero."""
    sums = np.concatenate([[0], np.cumsum(values)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def mix(values: np.ndarray) -> np.ndarray:
    """Well-spread 64-bit hash of 64-bit numbers (the splitmix64 finaliser)."""
    x = values.astype(np.uint64, copy=True)
    x += np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed message; bytes of equal weight lie together."""
    head = json.dumps([[a.dtype.str, int(a.size)] for a in arrays]).encode()
    parts = [len(head).to_bytes(4, "little"), head]
    for a in arrays:
        planes = np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.itemsize)
        parts.append(np.ascontiguousarray(planes.T).tobytes())
    return zstandard.compress(b"".join(parts), 1)


def unpack(message: bytes) -> list[np.ndarray]:
    data = zstandard.decompress(message)
    head = int.from_bytes(data[:4], "little")
    at, out = 4 + head, []
    for kind, size in json.loads(data[4:at]):
        width = np.dtype(kind).itemsize
        planes = np.frombuffer(data, np.uint8, size * width, at).reshape(width, size)
        out.append(np.ascontiguousarray(planes.T).view(kind).reshape(size))
        at += size * width
    return out


def stored(df: DataFrame, name: str, *partitions: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.partitionBy(*partitions).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_by(df: DataFrame, name: str, key: str, n_buckets: int) -> DataFrame:
    """Like ``stored``, bucketed by ``key``: grouping by it later moves none of these rows.

    Beyond ``spark.sql.sources.bucketing.maxBuckets`` a bucket gets more rows instead.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    table = path.rpartition("/")[2].replace("-", "_")
    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets", "100000"))
    df.write.bucketBy(min(n_buckets, most), key).format("parquet").saveAsTable(table, path=path)
    rows = spark.table(table)
    spark.sql(f"DROP TABLE {table}")  # the name only: what was read keeps its files and buckets
    return rows


def text_bytes(docs: DataFrame) -> int:
    """UTF-8 bytes of all texts."""
    total = F.sum(F.octet_length("text").cast("bigint")).alias("total")
    return docs.agg(total).first()["total"] or 0


def remainder(column: Column | str) -> Column:
    """crc32 of the id's decimal text modulo 5; the null id counts as the empty text."""
    text = F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(None))
    return F.crc32(F.coalesce(text.cast("string"), F.lit("")).cast("binary")) % 5


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
