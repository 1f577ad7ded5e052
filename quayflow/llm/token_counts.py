"""Tokens of each document, counting the pieces of each distinct pre-token once.

The tokenizer works on words between ASCII white space independently, so such a word
is the pre-token here. A block asks for each of its distinct pre-tokens once, the
buckets of pre-tokens count pieces with the tokenizer library, and the block joins
the answers to its per-document frequencies and sums; no ids are kept anywhere.

Null texts count as empty (no tokens); a null ``doc_id`` stays null; repeated rows
give a row each; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayflow.llm.blocks import blocks, column, pack, runs, segment_sums, stored, text_bytes, texts
from quayflow.llm.blocks import unpack, words

MESSAGE = "kind string, block string, bucket int, message binary"
ROWS = "doc_id long, n_bytes long, n_tokens long"
BUCKET_BYTES = 4 << 20
LEAST_BUCKETS = 64


def bucket_count(docs: DataFrame) -> int:
    """Buckets of words, in proportion to the texts."""
    return max(LEAST_BUCKETS, text_bytes(docs) // BUCKET_BYTES)


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def piece_counts(pretokens: list[str], path: str) -> list[int]:
    encodings = _tokenizer(path).encode_batch_fast(pretokens, add_special_tokens=False)
    return [len(encoding.ids) for encoding in encodings]


def _split(n_buckets: int):
    def split(batches):
        for number, table in enumerate(blocks(batches)):
            block = f"{TaskContext.get().partitionId()}-{number}"
            text = texts(table)
            ids, offsets, distinct = words(text)
            by_name = pc.sort_indices(distinct).to_numpy()
            named = distinct.take(pa.array(by_name))
            bucket = np.fromiter(
                (xxhash.xxh64_intdigest(w) % n_buckets for w in named.to_pylist()),
                np.int32,
                len(named),
            )
            order = np.argsort(bucket, kind="stable")
            number_of = np.empty(len(distinct), np.int64)
            number_of[by_name[order]] = np.arange(len(distinct))
            doc = np.repeat(np.arange(table.num_rows), np.diff(offsets))
            bag, times = np.unique(
                doc * max(1, len(distinct)) + number_of[ids], return_counts=True
            )
            bag_doc, bag_id = np.divmod(bag, max(1, len(distinct)))
            doc_ids = column(table, "doc_id")
            message = pack(
                pc.fill_null(doc_ids, 0).to_numpy(False),
                doc_ids.is_null().to_numpy(False),
                pc.binary_length(text).to_numpy().astype(np.int64),
                np.bincount(bag_doc, minlength=table.num_rows).astype(np.int32),
                np.diff(bag_id, prepend=0).astype(np.int32),
                times.astype(np.int32),
            )
            rows = [("text", block, -1, message)]
            asked = named.take(pa.array(order))
            for b, first, last in runs(bucket[order]):
                coded = [word.encode() for word in asked.slice(first, last - first).to_pylist()]
                lengths = np.array([len(word) for word in coded], np.int32)
                joined = np.frombuffer(b"".join(coded), np.uint8)
                rows.append(("ask", block, b, pack(lengths, joined)))
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("kind", "block", "bucket", "message"), row, strict=True)) for row in rows],
                pa.schema(
                    [("kind", pa.string()), ("block", pa.string()), ("bucket", pa.int32()),
                     ("message", pa.binary())]
                ),
            )

    return split


def _strings(message: bytes) -> list[str]:
    lengths, joined = unpack(message)
    data, ends = joined.tobytes(), np.cumsum(lengths)
    return [data[e - n : e].decode() for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]


def _count(path: str):
    def count(table: pa.Table) -> pa.Table:
        asked = [_strings(message.as_py()) for message in table.column("message")]
        distinct = list(dict.fromkeys(word for part in asked for word in part))
        pieces = dict(zip(distinct, piece_counts(distinct, path), strict=True))
        answers = [pack(np.array([pieces[word] for word in part], np.int32)) for part in asked]
        return pa.table(
            {
                "block": table.column("block"),
                "bucket": table.column("bucket"),
                "message": pa.array(answers, pa.binary()),
            }
        )

    return count


def _total(table: pa.Table) -> pa.Table:
    order = np.argsort(table.column("bucket").to_numpy(), kind="stable").tolist()
    first, *rest = (table.column("message")[i].as_py() for i in order)
    ids, null, n_bytes, distinct, steps, times = unpack(first)
    counts = np.concatenate([np.zeros(0, np.int32), *(unpack(m)[0] for m in rest)])
    ends = np.concatenate([[0], np.cumsum(distinct)])
    # steps run through the documents: a running sum gives the numbers back
    per_word = counts[np.cumsum(steps)] if len(steps) else counts[:0]
    n_tokens = segment_sums(per_word.astype(np.int64) * times, ends)
    return pa.table(
        {
            "doc_id": pa.array(ids, pa.int64(), mask=null),
            "n_bytes": pa.array(n_bytes, pa.int64()),
            "n_tokens": pa.array(n_tokens, pa.int64()),
        }
    )


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 2048) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for each row of ``docs(doc_id, text)``.

    ``tokenizer_path`` names a tokenizers file on every machine.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    messages = stored(docs.mapInArrow(_split(bucket_count(docs)), MESSAGE), "pieces", "kind")
    answers = (
        messages.filter(F.col("kind") == "ask")
        .groupBy("bucket")
        .applyInArrow(_count(tokenizer_path), "block string, bucket int, message binary")
    )
    return (
        messages.filter(F.col("kind") == "text")
        .select("block", "bucket", "message")
        .unionByName(answers)
        .groupBy("block")
        .applyInArrow(_total, ROWS)
        .withColumn("over_limit", F.col("n_tokens") > limit)
    )
