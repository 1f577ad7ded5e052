"""Documents to training data: stages written as Parquet one after the other.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before left;
all but the last return the columns of ``documents``. Further columns stay as they are
under any name, since the row travels through a stage as one struct; only ``text`` and
``n_chars`` change, where passages are removed. Texts that are null or without words are
near copies of each other, all of fingerprint zero, of which one stays; the first stage
judges them by the grades' base rates and the other stages as any other text. Rows without
an id are kept unless they are near copies of one with an id; rows that share an id are one
document, of which near_duplicates keeps the row with the smallest text. A text of any
length is worked on whole; a task that segments it needs memory in proportion to it. Empty
tables stay empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayflow.llm import mixing, ordinal, sampling, simhash, suffixes
from quayflow.llm.blocks import read_documents
from quayflow.session import scratch_path


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def _whole(docs: DataFrame, *names: str) -> DataFrame:
    """The columns a stage works on, and the whole row aside as ``_row``."""
    row = F.struct(*[F.col(f"`{name}`") for name in docs.columns])
    return docs.select(row.alias("_row"), *names)


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose chance of a grade above the lowest reaches one half."""
    model = ordinal.fit_ordinal(docs, ordinal.label_grades(_labels(spark, sf_dir)))
    graded = ordinal.selected(ordinal.with_grades(_whole(docs, "text"), model))
    return graded.filter("kept").select("_row.*")


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by fingerprints of at most three differing bits."""
    return simhash.one_of_each(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of over 50 words, or 400 bytes, that occur elsewhere."""
    others = [F.col(f"`{n}`") for n in docs.columns if n not in ("text", "n_chars")]
    cut = suffixes.remove_repeats(docs.select("text", F.struct(*others).alias("_row")), phrase=51)
    rows = cut.select("_row.*", "text", F.length("text").cast("long").alias("n_chars"))
    return rows.select([F.col(f"`{name}`") for name in docs.columns])


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    rows = _whole(docs, "doc_id", "text", "source")
    rows = mixing.mixed_rows(mixing.keyed(rows, _labels(spark, sf_dir), keep_text=False))
    taken = rows.filter("copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return taken.select("_row.*")


def segmented(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two sampled segmentations of each document."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    # small blocks, as executors still hold memory of the stages before
    return sampling.sampled_segmentations(docs, path, k=2, block_bytes=1 << 20)


STAGES = [
    ("quality", good_documents),
    ("near_duplicates", distinct_documents),
    ("repeated_passages", without_repeats),
    ("mixing", mixed_sources),
    ("segmentation", segmented),
]

# No stage but the mixing can be expressed in SQL; the tests compare run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents table; each reads what the one before wrote."""
    docs = read_documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
