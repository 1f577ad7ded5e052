"""One query for each operator, over whole tables, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayflow.llm import cover_tree, crf, filter_audit, line_dedup, mixing, ngram_lm, ordinal, parsing
from quayflow.llm import sampling, simhash, suffixes, token_counts, vector_codes
from quayflow.llm.blocks import read_documents, remainder


def read_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def op1_katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.katz_scores(ngram_lm.held_out_mark(read_documents(spark, sf_dir)), order=2)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return token_counts.token_counts(read_documents(spark, sf_dir), path, limit=2048)


def op3_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, expected_grade, tail_probability, kept``; learnt from all labelled rows."""
    docs = read_documents(spark, sf_dir).select("doc_id", "text")
    grades = ordinal.label_grades(read_labels(spark, sf_dir))
    graded = ordinal.with_grades(docs, ordinal.fit_ordinal(docs, grades))
    return ordinal.selected(graded).drop("text")


def op4_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_documents(spark, sf_dir))


def op5_parsed_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsing.fingerprints(read_documents(spark, sf_dir))


def op6_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.repeat_digest(read_documents(spark, sf_dir))


def op7_sampled_segmentations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two segmentations of each text with a digest of their pieces, decoded again."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    found = sampling.sampled_segmentations(read_documents(spark, sf_dir), path, k=2, decode=True)
    return found.select(
        "doc_id",
        "sample",
        "n_pieces",
        "log_prob",
        "perturbed",
        "log_inclusion",
        F.sha2("pieces", 256).alias("pieces_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), cosine=0.98)


def op9_mixed_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_documents(spark, sf_dir), read_labels(spark, sf_dir))


def op10_toxic_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a field fitted to the labels not held out."""
    docs = read_documents(spark, sf_dir).select("doc_id", "text")
    labels = read_labels(spark, sf_dir).filter(remainder("doc_id") != 0)
    scored = crf.toxicity(docs, crf.fit_crf(docs, labels))
    return scored.select(
        "doc_id",
        (remainder("doc_id") == 0).alias("held_out"),
        "score",
        "predicted",
        "n_toxic",
        F.size("spans").alias("n_spans"),
    )


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.code_digest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    masks = filter_audit.document_masks(read_documents(spark, sf_dir), read_labels(spark, sf_dir))
    return filter_audit.audit(masks, "ABCDE")


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_digest(read_documents(spark, sf_dir))


QUERIES = {
    query.__name__: query
    for query in (
        op1_katz_scores,
        op2_token_counts,
        op3_ordinal_quality,
        op4_simhash_groups,
        op5_parsed_fingerprints,
        op6_repeated_passages,
        op7_sampled_segmentations,
        op8_near_vectors,
        op9_mixed_sources,
        op10_toxic_spans,
        op11_vector_codes,
        op12_filter_audit,
        op13_line_dedup,
    )
}

# DuckDB SQL of the queries that SQL can express.
ORACLE_SQL = {
    "op9_mixed_sources": mixing.MIX_SQL,
    "op11_vector_codes": vector_codes.CODES_SQL,
    "op12_filter_audit": filter_audit.AUDIT_SQL,
    "op13_line_dedup": line_dedup.LINES_SQL,
}
