"""Stored blocks where Spark allows few buckets."""

import public_tokenizers
import pytest
from test_suffixes import ROWS, SCHEMA, brute
from test_suffixes import got as digest

from quayflow.llm import ngram_lm, token_counts


@pytest.fixture
def few_buckets(spark):
    key = "spark.sql.sources.bucketing.maxBuckets"
    before = spark.conf.get(key)
    spark.conf.set(key, "2")
    yield
    spark.conf.set(key, before)


def frame(spark):
    return spark.createDataFrame([(i, t, 0, "") for i, t in ROWS], SCHEMA).repartition(5)


def scores(spark):
    marked = ngram_lm.held_out_mark(frame(spark).select("doc_id", "text"))
    rows = ngram_lm.katz_scores(marked, order=2, block_bytes=2000).collect()
    return sorted(((r.doc_id, r.n_tokens, r.n_known, round(r.score, 6)) for r in rows), key=str)


def test_scores_do_not_depend_on_the_buckets(spark, request):
    want = scores(spark)
    request.getfixturevalue("few_buckets")
    assert scores(spark) == want


def test_passages_beyond_the_largest_number_of_buckets(spark, few_buckets):
    assert digest(frame(spark)) == brute(ROWS)


def test_counts_beyond_the_largest_number_of_buckets(spark, few_buckets):
    path = public_tokenizers.path("word_bpe_49k.json")
    assert token_counts.token_counts(frame(spark), path).count() == len(ROWS)


def test_stored_tables_leave_no_name_behind(spark):
    before = {t.name for t in spark.catalog.listTables()}
    digest(frame(spark))
    assert {t.name for t in spark.catalog.listTables()} == before
