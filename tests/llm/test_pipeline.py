"""The pipeline on a small table, stage by stage against plain versions."""

from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from test_simhash import expected as simhash_groups
from test_suffixes import brute_phrases

import corpus_pipeline
from quayflow.llm import mixing, ordinal
from quayflow.llm.blocks import read_documents


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    """What each stage returned, written and read again."""
    docs = read_documents(spark, sf_dir)
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, out[-1], sf_dir).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def rows(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_columns_stay(stages):
    assert all(s.columns == stages[0].columns for s in stages[:-1])
    assert [s.dtypes for s in stages[:-1]] == [stages[0].dtypes] * 5


def test_quality(spark, sf_dir, stages):
    grades = ordinal.label_grades(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    model = ordinal.fit_ordinal(stages[0], grades)
    scored = ordinal.with_grades(stages[0], model).collect()
    kept = {r.doc_id for r in scored if r.tail_probability >= 0.5}
    assert {i for i, _ in rows(stages[1])} == kept
    grade = {r.doc_id: r.grade for r in grades.collect()}
    clean = [i for i, g in grade.items() if g == 2]
    assert np.mean([i in kept for i in clean]) > 0.98


def test_near_duplicates(stages):
    groups = simhash_groups(rows(stages[1]))
    assert sorted(i for i, _ in rows(stages[2])) == sorted({c for _, _, c in groups})


def test_repeated_passages(stages):
    before = {i: (text or "").encode() for i, text in rows(stages[2])}
    gone = dict(brute_phrases(rows(stages[2]), 51))
    for row in stages[3].collect():
        size = len(before[row.doc_id]) - gone[row.doc_id]
        # characters that a passage cuts in two are left out
        assert size - 8 <= len(row.text.encode()) <= size
        assert row.n_chars == len(row.text)


def test_mixing(spark, sf_dir, stages):
    mixed = mixing.mix(stages[3], spark.read.parquet(f"{sf_dir}/labels.parquet"))
    want = {r.doc_id: r.copies for r in mixed.collect() if r.copies}
    assert Counter(i for i, _ in rows(stages[4])) == want


def test_segmentation(stages):
    model = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = dict(rows(stages[4]))
    found = stages[5].collect()
    copies = Counter(i for i, _ in rows(stages[4]))
    assert Counter(r.doc_id for r in found if r.sample == 1) == copies
    for r in found:
        assert model.decode(np.frombuffer(r.pieces, np.uint16).tolist()) == texts[r.doc_id]


def test_run_equals_the_stages(spark, sf_dir, stages):
    key = lambda df: Counter((r.doc_id, r.sample, bytes(r.pieces)) for r in df.collect())
    assert key(corpus_pipeline.run(spark, sf_dir)) == key(stages[5])


@pytest.mark.parametrize("empty", [False, True])
def test_odd_rows_and_clashing_columns(spark, sf_dir, tmp_path, empty):
    """Names that the operators use inside are ordinary columns here."""
    extra = ["kept", "size", "key", "tie", "copies", "taken", "repeats", "component_id", "sample", "block"]
    rows = [
        (1, None, None, "s", None),
        (2, "", "en", None, 0),
        (3, "one two three", "en", "s", 13),
        (3, "one two three", "en", "s", 13),
        (None, "no id here", "en", "s", 10),
        (5, "w " * 30_000, "en", "t", 60_000),
        (6, " ".join(f"word{i * i % 997}" for i in range(400)), "en", "t", 9),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(rows[: 0 if empty else None], schema)
    for name in extra:
        docs = docs.withColumn(name, F.concat(F.lit(f"{name}:"), F.coalesce("text", F.lit("-"))))
    out = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, out, sf_dir)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        out.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        before = {(r.doc_id, *(r[n] for n in extra)) for r in docs.collect()}
        assert {(r.doc_id, *(r[n] for n in extra)) for r in out.collect()} <= before
    last = corpus_pipeline.segmented(spark, out, sf_dir)
    assert (last.count() == 0) is empty
