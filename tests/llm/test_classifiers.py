"""Ordinal grades and toxic spans: recursions by enumeration, learning by held-out accuracy."""

import itertools
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from quayflow.llm import crf, ordinal
from quayflow.llm.blocks import read_documents, remainder

SCHEMA = "doc_id long, text string, score string, weights int"
ODD = [(1, None), (2, ""), (3, " \t"), (None, "a b"), (5, "x" * 40_000), (5, "w " * 40_000), (5, "w " * 40_000)]


def odd_rows(spark):
    return spark.createDataFrame([(i, t, "s", 1) for i, t in ODD], SCHEMA)


def graded_texts(n, seed=0):
    generator = np.random.default_rng(seed)
    grades = generator.integers(0, 3, n)
    words = [["bad!!", "BAD", "poor"], ["fair", "plain", "usual"], ["good", "fine", "clear"]]
    texts = []
    for g in grades:
        picks = [words[g if generator.random() < 0.6 else generator.integers(3)] for _ in range(30)]
        texts.append(" ".join(p[generator.integers(3)] for p in picks))
    return texts, grades


def test_ordinal_gradient_reaches_accuracy_and_order():
    texts, grades = graded_texts(400)
    model = ordinal.fit_grades(pa.array(texts), grades)
    assert len(model.thresholds) == 2 and model.thresholds[0] < model.thresholds[1]
    held, truth = graded_texts(200, seed=1)
    row, slot, value = ordinal._matrix(pa.array(held))
    score = np.bincount(row, weights=value * model.weights[slot], minlength=len(held))
    guess = sum((score > t).astype(int) for t in model.thresholds)
    assert (guess == truth).mean() > 0.9


def test_ordinal_frames(spark):
    texts, grades = graded_texts(200)
    docs = spark.createDataFrame([(i, t, "s", 1) for i, t in enumerate(texts)], SCHEMA)
    labels = spark.createDataFrame([(i, int(g)) for i, g in enumerate(grades)], "doc_id long, grade int")
    model = ordinal.fit_ordinal(docs, labels)
    again = ordinal.fit_ordinal(docs.repartition(5), labels.union(labels))
    assert model.thresholds == again.thresholds and (model.weights == again.weights).all()
    rows = ordinal.selected(ordinal.with_grades(docs, model)).collect()
    assert rows[0].score == "s" and len(rows) == 200
    guess = np.array([r.expected_grade for r in sorted(rows, key=lambda r: r.doc_id)])
    assert np.abs(guess - grades).mean() < 0.4
    odd = ordinal.with_grades(odd_rows(spark), model).collect()
    assert len(odd) == len(ODD)
    assert len({r.expected_grade for r in odd if not (r.text or "").strip()}) == 1
    assert all(0 <= r.tail_probability <= 1 for r in odd)


def test_ordinal_without_labels_or_rows(spark):
    docs = odd_rows(spark)
    none = spark.createDataFrame([], "doc_id long, grade int")
    model = ordinal.fit_ordinal(docs, none)
    assert {r.expected_grade for r in ordinal.with_grades(docs, model).collect()} == {0.0}
    one = spark.createDataFrame([(3, 1), (None, 0), (5, 1)], "doc_id long, grade int")
    model = ordinal.fit_ordinal(docs, one)
    assert {r.expected_grade for r in ordinal.with_grades(docs, model).collect()} == {1.0}
    assert ordinal.with_grades(docs.limit(0), model).count() == 0


def test_quality_of_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = read_documents(spark, sf_dir)
    grades = ordinal.label_grades(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    model = ordinal.fit_ordinal(docs, grades.filter(remainder("doc_id") != 0))
    graded = ordinal.selected(ordinal.with_grades(docs, model)).join(grades, "doc_id")
    rows = graded.filter(remainder("doc_id") == 0).collect()
    assert np.mean([r.kept == (r.grade > 0) for r in rows]) > 0.97


@pytest.mark.parametrize("length", [1, 3, None])
def test_marginals_equal_enumeration(monkeypatch, length):
    generator = np.random.default_rng(5)
    offsets = np.array([0, 4, 4, 5, 10])
    scores, transitions = generator.normal(size=10) * 2, generator.normal(size=(2, 2))
    chain = crf.Chain(offsets)
    if length:
        monkeypatch.setattr(crf.np, "sqrt", lambda x: length)
        chain = crf.Chain(offsets)
        monkeypatch.undo()
    chance, pairs = chain.marginals(scores, transitions)
    want, want_pairs = np.zeros(10), np.zeros((2, 2))
    for a, b in itertools.pairwise(offsets):
        total = 0.0
        own, own_pairs = np.zeros(b - a), np.zeros((2, 2))
        for states in itertools.product((0, 1), repeat=b - a):
            weight = np.exp(
                sum(scores[a + i] * s for i, s in enumerate(states))
                + sum(transitions[p] for p in itertools.pairwise(states))
            )
            total += weight
            own += weight * np.array(states)
            for p in itertools.pairwise(states):
                own_pairs[p] += weight
        if b > a:
            want[a:b] = own / total
            want_pairs += own_pairs / total
    assert chance == pytest.approx(want)
    assert pairs == pytest.approx(want_pairs)


def test_toxic_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = read_documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = crf.fit_crf(docs, labels.filter(remainder("doc_id") != 0))
    rows = crf.toxicity(docs, model).join(labels, "doc_id").filter(remainder("doc_id") == 0).collect()
    assert np.mean([r.predicted == r.toxic for r in rows]) > 0.9
    text = {r.doc_id: r.text for r in docs.collect()}
    found = {text[r.doc_id][s.start : s.end].strip(".,").lower() for r in rows for s in r.spans}
    assert "idiot" in found
    again = crf.fit_crf(docs.repartition(5), labels.filter(remainder("doc_id") != 0))
    assert again == model


def test_toxicity_of_odd_rows(spark):
    docs = odd_rows(spark)
    labels = spark.createDataFrame([(5, 1), (3, 0), (3, 0), (None, 1)], "doc_id long, toxic int")
    rows = crf.toxicity(docs, crf.fit_crf(docs, labels)).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2, 3)}) == 1
    none = crf.fit_crf(docs, labels.limit(0))
    assert {r.predicted for r in crf.toxicity(docs, none).collect()} == {0}
    every = crf.fit_crf(docs, labels.filter("toxic = 1"))
    assert {r.predicted for r in crf.toxicity(docs, every).collect()} == {1}
    assert crf.toxicity(docs.limit(0), none).count() == 0


def test_one_long_text_does_not_end_the_fit(monkeypatch):
    values = [f"good day number{i} " * 5 + ("awfulword here" if i % 2 else "fine here") for i in range(60)]
    labels = np.array([i % 2 for i in range(60)])
    monkeypatch.setattr(crf, "FIT_PART", 20_000)
    long = "calm words " * 5_000
    model = crf.fit_field(pa.array([long, *values]), np.append(0, labels))
    assert any(abs(weight) > 0.5 for weight in model.weights.values())
    odds = crf.document_evidence(model, pa.array(values))[0]
    assert odds[labels == 1].min() > odds[labels == 0].max()


def test_every_labelled_document_counts_in_the_fit(monkeypatch):
    """The fit is the same in however many parts it is made."""
    values = pa.array([f"calm day {i % 7} " * (1 + i % 9) + ("awfulword here" if i % 3 == 0 else "fine") for i in range(90)])
    labels = np.array([int(i % 3 == 0) for i in range(90)])
    whole = crf.fit_field(values, labels)
    monkeypatch.setattr(crf, "FIT_PART", 300)
    cut = crf.fit_field(values, labels)
    assert cut.weights == pytest.approx(whole.weights) and cut.bias == pytest.approx(whole.bias)
    assert cut.transitions == pytest.approx(whole.transitions)


def test_scores_equal_a_plain_recursion(spark, sf_dir):
    """Scores of a whole table from the model's numbers, document by document."""
    docs = read_documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = crf.fit_crf(docs, labels)
    a = np.exp(np.array(model.transitions).reshape(2, 2))
    want = {}
    for row in docs.select("doc_id", "text").collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", row.text or "")
        weight = [np.array([1.0, np.exp(model.bias + sum(model.weights.get(f, 0.0) for f in crf.token_features(w)))]) for w in words]
        forward, chances = [], []
        for i, w in enumerate(weight):
            f = w if i == 0 else (forward[-1] @ a) * w
            forward.append(f / f.sum())
        back = np.ones(2)
        for i in range(len(words) - 1, -1, -1):
            both = forward[i] * back
            chances.append(both[1] / both.sum())
            back = a @ (weight[i] * back)
            back /= back.sum()
        none = min(sum(np.log1p(-min(c, 1 - 1e-12)) for c in chances), 0.0)
        odds = np.log(max(-np.expm1(none), 1e-6)) - max(none, -12)
        want[row.doc_id] = 1 / (1 + np.exp(-np.clip(model.slope * odds + model.offset, -50, 50)))
    scored = crf.toxicity(docs, model).collect()
    assert {r.doc_id: r.score for r in scored} == pytest.approx(want, abs=1e-6)
    assert all(r.predicted == (r.score >= 0.5) for r in scored)


def plain_score(text, model):
    """Mean weight of a text's words, their shapes, ends and repeats, word by word."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    total = 0.0
    for i, word in enumerate(words):
        for name in ordinal.word_features(word):
            total += model.weights[xxhash.xxh64_intdigest(name) % ordinal.DIMENSIONS]
        if i and word == words[i - 1]:
            total += model.weights[ordinal.DIMENSIONS]
    return total / max(1, len(words))


def test_grades_equal_a_plain_computation(spark, sf_dir):
    """Expected grades and tails of a whole table from the model's numbers; the likelihood of
    the labels, added up document by document, is well above that of the base rates."""
    docs = read_documents(spark, sf_dir)
    grades = ordinal.label_grades(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    model = ordinal.fit_ordinal(docs, grades)
    tails = {}
    for row in docs.select("doc_id", "text").collect():
        score = plain_score(row.text, model)
        tails[row.doc_id] = [1 / (1 + np.exp(t - score)) for t in model.thresholds]
    graded = ordinal.selected(ordinal.with_grades(docs, model)).collect()
    assert {r.doc_id: r.tail_probability for r in graded} == pytest.approx({i: t[0] for i, t in tails.items()}, abs=1e-9)
    want = {i: model.lowest + sum(t) for i, t in tails.items()}
    assert {r.doc_id: r.expected_grade for r in graded} == pytest.approx(want, abs=1e-9)
    assert all(r.kept == (r.tail_probability >= 0.5) for r in graded)
    known = [(r.doc_id, r.grade) for r in grades.filter("grade IS NOT NULL").collect()]
    chance = lambda t, g: ([1.0, *t, 0.0][g] - [1.0, *t, 0.0][g + 1])
    fitted = np.mean([np.log(max(chance(tails[i], g), 1e-12)) for i, g in known])
    share = np.bincount([g for _, g in known]) / len(known)
    assert fitted > sum(p * np.log(p) for p in share if p) / 2
