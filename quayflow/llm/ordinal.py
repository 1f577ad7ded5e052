"""Ordinal regression on graded documents: one hashed-text score, ordered thresholds.

A document's score is the mean over its words of shared hashed weights; the chance of
grade k or more is ``sigmoid(score - threshold_k)`` with increasing thresholds. Words
count by their lower-cased form, their shape, their ends and whether they repeat the
word before, and weigh the more the more often they occur.

The model is fitted in one task on at most ``FIT_ROWS`` labelled documents, those whose
ids hash lowest, which bounds its memory whatever the input; its weights, a fixed
number, are all that reaches the driver. All documents are then scored.

Null and empty texts have score 0, the grades' base rates; null ids are kept; repeated
rows are scored alike; extra columns are kept; empty tables give no rows. Without two
grades among the labels every document gets the one grade known, or the lowest.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayflow.llm.blocks import column, texts, words

FIT_ROWS = 4000
LEAST_TAIL = 0.5
DIMENSIONS = 1 << 16
RIDGE = 2e-4
STEPS = 60
SLICE = 8 << 20

_CLASSES = ((re.compile(r"[^\W\d_]+"), ""), (re.compile(r"\d+"), "9"))


@dataclass(frozen=True)
class OrdinalModel:
    """``weights`` of hashed features and ``thresholds`` of the grades above the lowest."""

    weights: np.ndarray
    thresholds: tuple[float, ...]
    lowest: int = 0


def word_features(word: str) -> tuple[str, ...]:
    """The word, its shape (letters by case, digits, signs) and its last two characters."""
    letters = "A" if word.isupper() and len(word) > 1 else "a"
    shape = _CLASSES[1][0].sub("9", _CLASSES[0][0].sub(letters, word))
    return "w" + word.lower(), "s" + shape, "e" + word[-2:]


def _slots(distinct: list[str]) -> np.ndarray:
    """Hashed features of each word, a row of slots."""
    hashed = xxhash.xxh64_intdigest
    flat = [hashed(f) % DIMENSIONS for word in distinct for f in word_features(word)]
    return np.array(flat, np.int64).reshape(-1, 3)


def _repeats(ids: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether a word is that before it in its document."""
    same = np.zeros(len(ids), bool)
    same[1:] = ids[1:] == ids[:-1]
    same[offsets[:-1][np.diff(offsets) > 0]] = False
    return same


def _matrix(values: pa.Array):
    """Documents' features as sparse rows: row, slot, value."""
    ids, offsets, distinct = words(values)
    slots = _slots(distinct.to_pylist())
    lengths = np.diff(offsets)
    doc = np.repeat(np.arange(len(lengths)), lengths)
    key = (doc[:, None] * np.int64(DIMENSIONS + 1) + slots[ids]).ravel()
    again = doc[_repeats(ids, offsets)] * np.int64(DIMENSIONS + 1) + DIMENSIONS
    key, times = np.unique(np.concatenate([key, again]), return_counts=True)
    row, slot = np.divmod(key, DIMENSIONS + 1)
    return row, slot, times / np.maximum(1, lengths)[row]


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def fit_grades(values: pa.Array, grades: np.ndarray) -> OrdinalModel:
    """Maximum likelihood with a ridge on the weights, by full-batch Adam steps."""
    known, grade = np.unique(grades, return_inverse=True)
    if len(known) < 2:
        return OrdinalModel(np.zeros(DIMENSIONS + 1), (), int(known[0]) if len(known) else 0)
    lowest, top = int(known[0]), int(known[-1] - known[0])
    grade = grades - lowest
    row, slot, value = _matrix(values)
    used, slot = np.unique(slot, return_inverse=True)
    value = value * 10  # steps of like size for words and thresholds
    share = np.array([np.mean(grade >= k) for k in range(1, top + 1)])
    start = -np.log(np.clip(share, 1e-6, 1 - 1e-6) / np.clip(1 - share, 1e-6, 1))
    # first threshold and logarithms of the distances of the next ones
    parameters = np.concatenate(
        [np.zeros(len(used)), start[:1], np.log(np.maximum(np.diff(start), 1e-3))]
    )
    first = second = np.zeros_like(parameters)
    n = len(grade)
    for step in range(1, STEPS + 1):
        weights, bounds = parameters[: len(used)], parameters[len(used) :]
        thresholds = np.cumsum(np.concatenate([bounds[:1], np.exp(bounds[1:])]))
        score = np.bincount(row, weights=value * weights[slot], minlength=n)
        edges = np.concatenate([[-np.inf], thresholds, [np.inf]])
        below, above = _sigmoid(edges[grade] - score), _sigmoid(edges[grade + 1] - score)
        chance = np.maximum(above - below, 1e-12)
        slope_below, slope_above = below * (1 - below), above * (1 - above)
        by_score = (slope_above - slope_below) / chance / n
        by_edge = np.zeros(len(edges))
        np.add.at(by_edge, grade + 1, -slope_above / chance / n)
        np.add.at(by_edge, grade, slope_below / chance / n)
        by_threshold = by_edge[1:-1]
        later = np.cumsum(by_threshold[::-1])[::-1]
        gradient = np.concatenate(
            [
                np.bincount(slot, weights=value * by_score[row], minlength=len(used)) + RIDGE * weights,
                later[:1],
                later[1:] * np.exp(bounds[1:]),
            ]
        )
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        rate = 0.2 * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
        parameters = parameters - rate * first / (np.sqrt(second) + 1e-8)
    weights = np.zeros(DIMENSIONS + 1)
    weights[used] = parameters[: len(used)] * 10
    bounds = parameters[len(used) :]
    thresholds = np.cumsum(np.concatenate([bounds[:1], np.exp(bounds[1:])]))
    return OrdinalModel(weights, tuple(thresholds.tolist()), lowest)


def _fit_task(table: pa.Table) -> pa.Table:
    order = np.argsort(np.array(table.column("place").to_pylist()), kind="stable")
    table = table.take(pa.array(order))
    model = fit_grades(texts(table), column(table, "grade").to_numpy(False))
    return pa.table(
        {
            "weights": [model.weights.tobytes()],
            "thresholds": pa.array([list(model.thresholds)], pa.list_(pa.float64())),
            "lowest": pa.array([model.lowest], pa.int32()),
        }
    )


def fit_ordinal(docs: DataFrame, grades: DataFrame, fit_rows: int = FIT_ROWS) -> OrdinalModel:
    """Fit on ``docs(doc_id, text)`` with ``grades(doc_id, grade)``, the lowest where several."""
    graded = grades.filter("doc_id IS NOT NULL AND grade IS NOT NULL").groupBy("doc_id")
    place = F.struct(F.xxhash64("doc_id").alias("hash"), F.col("doc_id"))
    chosen = (
        graded.agg(F.min("grade").cast("int").alias("grade"))
        .withColumn("place", place)
        .orderBy("place")
        .limit(fit_rows)
    )
    # at most fit_rows ids: broadcast within a fixed bound
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    # repeated ids could exceed the bound: one row each
    sample = sample.groupBy("doc_id").agg(
        F.max("text").alias("text"), F.first("grade").alias("grade"), F.first("place.hash").alias("place")
    )
    fitted = sample.groupBy(F.lit(0).alias("all")).applyInArrow(
        lambda table: _fit_task(table), "weights binary, thresholds array<double>, lowest int"
    )
    row = fitted.first()
    if row is None:
        return OrdinalModel(np.zeros(DIMENSIONS + 1), ())
    return OrdinalModel(np.frombuffer(row["weights"]), tuple(row["thresholds"]), row["lowest"])


def text_score(text: Column, model: OrdinalModel) -> Column:
    """The score of a text."""
    weights = model.weights

    def scores(values: pa.Array) -> pa.Array:
        values = values.fill_null("")
        out, at = [], 0
        ends = np.cumsum(pc.binary_length(values).to_numpy(False), dtype=np.int64)
        while at < len(values):
            done = int(ends[at - 1]) if at else 0
            end = max(at + 1, int(np.searchsorted(ends, done + SLICE, "right")))
            ids, offsets, distinct = words(values.slice(at, end - at))
            per_word = weights[_slots(distinct.to_pylist())].sum(1)
            each = per_word[ids] + weights[DIMENSIONS] * _repeats(ids, offsets)
            sums = np.concatenate([[0.0], np.cumsum(each)])
            n = np.diff(offsets)
            out.append((sums[offsets[1:]] - sums[offsets[:-1]]) / np.maximum(1, n))
            at = end
        return pa.array(np.concatenate(out) if out else np.zeros(0))

    return F.arrow_udf(scores, "double")(text)


def with_grades(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """Add ``expected_grade`` and ``tail_probability``, that of a grade above the lowest."""
    tails = [1 / (1 + F.exp(F.lit(t) - F.col("_score"))) for t in model.thresholds]
    expected = F.lit(float(model.lowest))
    for tail in tails:
        expected = expected + tail
    return (
        docs.withColumn("_score", text_score(F.col("text"), model))
        .withColumn("expected_grade", expected)
        .withColumn("tail_probability", tails[0] if tails else F.lit(float(model.lowest > 0)))
        .drop("_score")
    )


def selected(graded: DataFrame, least: float = LEAST_TAIL) -> DataFrame:
    """Add ``kept``: whether the tail probability reaches ``least``."""
    return graded.withColumn("kept", F.col("tail_probability") >= least)


def label_grades(labels: DataFrame) -> DataFrame:
    """Grades from the labels: 0 poor, 1 good text that is toxic, 2 good."""
    grade = F.when(F.col("quality") < 1, 0).when(F.col("toxic") >= 1, 1).otherwise(2)
    return labels.select("doc_id", F.when(F.col("quality").isNotNull(), grade).alias("grade"))
