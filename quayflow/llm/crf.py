"""Toxic spans by a linear-chain conditional random field.

Labels are given for documents, so the tokens to learn from are labelled first: a token
of a toxic document is toxic if one of its features (word, beginnings, end) occurs in
toxic documents far more often than their share explains. The field has two states, the
same features and the four transitions, and is fitted to those token labels by gradient
steps on its likelihood. Forward-backward marginals then give each token's chance of
being toxic; a document's score is a logistic curve over the chance that any token is,
fitted to the document labels, and tokens above one half give the offending offsets.

The field is fitted in one task on at most ``FIT_ROWS`` labelled documents, those whose
ids hash lowest, whole and part after part; the task holds these texts. Its feature weights
are limited by that sample and are all that reaches the driver. Every document is scored whole: the recursions run over pieces of the text
in parallel, joined by the pieces' 2 x 2 matrices.

Null and empty texts get the score of no toxic token; null ids are kept; repeated rows
are scored alike; extra columns are ignored; empty tables give no rows. Without toxic
or without clean labels all scores are the share of toxic labels (0 without labels).
"""

from __future__ import annotations

import re
import string
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayflow.llm.blocks import blocks, column, texts, words

FIT_ROWS = 6000
FIT_PART = 4 << 20  # text of the sample whose marginals are computed at once
STEPS = 40
RIDGE = 1e-3
EVIDENCE = 5.0  # standard deviations above the toxic share
LEAST_DOCUMENTS = 4
SPANS = "array<struct<start:int,end:int>>"
ROWS = f"doc_id long, score double, predicted int, n_toxic long, spans {SPANS}"
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SIGNS = string.punctuation


@dataclass(frozen=True)
class Crf:
    """Feature weights of the toxic state, log transitions, and the document curve."""

    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -10.0
    transitions: tuple[float, float, float, float] = (0.0, 0.0, 0.0, 0.0)
    slope: float = 0.0
    offset: float = -50.0


def token_features(word: str) -> list[str]:
    """The word without signs around it, its beginnings and its end."""
    core = word.lower().strip(_SIGNS)
    out = ["w" + core]
    out += [f"b{core[:n]}" for n in (4, 5, 6) if len(core) > n]
    if len(core) > 5:
        out.append("e" + core[-5:])
    return out


def _coded(distinct: list[str], number: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """(word, feature) pairs of the features that ``number`` knows."""
    word, feature = [], []
    for i, text in enumerate(distinct):
        for name in token_features(text):
            if (n := number.get(name)) is not None:
                word.append(i)
                feature.append(n)
    return np.array(word, np.int64), np.array(feature, np.int64)


class Chain:
    """Forward-backward over concatenated documents with scores of the toxic state.

    A step is the matrix ``exp(transition[i, j] + score[j])``; at a document's start its
    rows are equal, which forgets what came before.
    """

    def __init__(self, offsets: np.ndarray):
        self.n = int(offsets[-1])
        self.length = max(1, int(np.sqrt(self.n)))
        self.pieces = -(-self.n // self.length) if self.n else 0
        start = np.zeros(self.pieces * self.length, bool)
        start[offsets[:-1][np.diff(offsets) > 0]] = True
        start[self.n :] = True  # the filling is no part of the last document
        self.start = np.ascontiguousarray(start.reshape(self.pieces, self.length).T)
        self.real = np.zeros(self.pieces * self.length, bool)
        self.real[: self.n] = True

    def _steps(self, scores: np.ndarray) -> np.ndarray:
        toxic = np.zeros(self.pieces * self.length)
        toxic[: self.n] = scores
        return np.ascontiguousarray(toxic.reshape(self.pieces, self.length).T)

    def marginals(self, scores: np.ndarray, transitions: np.ndarray):
        """Chance of the toxic state for each token, and expected transition counts."""
        if not self.n:
            return np.zeros(0), np.zeros((2, 2))
        steps = self._steps(scores)
        # the states' weights, scaled so that the larger is one
        one = np.exp(np.minimum(steps, 0))
        zero = np.exp(-np.maximum(steps, 0))
        a = np.exp(transitions)

        def matrix(t):
            s = self.start[t]
            return (
                np.where(s, 1.0, a[0, 0]) * zero[t],
                np.where(s, 1.0, a[0, 1]) * one[t],
                np.where(s, 1.0, a[1, 0]) * zero[t],
                np.where(s, 1.0, a[1, 1]) * one[t],
            )

        p = [np.ones(self.pieces), np.zeros(self.pieces), np.zeros(self.pieces), np.ones(self.pieces)]
        for t in range(self.length):
            m00, m01, m10, m11 = matrix(t)
            p = [
                p[0] * m00 + p[1] * m10,
                p[0] * m01 + p[1] * m11,
                p[2] * m00 + p[3] * m10,
                p[2] * m01 + p[3] * m11,
            ]
            scale = p[0] + p[1] + p[2] + p[3]
            p = [x / scale for x in p]
        products = np.stack(p, 1).reshape(-1, 2, 2)
        into, out = np.ones((self.pieces, 2)), np.ones((self.pieces, 2))
        for c in range(1, self.pieces):
            v = into[c - 1] @ products[c - 1]
            into[c] = v / v.sum()
        for c in range(self.pieces - 1, 0, -1):
            v = products[c] @ out[c]
            out[c - 1] = v / v.sum()
        forward = np.empty((self.length, self.pieces, 2))
        f0, f1 = into[:, 0], into[:, 1]
        for t in range(self.length):
            m00, m01, m10, m11 = matrix(t)
            f0, f1 = f0 * m00 + f1 * m10, f0 * m01 + f1 * m11
            scale = f0 + f1
            f0, f1 = f0 / scale, f1 / scale
            forward[t, :, 0], forward[t, :, 1] = f0, f1
        chance = np.empty((self.length, self.pieces))
        pairs = np.zeros((2, 2))
        b0, b1 = out[:, 0], out[:, 1]
        real = self.real.reshape(self.pieces, self.length).T
        for t in range(self.length - 1, -1, -1):
            toxic = forward[t, :, 1] * b1
            chance[t] = toxic / (forward[t, :, 0] * b0 + toxic)
            m00, m01, m10, m11 = matrix(t)
            e0, e1 = (forward[t - 1, :, 0], forward[t - 1, :, 1]) if t else (into[:, 0], into[:, 1])
            x = np.stack([e0 * m00 * b0, e0 * m01 * b1, e1 * m10 * b0, e1 * m11 * b1])
            x = x / x.sum(0)
            pairs += x[:, real[t] & ~self.start[t]].sum(1).reshape(2, 2)
            b0, b1 = m00 * b0 + m01 * b1, m10 * b0 + m11 * b1
            scale = b0 + b1
            b0, b1 = b0 / scale, b1 / scale
        return chance.T.reshape(-1)[: self.n], pairs


def _weak_labels(ids, offsets, distinct: list[str], toxic: np.ndarray):
    """Features that mark toxic documents, and which distinct words have one."""
    number: dict[str, int] = {}
    word, feature = [], []
    for i, text in enumerate(distinct):
        for name in token_features(text):
            word.append(i)
            feature.append(number.setdefault(name, len(number)))
    word, feature = np.array(word, np.int64), np.array(feature, np.int64)
    doc = np.repeat(np.arange(len(toxic)), np.diff(offsets))
    doc_word = np.unique(doc * np.int64(len(distinct)) + ids)
    doc, of_word = np.divmod(doc_word, len(distinct))
    starts = np.searchsorted(word, np.arange(len(distinct) + 1))
    counts = np.diff(starts)[of_word]
    at = np.repeat(starts[of_word], counts) + np.arange(counts.sum()) - np.repeat(
        np.cumsum(counts) - counts, counts
    )
    doc_feature = np.unique(np.repeat(doc, counts) * np.int64(len(number)) + feature[at])
    doc, of_feature = np.divmod(doc_feature, len(number))
    seen = np.bincount(of_feature, minlength=len(number))
    marked = np.bincount(of_feature, weights=toxic[doc], minlength=len(number))
    share = toxic.mean()
    excess = (marked - seen * share) / np.sqrt(np.maximum(seen * share * (1 - share), 1e-12))
    strong = (excess >= EVIDENCE) & (marked >= LEAST_DOCUMENTS) & (marked >= 0.8 * seen)
    # copies of one document repeat its words with their neighbours, which tells nothing
    before = np.concatenate([[-1], ids[:-1]])
    of_toxic = np.repeat(toxic > 0, np.diff(offsets))
    places = np.unique(ids[of_toxic] * np.int64(len(distinct) + 1) + before[of_toxic] + 1)
    of_word = places // (len(distinct) + 1)
    counts = np.diff(starts)[of_word]
    at = np.repeat(starts[of_word], counts) + np.arange(counts.sum()) - np.repeat(
        np.cumsum(counts) - counts, counts
    )
    neighbours = np.bincount(feature[at], minlength=len(number))
    strong &= neighbours >= np.maximum(LEAST_DOCUMENTS, 0.6 * marked)
    names = [name for name, n in number.items() if strong[n]]
    has = np.zeros(len(distinct), bool)
    has[word[strong[feature]]] = True
    return names, has


def _parts(sizes: np.ndarray) -> list[tuple[int, int]]:
    """Bounds of runs of documents of at most ``FIT_PART`` bytes, or of one longer document."""
    ends, parts, first = np.cumsum(sizes), [], 0
    while first < len(sizes):
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + FIT_PART, "right")))
        parts.append((first, last))
        first = last
    return parts


def fit_field(values: pa.Array, labels: np.ndarray) -> Crf:
    """The field of texts with document labels 0 and 1."""
    toxic = labels.astype(float)
    if not len(toxic) or toxic.min() == toxic.max():
        share = toxic.mean() if len(toxic) else 0.0
        return Crf(offset=50.0 if share == 1 else -50.0)
    ids, offsets, distinct = words(values)
    if not len(ids):
        return Crf(offset=float(np.log(toxic.mean() / (1 - toxic.mean()))))
    names = distinct.to_pylist()
    strong, has = _weak_labels(ids, offsets, names, toxic)
    number = {name: i for i, name in enumerate(strong)}
    # all documents count, part after part
    parts = []
    for first_doc, last_doc in _parts(pc.binary_length(values).to_numpy()):
        bounds = offsets[first_doc : last_doc + 1]
        parts.append((ids[bounds[0] : bounds[-1]], Chain(bounds - bounds[0])))
    truth = has[ids] & np.repeat(toxic > 0, np.diff(offsets))
    word, feature = _coded(names, number)
    use = np.bincount(ids, minlength=len(names)).astype(float)
    hit = np.bincount(ids, weights=truth, minlength=len(names))
    parameters = np.concatenate([np.zeros(len(strong)), [-3.0], np.zeros(4)])
    wanted = np.zeros((2, 2))
    inside = ~np.isin(np.arange(1, len(ids)), offsets)
    np.add.at(wanted, (truth[:-1][inside].astype(int), truth[1:][inside].astype(int)), 1)
    first = second = np.zeros_like(parameters)
    for step in range(1, STEPS + 1):
        weights, bias, transitions = np.split(parameters, [len(strong), len(strong) + 1])
        per_word = bias[0] + np.bincount(word, weights=weights[feature], minlength=len(names))
        got, pairs = np.zeros(len(names)), np.zeros((2, 2))
        for own, chain in parts:
            chance, changes = chain.marginals(per_word[own], transitions.reshape(2, 2))
            got += np.bincount(own, weights=chance, minlength=len(names))
            pairs += changes
        miss = (hit - got) / use.sum()
        gradient = np.concatenate(
            [
                np.bincount(feature, weights=miss[word], minlength=len(strong)),
                [miss.sum()],
                (wanted - pairs).ravel() / use.sum(),
            ]
        )
        gradient -= RIDGE * 1e-3 * parameters
        first = 0.8 * first + 0.2 * gradient
        second = 0.95 * second + 0.05 * gradient**2
        rate = 0.5 * np.sqrt(1 - 0.95**step) / (1 - 0.8**step)
        parameters = parameters + rate * first / (np.sqrt(second) + 1e-9)
    weights = dict(zip(strong, parameters[: len(strong)].tolist(), strict=True))
    fitted = Crf(weights, float(parameters[len(strong)]), tuple(parameters[-4:].tolist()))
    any_token = document_evidence(fitted, values)[0]
    slope, offset = _curve(any_token, toxic)
    return Crf(fitted.weights, fitted.bias, fitted.transitions, slope, offset)


def _curve(evidence: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Logistic curve by Newton steps with a light ridge; the slope stays positive."""
    x = np.stack([evidence, np.ones_like(evidence)], 1)
    beta = np.zeros(2)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (toxic - p) - 0.5 * beta
        curvature = (x * (p * (1 - p))[:, None]).T @ x + 0.5 * np.eye(2)
        beta = beta + np.clip(np.linalg.solve(curvature, gradient), -2, 2)
    return max(float(beta[0]), 0.0), float(beta[1])


def document_evidence(model: Crf, values: pa.Array):
    """Log odds that any token is toxic, and the tokens that likely are."""
    ids, offsets, distinct = words(values)
    names = distinct.to_pylist()
    get = model.weights.get
    per_word = np.array([model.bias + sum(get(f, 0.0) for f in token_features(w)) for w in names])
    scores = per_word[ids] if len(names) else np.zeros(0)
    chance, _ = Chain(offsets).marginals(scores, np.array(model.transitions).reshape(2, 2))
    clean = np.log1p(-np.minimum(chance, 1 - 1e-12))
    sums = np.concatenate([[0.0], np.cumsum(clean)])
    none = np.minimum(sums[offsets[1:]] - sums[offsets[:-1]], 0)
    odds = np.log(np.maximum(-np.expm1(none), 1e-6)) - np.maximum(none, -12)
    return odds, chance, offsets


def _offsets(text: str, flagged: set[int]) -> list[dict]:
    found = enumerate(_WORD.finditer(text))
    return [{"start": m.start(), "end": m.end()} for i, m in found if i in flagged]


def _score(model: Crf):
    def score(batches):
        for table in blocks(batches, size=8 << 20):
            values = texts(table)
            odds, chance, offsets = document_evidence(model, values)
            scores = 1 / (1 + np.exp(-np.clip(model.slope * odds + model.offset, -50, 50)))
            flagged = np.flatnonzero(chance >= 0.5)
            doc = np.searchsorted(offsets, flagged, "right") - 1
            spans: list = [[] for _ in range(table.num_rows)]
            for d in np.unique(doc).tolist():
                inside = set((flagged[doc == d] - offsets[d]).tolist())
                spans[d] = _offsets(values[d].as_py(), inside)
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": column(table, "doc_id"),
                    "score": scores,
                    "predicted": (scores >= 0.5).astype(np.int32),
                    "n_toxic": np.bincount(doc, minlength=table.num_rows).astype(np.int64),
                    "spans": pa.array(spans, kind),
                }
            )

    return score


def _fit_task(table: pa.Table) -> pa.Table:
    order = np.argsort(np.array(table.column("place").to_pylist()), kind="stable")
    table = table.take(pa.array(order))
    model = fit_field(texts(table), column(table, "toxic").to_numpy(False))
    names = list(model.weights)
    return pa.table(
        {
            "names": pa.array([names], pa.list_(pa.string())),
            "weights": pa.array([[model.weights[n] for n in names]], pa.list_(pa.float64())),
            "rest": pa.array(
                [[model.bias, *model.transitions, model.slope, model.offset]], pa.list_(pa.float64())
            ),
        }
    )


def fit_crf(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Crf:
    """Fit on ``docs(doc_id, text)`` with ``labels(doc_id, toxic)``, toxic where any row is."""
    labelled = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id")
    chosen = (
        labelled.agg((F.max("toxic") >= 1).cast("int").alias("toxic"))
        .withColumn("place", F.struct(F.xxhash64("doc_id").alias("hash"), F.col("doc_id")))
        .orderBy("place")
        .limit(fit_rows)
    )
    # at most fit_rows ids: broadcast within a fixed bound
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    sample = sample.groupBy("doc_id").agg(
        F.max("text").alias("text"), F.first("toxic").alias("toxic"), F.first("place.hash").alias("place")
    )
    schema = "names array<string>, weights array<double>, rest array<double>"
    row = sample.groupBy(F.lit(0).alias("all")).applyInArrow(lambda t: _fit_task(t), schema).first()
    if row is None:
        return Crf()
    bias, *rest = row["rest"]
    weights = dict(zip(row["names"], row["weights"], strict=True))
    return Crf(weights, bias, tuple(rest[:4]), rest[4], rest[5])


def toxicity(docs: DataFrame, model: Crf) -> DataFrame:
    """``doc_id, score, predicted, n_toxic, spans`` for each row of ``docs(doc_id, text)``.

    ``spans`` holds the code point offsets of likely toxic words.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInArrow(_score(model), ROWS)
