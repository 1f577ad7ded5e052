"""Katz scores against a dictionary version, token counts against the library."""

import functools
import math
import re
import zlib
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from quayflow.llm import ngram_lm, token_counts
from quayflow.llm.blocks import read_documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, n_tokens long"


def tokens(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*WORD.findall(lowered), None]


def remainder(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5


def katz(rows, order, only_probability=False):
    """{row index: (known, base, score)} with plain dictionaries."""
    k = ngram_lm.DISCOUNTED
    counts = [None] + [Counter() for _ in range(order)]
    for doc_id, text in rows:
        if remainder(doc_id) == 1:
            continue
        line = ["<s>"] * (order - 1) + tokens(text)
        for i in range(order - 1, len(line)):
            for n in range(1, order + 1):
                counts[n][tuple(line[i - n + 1 : i + 1])] += 1
    factors = [None]
    for n in range(1, order + 1):
        classes = Counter(min(c, k + 1) for c in counts[n].values())
        of = [0] * (k + 2)
        for r in range(1, k + 1):
            of[r] = classes[r]
        of[k + 1] = classes[k + 1]
        import numpy as np

        factors.append(ngram_lm.discounts(np.array(of)))
    d = lambda n, c: factors[n][min(c, k + 1)] * c
    n_all = sum(counts[1].values())
    freed = sum(c - d(1, c) for c in counts[1].values())
    reserve = 0 if freed > 1e-9 else 1
    freed = freed if freed > 1e-9 else 1
    followers = {}
    for n in range(2, order + 1):
        for gram, c in counts[n].items():
            followers.setdefault(gram[:-1], {})[gram[-1]] = c

    @functools.cache
    def p(gram):
        n = len(gram)
        if n == 1:
            c = counts[1][gram]
            return (d(1, c) if c else freed) / max(1, n_all + reserve)
        next_words = followers.get(gram[:-1], {})
        total = sum(next_words.values())
        if not total:
            return p(gram[1:])
        kept = sum(d(n, c) for c in next_words.values())
        base = total if kept < total - 1e-9 else total + 1
        if gram[-1] in next_words:
            return d(n, next_words[gram[-1]]) / base
        covered = sum(p((*gram[1:-1], w)) for w in next_words)
        return (base - kept) / base / (1 - covered) * p(gram[1:])

    if only_probability:
        return p
    out = []
    for _, text in rows:
        words = tokens(text)
        line = ["<s>"] * (order - 1) + words
        score = sum(math.log10(p(tuple(line[i : i + order]))) for i in range(len(words)))
        c = [counts[1][(w,)] for w in words]
        base = sum(math.log10((x + 0.5) / (n_all + 0.5 * (len(counts[1]) + 1))) for x in c)
        out.append((len(words), sum(x > 0 for x in c), n_all, base, score))
    return out


ROWS = [
    (1, "A rose is a rose\x0bis a  rose."),
    (2, None),
    (3, ""),
    (4, "the rose of the the the the the the the the the the"),
    (5, "an unknown one is here"),
    (6, "A rose is a rose\x0bis a  rose."),
    (6, "A rose is a rose\x0bis a  rose."),
    (None, "É the end of a rose"),
    (8, " ".join(f"w{i % 37} v{i % 11}" for i in range(5000))),
] + [(20 + i, f"line {i % 4} of the rose is a b c {i % 3}") for i in range(12)]


@pytest.mark.parametrize("order", [1, 2, 3])
@pytest.mark.parametrize("block", [40, 1 << 20])
def test_scores_equal_dictionaries(spark, order, block):
    df = spark.createDataFrame([(i, t, 7) for i, t in ROWS], SCHEMA)
    got = ngram_lm.katz_scores(ngram_lm.held_out_mark(df), order, block).collect()
    want = katz(ROWS, order)
    assert len(got) == len(ROWS)
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    expected = sorted(((i, *w) for (i, _), w in zip(ROWS, want, strict=True)), key=key)
    result = sorted(
        (
            (r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score)
            for r in got
        ),
        key=key,
    )
    for a, b in zip(result, expected, strict=True):
        assert a[:4] == b[:4]
        assert a[4:] == pytest.approx(b[4:], rel=1e-9)
    assert {(r.doc_id, r.held_out) for r in got} == {(i, remainder(i) == 1) for i, _ in ROWS}


@pytest.mark.parametrize("order", [2, 3])
def test_probabilities_sum_to_one(order):
    """Of the dictionary version, which the operator equals: known words and the unknown."""
    p = katz(ROWS, order, only_probability=True)
    words = {w for i, t in ROWS if remainder(i) != 1 for w in tokens(t)} | {"never-seen"}
    for context in (("rose",), ("the",), ("never-seen",), ("w1",)):
        context = ("<s>",) * (order - 2) + context
        assert sum(p((*context, w)) for w in words) == pytest.approx(1, abs=1e-9)


def test_language_model_of_no_rows_and_no_training(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert ngram_lm.katz_scores(ngram_lm.held_out_mark(empty)).count() == 0
    only = next(i for i in range(100) if remainder(i) == 1)
    df = ngram_lm.held_out_mark(spark.createDataFrame([(only, "a b", 1)], SCHEMA))
    row = ngram_lm.katz_scores(df).first()
    assert (row.n_known, row.train_tokens, row.score) == (0, 0, 0.0)


def test_held_out_texts_score_above_the_base(spark, sf_dir):
    docs = read_documents(spark, sf_dir)
    scored = ngram_lm.katz_scores(ngram_lm.held_out_mark(docs)).filter("held_out")
    total = scored.agg(F.sum("score"), F.sum("base_score")).first()
    assert total[0] > total[1]


def library_counts(rows, path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    coded = tokenizer.encode_batch([t or "" for _, t in rows], add_special_tokens=False)
    return sorted(
        ((i is None, i or 0), len((t or "").encode()), len(c.ids))
        for (i, t), c in zip(rows, coded, strict=True)
    )


def counted(df, path):
    rows = token_counts.token_counts(df, path).collect()
    assert all(r.over_limit == (r.n_tokens > 2048) for r in rows)
    return sorted(((r.doc_id is None, r.doc_id or 0), r.n_bytes, r.n_tokens) for r in rows)


def test_token_counts_equal_the_library(spark, sf_dir):
    path = public_tokenizers.path("word_bpe_49k.json")
    odd = [
        (1, "It's<|endoftext|>we'LL <|startoftext|> 1234 ab12 c　d\x85e"),
        (2, None),
        (3, ""),
        (4, "é ̈a \ńx ΑΣ İ ﬁ 中文字 😀👍🏽 \x1c\x00 a\x0bb"),
        (4, " \t "),
        (None, "x" * 30_000),
        (7, "word " * 30_000),
    ]
    df = spark.createDataFrame([(i, t, 7) for i, t in odd], SCHEMA)
    assert counted(df, path) == library_counts(odd, path)
    docs = read_documents(spark, sf_dir)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert counted(docs, path) == library_counts(rows, path)
    assert token_counts.token_counts(df.limit(0), path).count() == 0
