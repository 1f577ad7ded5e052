"""Sampled segmentations against enumeration, sentencepiece and round trips."""

import itertools
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor

from quayflow.llm import sampling
from quayflow.llm.blocks import mix, read_documents

PATH = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, sample int, pieces string"


def all_segmentations(text, v):
    """{ids: log weight} of a normalised text."""
    model = SentencePieceProcessor(model_file=PATH)
    known = {model.id_to_piece(i): i for i in range(v.size) if np.isfinite(v.weight[i])}
    whole = sampling.BLANK + text.replace(" ", sampling.BLANK)
    out = {(): 0.0}
    best = [dict() for _ in range(len(whole) + 1)]
    best[0] = out
    for i in range(len(whole)):
        for j in range(i + 1, min(len(whole), i + v.longest) + 1):
            piece = whole[i:j]
            if piece in known:
                ids, weight = (known[piece],), v.weight[known[piece]]
            elif j == i + 1 and whole[i] not in known:
                raw = whole[i].encode()
                ids, weight = tuple(v.bytes[b] for b in raw), v.byte_weight * len(raw)
            else:
                continue
            for path, w in best[i].items():
                best[j][path + ids] = w + weight
    total = np.logaddexp.reduce(list(best[-1].values()))
    return {tuple(map(int, ids)): w - total for ids, w in best[-1].items()}


@pytest.mark.parametrize("text", ["to be", "a\n中 b", "the the"])
def test_samples_follow_the_gumbel_top_k_distribution(text):
    v = sampling.vocabulary(PATH)
    wanted = all_segmentations(text, v)
    n, k = 4000, 3
    keys = mix(np.arange(n).astype(np.uint64))
    sampler = sampling.Sampler([text] * n, keys, v)
    found = list(sampler.search(k))
    threshold = found.pop()
    drawn = []
    for rows, log_prob, perturbed, path in found:
        pieces = sampler.pieces(path)
        drawn.append([tuple(pieces[r].tolist()) for r in range(n)])
        for r in rows:
            assert log_prob[r] == pytest.approx(wanted[drawn[-1][r]], abs=1e-9)
        assert len(rows) == n
        assert (threshold < perturbed).all()
    assert all(len({a, b, c}) == 3 for a, b, c in zip(*drawn, strict=True))
    # the first is a plain sample, the second one of what is left, and so on
    first = Counter(drawn[0])
    for ids, log in wanted.items():
        p = np.exp(log)
        assert abs(first[ids] / n - p) < 5 * np.sqrt(p * (1 - p) / n) + 1e-3
    chance = {ids: np.exp(log) for ids, log in wanted.items()}
    second = Counter(drawn[1])
    likely = sorted(chance, key=chance.get)[-6:]
    for ids in likely:
        p = sum(chance[o] * chance[ids] / (1 - chance[o]) for o in chance if o != ids)
        assert abs(second[ids] / n - p) < 5 * np.sqrt(p * (1 - p) / n) + 1e-3
    # inverse inclusion probabilities estimate the whole mass without bias
    estimates = np.zeros(n)
    for _, log_prob, _, _ in found:
        q = -np.expm1(-np.exp(log_prob - threshold))
        estimates += np.exp(log_prob) / q
    assert estimates.mean() == pytest.approx(1, abs=5 * estimates.std() / np.sqrt(n) + 1e-3)


def test_perturbed_values_have_gumbel_order():
    """The largest value is a standard Gumbel variable whatever the text."""
    v = sampling.vocabulary(PATH)
    n = 3000
    sampler = sampling.Sampler(["some words here"] * n, mix(np.arange(n).astype(np.uint64)), v)
    values = [perturbed for _, _, perturbed, _ in list(sampler.search(4))[:-1]]
    assert values[0].mean() == pytest.approx(0.5772, abs=0.1)
    for a, b in itertools.pairwise(values):
        assert (a > b).all()


ROWS = [
    (1, "Hello  world\nfoo\tbar"),
    (2, None),
    (3, ""),
    (4, " "),
    (None, "   é 中文 😀 ﬁ\x00"),
    (6, "x" * 3000),
    (7, "many words " * 8000),
    (7, "many words " * 8000),
    (8, "a"),
]


def test_frames(spark):
    df = spark.createDataFrame([(i, t, 0, "") for i, t in ROWS], SCHEMA)
    found = sampling.sampled_segmentations(df, PATH, 3)
    rows = found.withColumn("text", sampling.decoded(found.pieces, PATH)).collect()
    model = SentencePieceProcessor(model_file=PATH)
    texts = {i: t or "" for i, t in ROWS}
    for r in rows:
        ids = np.frombuffer(r.pieces, np.uint16).tolist()
        assert r.n_pieces == len(ids)
        assert r.text == texts[r.doc_id] == model.decode(ids)
        assert r.log_prob <= 1e-9 and r.log_inclusion <= 1e-9
    by_id = Counter(r.doc_id for r in rows)
    assert by_id[2] == by_id[3] == 1 and by_id[7] == 6 and by_id[6] == 3
    distinct = {(r.doc_id, bytes(r.pieces)) for r in rows}
    assert len(distinct) == len(rows) - 3
    again = sampling.sampled_segmentations(df.repartition(3), PATH, 3).collect()
    same = lambda found: sorted((str(r.doc_id), r.sample, bytes(r.pieces)) for r in found)
    assert same(again) == same(rows)
    other = sampling.sampled_segmentations(df, PATH, 3, seed=8).collect()
    assert {bytes(r.pieces) for r in other if r.doc_id == 7} != {bytes(r.pieces) for r in rows if r.doc_id == 7}
    assert sampling.sampled_segmentations(df.limit(0), PATH).count() == 0


def test_whole_table_round_trip(spark, sf_dir):
    docs = read_documents(spark, sf_dir)
    found = sampling.sampled_segmentations(docs, PATH)
    found = found.withColumn("decoded", sampling.decoded(found.pieces, PATH))
    rows = found.join(docs.select("doc_id", "text"), "doc_id").collect()
    assert len(rows) == 2 * docs.count()
    assert all(r.decoded == r.text for r in rows)


def test_a_texts_own_blank_sign_is_a_blank(spark):
    df = spark.createDataFrame([(1, "a▁b c", 0, ""), (2, "▁", 0, "")], SCHEMA)
    rows = sampling.sampled_segmentations(df, PATH, k=1, decode=True).collect()
    assert {r.doc_id: r.decoded for r in rows} == {1: "a b c", 2: " "}
