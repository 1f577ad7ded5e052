"""Katz back-off language model over documents.

``P(w | h)`` is a Good-Turing discounted share where the n-gram ``h w`` was seen and
``a(h) P(w | h')`` otherwise, with ``h'`` one word shorter and ``a(h)`` such that the
probabilities of all words and of the unknown word sum to one. Unigrams are discounted
too, and what that frees is the unknown word's probability.

The corpus is stored as blocks of numbered words, bucketed by block. For each order a block asks the
buckets of contexts for its distinct n-grams; a bucket adds up the training counts of
all blocks and answers with counts and the sums that a context's back-off weight needs.
The answers are stored as a table partitioned by order, and each block evaluates its
tokens from the lowest order up. A context with many n-grams is dealt over several
buckets by n-gram, whose sums are added by the blocks, so a frequent word loads no task.

Null texts count as empty (one token, the end); a null ``doc_id`` stays null and counts
as the id ''; repeated rows are separate texts; extra columns are ignored; an empty table
gives no rows. Without any training row all probabilities are those of the unknown word, 1.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayflow.llm.blocks import blocks, column, mix, pack, remainder, runs, segment_sums, stored
from quayflow.llm.blocks import stored_by, texts, unpack, words
from quayflow.llm.token_counts import bucket_count

BLOCK = 12 << 20
MESSAGE = "block string, bucket int, message binary"
ANSWER = "level int, block string, bucket int, message binary"
ROWS = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
OFTEN = 6  # words of a block used as often are numbered by use
DISCOUNTED = 5  # counts up to this are discounted
END, BEGIN = np.uint64(1), np.uint64(2)  # hashes kept for the marks


def _number_words(size: int):
    """Each block: documents, training marks, word hashes and the words' numbers."""

    def number_words(batches):
        for number, table in enumerate(blocks(batches, size=size)):
            ids, offsets, distinct = words(texts(table, lower=True))
            used, ids = np.unique(ids, return_inverse=True)
            names = distinct.take(pa.array(used)).to_pylist()
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, names), np.uint64, len(names))
            hashes = np.concatenate([[END, BEGIN], np.maximum(hashes, np.uint64(3))]).astype(np.uint64)
            sequence = np.zeros(len(ids) + table.num_rows, np.int32)
            ends = offsets[1:] + np.arange(table.num_rows)
            is_word = np.ones(len(sequence), bool)
            is_word[ends] = False
            sequence[is_word] = ids + 2
            # frequent words get small numbers and rare ones go by hash, which packs well
            use = np.bincount(ids, minlength=len(names))
            by_use = 2 + np.lexsort((hashes[2:], -np.where(use >= OFTEN, use, 0)))
            by_use = np.concatenate([[0, 1], by_use])
            place = np.empty(len(by_use), np.int32)
            place[by_use] = np.arange(len(by_use))
            doc_ids = column(table, "doc_id")
            message = pack(
                pc.fill_null(doc_ids, 0).to_numpy(False),
                doc_ids.is_null().to_numpy(False),
                column(table, "held_out").to_numpy(False),
                (np.diff(offsets) + 1).astype(np.int32),
                np.diff(hashes[by_use], prepend=np.uint64(0)),
                place[sequence],
            )
            block = f"{TaskContext.get().partitionId()}-{number}"
            yield pa.RecordBatch.from_pydict(
                {"block": [block], "bucket": pa.array([-1], pa.int32()), "message": [message]}
            )

    return number_words


def discounts(counts_of_counts: np.ndarray) -> np.ndarray:
    """Good-Turing factors of counts 0..k+1 as Katz renormalises them; 1 above k.

    ``counts_of_counts[r]`` is the number of n-grams seen r times, r = 0..k+1. Where
    these give no factor in (0, 1) the factor is ``(r - 1/2) / r``.
    """
    n = counts_of_counts.astype(float)
    k = len(n) - 2
    factor = np.ones(k + 2)
    factor[0] = 0
    common = (k + 1) * n[k + 1] / n[1] if n[1] else 0.0
    for r in range(1, k + 1):
        if not n[r]:
            continue
        value = ((r + 1) * n[r + 1] / n[r] / r - common) / (1 - common) if common != 1 else 0.0
        factor[r] = value if 0 < value < 1 else (r - 0.5) / r
    return factor


def unigram_probability(count: np.ndarray, totals: dict) -> np.ndarray:
    """Of words by their training counts; of the unknown word at 0."""
    factor = totals["discounts"][1]
    discounted = factor[np.minimum(count, DISCOUNTED + 1).astype(int)] * count
    everything = max(1.0, totals["tokens"] + totals["reserve"])
    return np.where(count > 0, discounted, float(totals["freed"])) / everything


class _Block:
    """A block's documents and, order by order, its distinct n-grams and their answers."""

    def __init__(self, message: bytes):
        self.doc_ids, self.null, self.held_out, self.lengths, steps, self.sequence = unpack(message)
        self.hashes = np.cumsum(steps, dtype=np.uint64)
        self.ends = np.concatenate([[0], np.cumsum(self.lengths, dtype=np.int64)])
        self.training = np.repeat(~self.held_out, self.lengths)
        self.level = 0

    def grams(self) -> None:
        """Go up one order: distinct n-grams, their contexts and training counts."""
        self.level += 1
        if self.level == 1:
            self.gram = self.sequence
            self.gram_hash = self.hashes
            self.context = np.zeros(len(self.hashes), np.int32)
            self.context_hash = np.zeros(1, np.uint64)
            self.context_count = np.zeros(1)
        else:
            lower, n_lower = self.gram, len(self.gram_hash)
            # the context of a token is the (n-1)-gram that ends before it
            before = np.empty(len(lower), np.int64)
            before[1:] = lower[:-1]
            before[self.ends[:-1]] = n_lower
            begin = mix(np.array([BEGIN + np.uint64(self.level)]))
            hashes = np.concatenate([self.gram_hash, begin])
            counts = np.concatenate([self.count, [-1.0]])
            width = np.int64(len(self.hashes))
            before *= width
            before += self.sequence
            pairs, gram = np.unique(before, return_inverse=True)
            self.gram = gram.astype(np.int32)
            del before, gram
            context, word = np.divmod(pairs, width)
            used, context = np.unique(context, return_inverse=True)
            self.context = context.astype(np.int32)
            self.context_hash = hashes[used]
            self.context_count = counts[used]
            self.word_hash = self.hashes[word] >> np.uint64(16)
            self.gram_hash = mix(self.context_hash[context] ^ mix(self.hashes[word]))
        size = len(self.gram_hash)
        self.trained = np.bincount(self.gram, weights=self.training, minlength=size).astype(np.int64)
        self.first = np.zeros(size, np.int32)
        self.first[self.gram] = np.arange(len(self.gram))

    def dealt(self, n_buckets: int, totals: dict):
        """Buckets of the n-grams, and each bucket's bare contexts.

        A context takes as many buckets as its share of all tokens asks for.
        """
        if self.level == 1:
            return (mix(self.gram_hash) % np.uint64(n_buckets)).astype(np.int64), None, None
        seen = np.where(self.context_count < 0, totals["docs"], self.context_count)
        parts = np.maximum(1, np.ceil(seen * n_buckets / max(1, totals["tokens"]))).astype(np.int64)
        part = (mix(self.gram_hash) >> np.uint64(20)).astype(np.int64) % parts[self.context]
        home = mix(self.context_hash)
        bucket = (mix(home[self.context] + part.astype(np.uint64)) % np.uint64(n_buckets)).astype(np.int64)
        spread = np.repeat(np.arange(len(parts)), parts)
        offset = np.arange(len(spread)) - np.repeat(np.cumsum(parts) - parts, parts)
        where = (mix(home[spread] + offset.astype(np.uint64)) % np.uint64(n_buckets)).astype(np.int64)
        # two parts of a context may meet in one bucket, which then answers for both
        where_spread = np.unique(where * len(parts) + spread)
        return bucket, *np.divmod(where_spread, len(parts))

    def ask(self, n_buckets: int, totals: dict, lower: np.ndarray | None):
        """Yield (bucket, message); the same order is used to read the answers."""
        bucket, context_bucket, context = self.dealt(n_buckets, totals)
        if self.level == 1:
            order = np.lexsort((self.gram_hash, bucket))
            for b, first, last in runs(bucket[order]):
                part = order[first:last]
                steps = np.diff(self.gram_hash[part], prepend=np.uint64(0))
                yield b, part, None, (steps, self.trained[part].astype(np.int32))
            return
        by_hash = np.lexsort((self.context_hash[context], context_bucket))
        context, context_bucket = context[by_hash], context_bucket[by_hash]
        order = np.lexsort((self.gram_hash, self.context_hash[self.context], bucket))
        ordered = bucket[order]
        if self.level == 2 and lower is not None:
            # a word's probability follows from its count, which packs better
            lower = self.unigram
        lower = lower[self.first] if lower is not None else np.zeros(len(bucket))
        for b, first, last in runs(context_bucket):
            part = order[slice(*np.searchsorted(ordered, [b, b + 1]))]
            own = context[first:last]
            at = np.searchsorted(self.context_hash[own], self.context_hash[self.context[part]])
            yield b, part, own, (
                np.diff(self.context_hash[own], prepend=np.uint64(0)),
                np.bincount(at, minlength=len(own)).astype(np.int32),
                self.word_hash[part],
                self.trained[part].astype(np.int32),
                *([lower[part].astype(np.int32)] if self.level == 2 else _coded(lower[part])),
            )

    def read(self, answers: dict[int, bytes], n_buckets: int, totals: dict) -> None:
        """Take the counts and, above the first order, the contexts' sums."""
        size = len(self.gram_hash)
        self.count = np.zeros(size)
        self.sums = np.zeros((len(self.context_hash), DISCOUNTED + 3))
        for b, part, own, _ in self.ask(n_buckets, totals, None):
            got = unpack(answers[b])
            self.count[part] = got[0]
            if own is not None:
                self.sums[own] += np.stack(got[1:], 1)

    def probabilities(self, totals: dict, lower: np.ndarray | None) -> np.ndarray:
        """Probability of each token by this order, given that by the order below."""
        factor = totals["discounts"][self.level]
        count = self.count[self.gram]
        discounted = factor[np.minimum(count, DISCOUNTED + 1).astype(int)] * count
        if self.level == 1:
            return unigram_probability(count, totals)
        classes, above, covered = self.sums[:, : DISCOUNTED + 1], self.sums[:, -2], self.sums[:, -1]
        times = np.arange(DISCOUNTED + 1)
        total = classes @ times + above
        kept = classes @ (times * factor[: DISCOUNTED + 1]) + above
        # a context without discounted n-grams keeps back one event
        base = np.where(kept < total - 1e-9, total, total + 1)
        left = np.where(total > 0, (base - kept) / np.maximum(base, 1) / np.maximum(1 - covered, 1e-300), 1.0)
        context = self.context[self.gram]
        return np.where(
            count > 0, discounted / np.maximum(base[context], 1), left[context] * lower
        )


def _coded(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and their numbers, which take less room than the values."""
    distinct, number = np.unique(values, return_inverse=True)
    return distinct, number.astype(np.uint16 if len(distinct) < 1 << 16 else np.uint32)


def _climb(message: bytes, answers: list, upto: int, n_buckets: int, totals: dict):
    """The block after reading the answers of the orders below ``upto``, and its probabilities."""
    block, lower = _Block(message), None
    found: dict[int, dict[int, bytes]] = {}
    for level, bucket, message in answers:
        found.setdefault(level, {})[bucket] = message
    for level in range(1, upto):
        block.grams()
        block.read(found.get(level, {}), n_buckets, totals)
        lower = block.probabilities(totals, lower)
        if level == 1:
            block.known = block.count[block.gram] > 0
            block.unigram = block.count[block.gram]
    return block, lower


def _found(table: pa.Table) -> list:
    """(order, bucket, message) of the answers to a block."""
    names = ("level", "bucket", "message")
    return list(zip(*(table.column(name).to_pylist() for name in names), strict=True))


def _asking(level: int, n_buckets: int, totals: dict):
    def asking(corpus: pa.Table, answers: pa.Table) -> pa.Table:
        message, name = corpus.column("message")[0].as_py(), corpus.column("block")[0].as_py()
        block, lower = _climb(message, _found(answers), level, n_buckets, totals)
        block.grams()
        rows = [(b, pack(*arrays)) for b, _, _, arrays in block.ask(n_buckets, totals, lower)]
        return pa.table(
            {
                "block": pa.array([name] * len(rows), pa.string()),
                "bucket": pa.array([b for b, _ in rows], pa.int32()),
                "message": pa.array([m for _, m in rows], pa.binary()),
            }
        )

    return asking


def _answer(level: int, totals: dict):
    """Add up a bucket's training counts over all blocks."""

    def answer(table: pa.Table) -> pa.Table:
        order = np.argsort(np.array(table.column("block").to_pylist(), object), kind="stable").tolist()
        asked = [unpack(table.column("message")[i].as_py()) for i in order]
        if level == 1:
            grams = [np.cumsum(a[0], dtype=np.uint64) for a in asked]
            trained = [a[1] for a in asked]
        else:
            contexts = [np.cumsum(a[0], dtype=np.uint64) for a in asked]
            of_row = [np.repeat(c, a[1]) for c, a in zip(contexts, asked, strict=True)]
            grams = [mix(c ^ mix(a[2])) for c, a in zip(of_row, asked, strict=True)]
            trained = [a[3] for a in asked]
        gram, at = np.unique(np.concatenate(grams), return_inverse=True)
        count = np.bincount(at, weights=np.concatenate(trained), minlength=len(gram)).astype(np.int64)
        seen = np.minimum(count, DISCOUNTED + 1)
        statistics = np.bincount(seen, minlength=DISCOUNTED + 2).astype(np.int64)
        statistics = np.concatenate([statistics, [count.sum()]])
        ends = np.cumsum([len(g) for g in grams])
        sums = None
        if level > 1:
            context, inverse = np.unique(np.concatenate(contexts), return_inverse=True)
            owner = np.zeros(len(gram), np.int64)
            lower = np.zeros(len(gram))
            owner[at] = np.searchsorted(context, np.concatenate(of_row))
            if level == 2:
                lower[at] = unigram_probability(np.concatenate([a[4] for a in asked]), totals)
            else:
                lower[at] = np.concatenate([a[4][a[5]] for a in asked])
            sums = np.zeros((len(context), DISCOUNTED + 3))
            for r in range(1, DISCOUNTED + 1):
                sums[:, r] = np.bincount(owner[seen == r], minlength=len(context))
            high = seen > DISCOUNTED
            sums[:, -2] = np.bincount(owner[high], weights=count[high], minlength=len(context))
            hit = count > 0
            sums[:, -1] = np.bincount(owner[hit], weights=lower[hit], minlength=len(context))
            context_ends = np.cumsum([len(c) for c in contexts])
        messages = []
        for i, end in enumerate(ends):
            arrays = [count[at[end - len(grams[i]) : end]].astype(np.int32)]
            if level > 1:
                own = inverse[context_ends[i] - len(contexts[i]) : context_ends[i]]
                arrays += [sums[own, r].astype(np.int32) for r in range(DISCOUNTED + 1)]
                arrays += [sums[own, -2].astype(np.int64), sums[own, -1]]
            messages.append(pack(*arrays))
        n = len(order) + 1
        return pa.table(
            {
                "level": pa.array([level] * (n - 1) + [-level], pa.int32()),
                "block": pa.array([table.column("block")[i].as_py() for i in order] + [""], pa.string()),
                "bucket": pa.array([table.column("bucket")[0].as_py()] * n, pa.int32()),
                "message": pa.array([*messages, pack(statistics)], pa.binary()),
            }
        )

    return answer


def _scoring(order: int, n_buckets: int, totals: dict):
    def scoring(corpus: pa.Table, answers: pa.Table) -> pa.Table:
        message = corpus.column("message")[0].as_py()
        block, probability = _climb(message, _found(answers), order + 1, n_buckets, totals)
        n, v = totals["tokens"], totals["words"]
        base = np.log10((block.unigram + 0.5) / (n + 0.5 * (v + 1)))
        score = np.log10(np.maximum(probability, 1e-300))
        return pa.table(
            {
                "doc_id": pa.array(block.doc_ids, pa.int64(), mask=block.null),
                "held_out": pa.array(block.held_out),
                "n_tokens": pa.array(block.lengths.astype(np.int64)),
                "n_known": pa.array(segment_sums(block.known.astype(np.int64), block.ends)),
                "base_score": pa.array(_sums(base, block.ends)),
                "score": pa.array(_sums(score, block.ends)),
            }
        )

    return scoring


def _sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of each document alone; every document has a token."""
    return np.add.reduceat(values, ends[:-1]) if len(values) else np.zeros(0)


def katz_scores(docs: DataFrame, order: int = 2, block_bytes: int = BLOCK) -> DataFrame:
    """Score ``docs(doc_id, text, held_out)``; rows not held out are learnt from.

    Returns ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.
    ``order`` is the longest n-gram, ``block_bytes`` the text of a block.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "held_out")
    n_buckets = bucket_count(docs)
    corpus = docs.mapInArrow(_number_words(block_bytes), MESSAGE)
    corpus = stored_by(corpus, "corpus", "block", n_buckets)
    n_docs = docs.filter(~F.col("held_out")).count()
    totals: dict = {"docs": n_docs, "tokens": 0, "words": 0, "discounts": {}}
    known = corpus.sparkSession.range(0).selectExpr(
        "0 AS level", "'' AS block", "0 AS bucket", "CAST('' AS binary) AS message"
    )
    for level in range(1, order + 1):
        by_block = known.groupBy("block")
        asking = _asking(level, n_buckets, dict(totals))
        asked = corpus.groupBy("block").cogroup(by_block).applyInArrow(asking, MESSAGE)
        answers = asked.groupBy("bucket").applyInArrow(_answer(level, dict(totals)), ANSWER)
        answers = stored(answers, f"answers-{level}", "level")
        statistics = _statistics(answers, level)
        totals["discounts"][level] = discounts(statistics[:-1])
        if level == 1:
            kept = totals["discounts"][1] * np.arange(DISCOUNTED + 2)
            freed = statistics[:-2] @ (np.arange(DISCOUNTED + 1) - kept[:-1])
            totals |= {"tokens": int(statistics[-1]), "words": int(statistics[1:-1].sum())}
            # nothing freed: the unknown word gets one event on top
            totals["reserve"] = 0.0 if freed > 1e-9 else 1.0
            totals["freed"] = freed if freed > 1e-9 else 1.0
        known = known.unionByName(answers.filter(F.col("level") == level))
    scoring = _scoring(order, n_buckets, totals)
    scored = corpus.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(scoring, ROWS)
    return scored.withColumn("train_tokens", F.lit(totals["tokens"]).cast("long"))


def _statistics(answers: DataFrame, level: int) -> np.ndarray:
    """Counts of counts 0..k+1 and the sum of counts: one row however large the data."""
    each = answers.filter(F.col("level") == -level).select(F.lit(1).alias("all"), "message")
    partly = each.mapInArrow(_added_in_task, "part array<long>")
    sums = [F.sum(F.col("part")[i]).alias(f"n{i}") for i in range(DISCOUNTED + 3)]
    return np.array([value or 0 for value in partly.agg(*sums).first()], np.int64)


def _added_in_task(batches):
    for batch in batches:
        if batch.num_rows:
            total = np.sum([unpack(m.as_py())[0] for m in batch.column("message")], 0)
            yield pa.RecordBatch.from_pydict({"part": pa.array([total.tolist()], pa.list_(pa.int64()))})


def held_out_mark(docs: DataFrame) -> DataFrame:
    """Mark every fifth id, by its crc32, as held out."""
    return docs.withColumn("held_out", remainder("doc_id") == 1)
