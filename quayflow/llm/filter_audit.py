"""Audit of filters that are applied one after the other, for all of their orders.

What a row fails is a mask of filters, so rows are first counted by part and mask. A mask's
rows leave at the first filter of an order that is in the mask. Orders are numbered by their
Lehmer rank (their lexicographic place), and the orders that begin with the same filters are
an interval of ranks; hence the orders in which a mask is removed at a given step are a few
intervals. A mask's counts are added where an interval begins and taken off where it ends,
and the running sum over the ranks gives what each order removes at each step.

Everything after the first count is as large as the number of parts, times 5 steps and 120
orders for five filters; a part's rows are counted within tasks before they are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quayflow.llm.blocks import stored

WORD_GAP = r"[\x20\x09-\x0D]+"
COUNTS = ("rows", "good", "toxic")


def removal_intervals(n: int) -> Iterator[tuple[int, int, int, int]]:
    """``mask, step, first rank, rank after the last`` for all masks of ``n`` filters."""
    for mask in range(1, 1 << n):
        open_prefixes = [(0, tuple(range(n)))]
        for step in range(1, n + 1):
            width = factorial(n - step)
            longer = []
            for first, left in open_prefixes:
                for digit, f in enumerate(left):
                    rank = first + digit * width
                    if mask >> f & 1:
                        yield mask, step, rank, rank + width
                    else:
                        longer.append((rank, left[:digit] + left[digit + 1 :]))
            open_prefixes = longer


def audit(masks: DataFrame, filters: Sequence[str]) -> DataFrame:
    """What each filter removes in each order, from ``masks(part, mask, rows, good, toxic)``.

    Bit i of ``mask`` says that the rows fail filter i. ``filters`` are single letters in
    lexicographic order. Returns for each part, order and step ``part, filter_order, step,
    filter, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley``, zeros
    included; no part, no rows. Parts must not be null.
    """
    spark, n = masks.sparkSession, len(filters)
    orders = ["".join(order) for order in permutations(filters)]
    counted = stored(masks.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in COUNTS]), "masks")
    # a fixed table: under 1,000 intervals for five filters
    table = spark.createDataFrame(list(removal_intervals(n)), "mask int, step int, first int, after int")
    covered = counted.join(F.broadcast(table), "mask")
    ends = F.array(
        F.struct(F.col("first").alias("rank"), F.lit(1).alias("sign")),
        F.struct(F.col("after").alias("rank"), F.lit(-1).alias("sign")),
    )
    events = covered.withColumn("end", F.explode(ends)).filter(F.col("end.rank") < len(orders))
    nothing = F.lit(None).cast("array<bigint>")
    changes = events.select(
        "part",
        "step",
        "end.rank",
        *[(F.col(c) * F.col("end.sign")).alias(c) for c in COUNTS],
        F.lit(0).cast("bigint").alias("all_rows"),
        nothing.alias("fails"),
        nothing.alias("only"),
    )
    failing = [F.sum(F.when(F.col("mask").bitwiseAND(1 << f) > 0, F.col("rows")).otherwise(0)) for f in range(n)]
    alone = [F.sum(F.when(F.col("mask") == 1 << f, F.col("rows")).otherwise(0)) for f in range(n)]
    totals = counted.groupBy("part").agg(
        F.sum("rows").alias("all_rows"), F.array(*failing).alias("fails"), F.array(*alone).alias("only")
    )
    zero = F.lit(0).cast("bigint")
    grid = (
        totals.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(n))))
        .withColumn("rank", F.explode(F.sequence(F.lit(0), F.lit(len(orders) - 1))))
        .select("part", "step", "rank", *[zero.alias(c) for c in COUNTS], "all_rows", "fails", "only")
    )
    cells = grid.unionByName(changes).groupBy("part", "step", "rank").agg(
        *[F.sum(c).alias(c) for c in (*COUNTS, "all_rows")],
        *[F.max(c).alias(c) for c in ("fails", "only")],
    )
    over_ranks = W.partitionBy("part", "step").orderBy("rank").rowsBetween(W.unboundedPreceding, 0)
    over_steps = W.partitionBy("part", "rank").orderBy("step").rowsBetween(W.unboundedPreceding, 0)
    sums = cells.select(
        "part", "step", "rank", "all_rows", "fails", "only", *[F.sum(c).over(over_ranks).alias(c) for c in COUNTS]
    )
    order = F.element_at(F.array(*map(F.lit, orders)), F.col("rank") + 1)
    letter = F.substring(order, F.col("step"), F.lit(1))
    number = F.array_position(F.array(*map(F.lit, filters)), letter).cast("int")
    removed = F.col("rows")
    return sums.select(
        "part",
        order.alias("filter_order"),
        "step",
        letter.alias("filter"),
        (F.col("all_rows") - F.sum("rows").over(over_steps)).alias("kept"),
        removed.alias("removed"),
        (F.element_at("fails", number) - removed).alias("redundant"),
        F.element_at("only", number).alias("unique_fails"),
        F.col("good").alias("good_lost"),
        F.col("toxic").alias("toxic_lost"),
    ).withColumn("shapley", F.sum("removed").over(W.partitionBy("part", "filter")))


def text_failures(text: Column) -> list[Column]:
    """Failure conditions A to D of a text that is not null."""
    words = F.filter(F.split(text, WORD_GAP), lambda word: word != "")
    n_words, n_distinct = F.size(words), F.size(F.array_distinct(words))
    return [
        n_words < 200,
        100 * n_distinct < 50 * n_words,
        100 * F.regexp_count(text, F.lit("[A-Z]")).cast("bigint") > 2 * F.length(text).cast("bigint"),
        text.rlike("[#$%&*|]"),
    ]


def document_masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, rows, good, toxic`` of documents for filters A to E.

    ``docs(doc_id, text, source)``; bits 0 to 3 are ``text_failures``, bit 4 marks a text
    that a smaller doc_id has too (by its SHA-256). Null texts count as empty, the null
    source is the part ''. Rows without an id neither are repeats nor make others such; of
    rows that share the smallest id of a text none is a repeat. ``labels(doc_id, quality,
    toxic)``: a document is good, or toxic, if any of its label rows says so; documents
    without labels are neither. Extra columns are ignored; no documents, no rows.
    """
    text = F.coalesce("text", F.lit(""))
    bits = [F.when(fails, 1 << i).otherwise(0) for i, fails in enumerate(text_failures(text))]
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        sum(bits[1:], bits[0]).alias("mask"),
    )
    rows = stored(rows, "failures")
    # joined by text and id, a text that very many documents share is spread by their ids
    firsts = (
        rows.groupBy("digest")
        .agg(F.min("doc_id").alias("doc_id"))
        .filter("doc_id IS NOT NULL")
        .withColumn("is_first", F.lit(True))
    )
    marks = labels.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"),
    )
    repeat = F.col("is_first").isNull() & F.col("doc_id").isNotNull()
    marked = rows.join(firsts, ["digest", "doc_id"], "left").join(marks, "doc_id", "left")
    return (
        marked.select("part", (F.col("mask") + F.when(repeat, 16).otherwise(0)).alias("mask"), "good", "toxic")
        .groupBy("part", "mask")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
            F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"),
        )
    )


# The audit of the documents in DuckDB SQL: every order walked step by step.
AUDIT_SQL = r"""
WITH texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
words AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM texts),
marks AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
failed AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, list_concat(
      CASE WHEN len(w) < 200 THEN ['A'] ELSE [] END,
      CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN ['B'] ELSE [] END,
      CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 2 * length(t) THEN ['C'] ELSE [] END,
      CASE WHEN regexp_matches(t, '[#$%&*|]') THEN ['D'] ELSE [] END,
      CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN ['E'] ELSE [] END) AS fails
  FROM words LEFT JOIN marks USING (doc_id)),
masks AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failed GROUP BY part, fails),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT filter_order, unnest(range(1, 6))::INT AS step FROM orders),
cells AS (
  SELECT part, filter_order, step, filter_order[step] AS filter,
    list_has(fails, filter_order[step]) AS hit,
    len(list_intersect(fails, string_split(filter_order[:step - 1], ''))) > 0 AS earlier,
    len(fails) AS n_fails, n, good, toxic
  FROM masks, steps),
found AS (
  SELECT part, filter_order, step, filter,
    sum(CASE WHEN hit OR earlier THEN 0 ELSE n END)::BIGINT AS kept,
    sum(CASE WHEN hit AND NOT earlier THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN hit AND earlier THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN hit AND n_fails = 1 THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN hit AND NOT earlier THEN good ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN hit AND NOT earlier THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM cells GROUP BY part, filter_order, step, filter)
SELECT *, sum(removed) OVER (PARTITION BY part, filter)::BIGINT AS shapley FROM found
"""
