"""Mix sources to target weights by Efraimidis-Spirakis sampling.

Targets share all words out by the sources' weights; no source is repeated more than
``most`` times, and what it can't take is shared by weight among the others. Every
document gets the key ``-ln(u) / quality``, with ``u`` from its id, so the documents in
key order are a weighted sample without replacement. A source's target takes complete
epochs first, then the documents in key order whose running sum reaches the rest; the
document at the border is in if that comes closer to the target.

Running sums do not gather a source in one task: keys are cut into ranges, the sums of
ranges are run through first, and rows only within their range.

Null and empty texts have size 0; the null source is a source, the last one; a row without
an id gets its key from its text; repeated rows are documents of their own, in the order of
their texts' hash; a null, non-positive or NaN quality counts as 1; extra columns are ignored or, by
``mixed_rows``, kept; an empty table gives no rows; sources without words get target 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quayflow.llm.blocks import stored

WEIGHTS = (5, 2, 1)
MOST = 3
SEED = "mix"
GOOD, POOR = 2.0, 0.5
RANGE_ROWS = 4096
LEAST_RANGES = 64


def word_count(text: Column) -> Column:
    """Words between ASCII white space; 0 for null."""
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))
    return F.coalesce(words, F.lit(0)).cast("long")


def identity(doc_id: Column, text: Column) -> Column:
    """What a document's key is drawn from: its id, or without one its text."""
    return F.coalesce(doc_id.cast("string"), F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def sample_key(name: Column, quality: Column, seed: str = SEED) -> Column:
    """Exponential key of a document: smaller with higher quality, fixed by its ``identity``."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), name))
    number = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double")
    weight = F.when((quality > 0) & ~F.isnan(quality.cast("double")), quality).otherwise(1.0)
    return -F.ln((number + 0.5) / F.lit(float(1 << 52))) / weight


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Add ``target`` to ``sizes(source, source_size)``, a row for each source.

    In order of the level at which a source is exhausted, the level that the sources
    before it leave tells whether it is; the rest share what is left by weight.
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    number = (F.row_number().over(by_name) - 1) % len(weights) + 1
    full = most * F.col("source_size").cast("double")
    named = sizes.withColumn("weight", F.element_at(cycle, number)).withColumn("full", full)
    everything = W.partitionBy(F.lit(1))
    by_level = W.orderBy(F.col("full") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(W.unboundedPreceding, -1)
    rest = by_level.rowsBetween(0, W.unboundedFollowing)
    level = (
        F.sum("source_size").over(everything) - F.coalesce(F.sum("full").over(before), F.lit(0.0))
    ) / F.sum("weight").over(rest)
    exhausted = named.withColumn("exhausted", F.col("full") / F.col("weight") <= level)
    taken = F.sum(F.when(F.col("exhausted"), F.col("full")).otherwise(0.0)).over(everything)
    sharing = F.sum(F.when(F.col("exhausted"), 0.0).otherwise(F.col("weight"))).over(everything)
    share = (F.sum("source_size").over(everything) - taken) / sharing * F.col("weight")
    target = F.when(F.col("exhausted"), F.col("full")).otherwise(share)
    return exhausted.withColumn("target", target).select("source", "source_size", "target")


def mixed_rows(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Add ``source_size, target, copies, taken`` to rows with ``source, size, key, tie``.

    ``copies`` is how often the mix takes the document, ``taken`` its words times that.
    """
    n_ranges = max(LEAST_RANGES, docs.count() // RANGE_ROWS)
    where = F.least(F.floor((1 - F.exp(-F.col("key"))) * n_ranges), F.lit(n_ranges - 1))
    rows = docs.withColumn("_range", where.cast("int"))
    parts = rows.groupBy("source", "_range").agg(F.sum("size").alias("part"))
    sums = targets(parts.groupBy("source").agg(F.sum("part").alias("source_size")), weights, most)
    earlier = W.partitionBy("source").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    starts = parts.withColumn("_start", F.coalesce(F.sum("part").over(earlier), F.lit(0)))
    known = starts.alias("p").join(
        sums.alias("s"), F.expr("p.source <=> s.source")
    ).select("p.source", "p._range", "_start", "source_size", "target").alias("k")
    joined = rows.alias("r").join(
        known, F.expr("r.source <=> k.source AND r._range = k._range")
    ).select("r.*", "_start", "source_size", "target")
    order = W.partitionBy("source", "_range").orderBy("key", "doc_id", "size", "tie")
    inside = F.sum("size").over(order.rowsBetween(W.unboundedPreceding, W.currentRow))
    before = F.col("_start") + inside - F.col("size")
    size = F.col("source_size")
    epochs = F.when(size > 0, F.least(F.floor(F.col("target") / size), F.lit(most))).otherwise(1)
    rest = F.col("target") - F.col("_epochs") * size
    picked = (2 * F.col("_before") + F.col("size") <= 2 * rest) & (rest > 0)
    return (
        joined.withColumn("_before", before)
        .withColumn("_epochs", epochs.cast("long"))
        .withColumn("copies", F.col("_epochs") + picked.cast("long"))
        .withColumn("taken", F.col("copies") * F.col("size"))
        .drop("_range", "_start", "_before", "_epochs")
    )


def keyed(docs: DataFrame, labels: DataFrame, keep_text: bool = True) -> DataFrame:
    """``docs(doc_id, text, source)`` with ``size``, ``key`` and the tie-breaker ``tie``.

    Quality weights come from ``labels(doc_id, quality)``: GOOD, POOR, or 1 without a label.
    ``keep_text=False`` leaves the texts behind before rows are shuffled.
    """
    quality = labels.groupBy("doc_id").agg(F.max("quality").alias("_quality"))
    weight = F.when(F.col("_quality") >= 1, F.lit(GOOD)).when(F.col("_quality") < 1, F.lit(POOR))
    sized = (
        docs.withColumn("size", word_count(F.col("text")))
        .withColumn("tie", F.xxhash64("text"))
        .withColumn("_identity", identity(F.col("doc_id"), F.col("text")))
    )
    if not keep_text:
        sized = sized.drop("text")
    return (
        sized.join(quality, "doc_id", "left")
        .withColumn("key", sample_key(F.col("_identity"), F.coalesce(weight, F.lit(1.0))))
        .drop("_quality", "_identity")
    )


def mix(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, size, source_size, target, taken, copies`` for each row of ``docs``."""
    rows = keyed(docs.select("doc_id", "text", "source"), labels, keep_text=False)
    rows = stored(rows, "sizes")
    return mixed_rows(rows).select("doc_id", "size", "source_size", "target", "taken", "copies")


# The rows of ``mix`` in DuckDB SQL, for tables whose ids are unique.
MIX_SQL = rf"""
WITH quality AS (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id),
sized AS (
  SELECT d.doc_id, d.source,
    coalesce(len(regexp_extract_all(d.text, '[^ 	-
]+')), 0)::BIGINT AS size,
    -ln((('0x' || substr(md5('{SEED}:' || coalesce(d.doc_id::VARCHAR, md5(coalesce(d.text, '')))), 1, 13))::BIGINT + 0.5)
      / {float(1 << 52)}) / CASE WHEN quality >= 1 THEN {GOOD} WHEN quality < 1 THEN {POOR}
      ELSE 1.0 END AS key
  FROM documents d LEFT JOIN quality USING (doc_id)),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, {MOST} * sum(size)::DOUBLE AS full_size,
    [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1]::DOUBLE AS weight
  FROM sized GROUP BY source),
levels AS (
  SELECT *, full_size / weight <= (sum(source_size) OVER ()
      - coalesce(sum(full_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS exhausted
  FROM sources WINDOW o AS (ORDER BY full_size / weight, source NULLS LAST)),
targets AS (
  SELECT source, source_size, CASE WHEN exhausted THEN full_size ELSE
    (sum(source_size) OVER () - sum(CASE WHEN exhausted THEN full_size ELSE 0 END) OVER ())
    / sum(CASE WHEN exhausted THEN 0 ELSE weight END) OVER () * weight END AS target
  FROM levels),
run AS (
  SELECT doc_id, size, source_size, target, sum(size) OVER (PARTITION BY s.source
      ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS earlier,
    CASE WHEN source_size > 0 THEN least(floor(target / source_size), {MOST}) ELSE 1 END AS epochs
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
copied AS (
  SELECT *, (epochs + CASE WHEN 2 * earlier + size <= 2 * (target - epochs * source_size)
    AND target - epochs * source_size > 0 THEN 1 ELSE 0 END)::BIGINT AS copies FROM run)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies FROM copied
"""
