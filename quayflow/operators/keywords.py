"""Names that contain any of very many keywords, by an index of character grams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayflow.session import stored

GRAM = 5
BROADCAST_BYTES = 10 << 20  # an index up to here goes to each task, a larger one is shuffled
ENTRY_BYTES = 64  # an entry's share beside its keyword's text


def _with_characters(df: DataFrame, text: str) -> DataFrame:
    """Add ``_chars``; a generator, so that it is made once for each row and not each gram."""
    return df.withColumn("_chars", F.explode(F.array(F.split(F.col(text), ""))))


def _grams(size: Column) -> Column:
    """Distinct runs of ``size`` of ``_chars``."""
    chars = F.col("_chars")
    last = F.size(chars) - size + 1
    places = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(places, lambda at: F.array_join(F.slice(chars, at, size), "")))


def match_keywords(
    names: DataFrame, keywords: DataFrame, name: str = "name_norm", gram: int = GRAM
) -> DataFrame:
    """The rows of ``names`` with each row of ``keywords(keyword, ...)`` whose text they contain.

    Equal to a join on ``contains``, without comparing every name with every keyword: a
    keyword stands in the index under the rarest of its grams of ``gram`` characters, one
    that is shorter under itself, and a name meets the keywords of its own grams by equality.
    What meets is compared whole. Rarity is counted over the names, so a gram that most
    names have is the entry of no keyword that has another. Empty and NULL keywords match
    nothing; repeated keywords are rows of their own. The names' grams are never broadcast:
    the index is, up to ``BROADCAST_BYTES``, and beyond that both are shuffled.
    """
    wanted = keywords.where("keyword <> ''").withColumn("_size", F.least(F.length("keyword"), F.lit(gram)))
    sizes = [row["_size"] for row in wanted.select("_size").distinct().collect()]  # ``gram`` at most
    if not sizes:
        nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in keywords.schema.fields]
        return names.where(F.lit(False)).select(*names.columns, *nothing)
    text = F.col(name)
    every = F.concat(*[_grams(F.lit(size)) for size in sorted(sizes)])
    gramed = _with_characters(names, name).withColumn("_gram", F.explode(every)).drop("_chars")
    once = wanted.groupBy("keyword", "_size").agg(F.count(F.lit(1)).alias("_times"))
    of_keywords = _with_characters(once, "keyword").withColumn("_gram", F.explode(_grams(F.col("_size"))))
    of_keywords = of_keywords.select("keyword", "_times", "_gram")
    # Catalyst does not see how many rows a generator makes, and would send them to the driver
    counts = gramed.groupBy("_gram").agg(F.count(F.lit(1)).alias("_n"))
    # a keyword with a gram that no name has is in no name
    rated = of_keywords.join(counts.hint("merge"), "_gram", "left").withColumn("_n", F.coalesce("_n", F.lit(0)))
    entries = rated.groupBy("keyword").agg(
        F.min(F.struct("_n", "_gram")).alias("_entry"), F.first("_times").alias("_times")
    )
    entries = entries.where("_entry._n > 0").select("keyword", "_times", "_entry._gram")
    entries = stored(entries, "keywords")
    size = entries.agg(F.sum(F.octet_length("keyword") + ENTRY_BYTES)).first()[0] or 0
    entries = entries.hint("broadcast" if size <= BROADCAST_BYTES else "merge")
    met = gramed.join(entries, "_gram").where(F.contains(text, F.col("keyword"))).drop("_gram")
    others = [c for c in keywords.columns if c != "keyword"]
    if not others:
        again = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_times")))
        return met.withColumn("_t", again).select(*names.columns, "keyword")
    row = [F.col(f"`{c}`") for c in keywords.columns]
    return met.join(wanted.select(*row), "keyword").select(*names.columns, *keywords.columns)
