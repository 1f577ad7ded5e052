"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayflow.llm.blocks import stored


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for the nodes of ``links(a, b)``; the smallest node names it.

    Each round every node takes the name, two steps on, of its neighbour that comes first in
    an order of hashes, and the links are renamed accordingly until none joins two names. The
    hashes differ from round to round, so whatever the nodes' names are, a part of them goes
    in each round: a chain takes rounds as the logarithm of its length. Rounds are written
    to the shared folder. The first neighbour is found before the shuffle and the joins are
    plain equality joins, whose hot keys adaptive execution splits. Loops, repeated and null
    links are allowed.
    """
    edges = _both_ways(links.select(F.col("a").cast("long"), F.col("b").cast("long")))
    edges = stored(edges, "links")
    parents = []
    while not edges.isEmpty():
        parent = stored(_two_steps(edges, len(parents)), "parents")
        parents.append(parent)
        renamed = (
            edges.join(parent.toDF("a", "pa"), "a").join(parent.toDF("b", "pb"), "b").select("pa", "pb")
        )
        edges = stored(_both_ways(renamed.toDF("a", "b")), "links")
    if not parents:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    named = parents[0].withColumnRenamed("parent", "name")
    for parent in parents[1:]:
        step = parent.toDF("name", "next")
        named = named.join(step, "name", "left").select(
            "node", F.coalesce("next", "name").alias("name")
        )
    named = stored(named, "named")
    smallest = named.groupBy("name").agg(F.min("node").alias("component"))
    return named.join(smallest, "name").select("node", "component")


def _two_steps(edges: DataFrame, salt: int) -> DataFrame:
    """``node, parent``: each node's first neighbour's first neighbour, or itself."""

    def ranked(name: str) -> Column:
        return F.struct(F.xxhash64(name, F.lit(salt)).alias("rank"), F.col(name).alias("node"))

    first = edges.groupBy("a").agg(F.min(ranked("b")).alias("first"))
    step = first.select(F.col("a").alias("node"), F.least("first", ranked("a"))["node"].alias("parent"))
    return step.join(step.toDF("parent", "next"), "parent").select("node", F.col("next").alias("parent"))


def _both_ways(links: DataFrame) -> DataFrame:
    links = links.filter(F.col("a") != F.col("b"))
    return links.union(links.select("b", "a")).distinct()
