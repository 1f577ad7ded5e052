"""Lines that hold a large share of the visits, and a join that spreads only those."""

from __future__ import annotations

import math

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from quayflow.schemas import LINE_COLUMNS

SHARE = 0.05
TRACKED = 1_000  # lines a sketch follows: shares are right to about 1 / TRACKED


def hot_lines(visits: DataFrame, share: float = SHARE) -> DataFrame:
    """``line_ref, share`` of the lines with at least ``share`` of the visits, about.

    Each task keeps a sketch of its most frequent lines and sends nothing else, so neither
    the lines nor the visits are shuffled; at most ``1 / share`` lines come out.
    """
    most = math.ceil(1 / share)
    top = f"approx_top_k(line_ref, {most}, {max(TRACKED, most)}) FILTER (WHERE line_ref IS NOT NULL)"
    found = visits.agg(F.expr(top).alias("top"), F.count(F.lit(1)).alias("total"))
    rated = found.select(F.explode("top").alias("t"), "total")
    shares = rated.select(
        F.col("t.item").alias("line_ref"), (F.col("t.count") / F.col("total")).alias("share")
    )
    return shares.where(F.col("share") >= share)


def seen_lines(visits: DataFrame, share: float = SHARE) -> tuple[DataFrame, Observation]:
    """Visits that are counted as :func:`hot_lines` does, whenever they are read; read what was
    found by :func:`shares_of` after the action."""
    most = math.ceil(1 / share) + 1  # visits on no line may take a place
    top = f"approx_top_k(line_ref, {most}, {max(TRACKED, most)})"
    seen = Observation()
    counted = visits.observe(seen, F.expr(top).alias("top"), F.count(F.lit(1)).alias("total"))
    return counted, seen


def shares_of(seen: Observation, share: float = SHARE) -> dict[str, float] | None:
    """The lines with at least ``share`` of the visits, about; None if nothing was counted, as
    adaptive execution replaces a plan without any result, and the count with it."""
    try:
        found = seen.get
    except Py4JJavaError:
        return None
    shares = {item["item"]: item["count"] / found["total"] for item in found["top"] or []}
    return {line: s for line, s in shares.items() if line is not None and s >= share}


def widths(shares: dict[str, float], tasks: int) -> dict[str, int]:
    """Over how many tasks each hot line is spread, as its share of all tasks asks for."""
    return {line: max(2, round(share * tasks)) for line, share in shares.items()}


def join_hot_lines(visits: DataFrame, lines: DataFrame, width: dict[str, int]) -> DataFrame:
    """``join_lines`` with the lines in ``width`` spread over so many tasks each.

    Only the reference rows of those lines are repeated.
    """
    if not width:
        width = {"": 1}
    record = F.xxhash64("kafka_topic", "kafka_partition", "kafka_offset")
    salted = visits.withColumn("fact_salt", F.pmod(record, _width(F.col("line_ref"), width)))
    dimension = lines.select(F.col("siri_line_ref").alias("join_line_ref"), *LINE_COLUMNS)
    last = _width(F.col("join_line_ref"), width) - 1
    repeated = dimension.withColumn("line_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    on = (salted["line_ref"] == repeated["join_line_ref"]) & (
        salted["fact_salt"] == repeated["line_salt"]
    )
    return salted.join(repeated, on, "left").drop("join_line_ref", "fact_salt", "line_salt")


def _width(line: Column, width: dict[str, int]) -> Column:
    pairs = [F.lit(x) for item in sorted(width.items()) for x in item]
    found = F.element_at(F.create_map(*pairs), line)
    return F.coalesce(found, F.lit(1)).cast("bigint")
