"""Curated layer to points."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayflow.operators.points import kpi_ready, to_points
from quayflow.sources.tables import curated_table


class PointCounts(NamedTuple):
    points: int
    unplaced: int


def export_points(
    spark: SparkSession, curated_path: str, measurement: str, write: Callable[[DataFrame], None]
) -> PointCounts:
    """Convert the rows that have an expected departure and hand them to ``write``.

    ``write`` gets the lazy points frame and runs one action on it; rows go from
    the executors straight to the sink. Returns how many points there are, and how many
    rows have no point as their time is beyond what nanoseconds reach. They are counted
    by a query of their own over the time column, so tasks that run twice count once.
    """
    points = to_points(kpi_ready(curated_table(spark, curated_path)), measurement)
    write(points.where(F.col("time_ns").isNotNull()))
    counts = points.agg(
        F.count("time_ns").alias("points"), F.count_if(F.col("time_ns").isNull()).alias("unplaced")
    )
    return PointCounts(*counts.first())
