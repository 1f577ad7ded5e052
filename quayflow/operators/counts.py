"""Row counts, as queries and alongside a job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def row_count(df: DataFrame, name: str = "rows") -> DataFrame:
    """Number of rows, as a one-row frame. Batch only."""
    return df.agg(F.count(F.lit(1)).alias(name))


def counted(df: DataFrame, **extra: Column) -> tuple[DataFrame, Observation]:
    """Count ``rows`` and other aggregates while a job reads ``df``, without another pass.

    Read ``observation.get`` after the job. The numbers are for logs: when a lost
    executor makes Spark run a map task again, its rows are counted again.
    """
    observation = Observation()
    aggregates = [value.alias(name) for name, value in extra.items()]
    return df.observe(observation, F.count(F.lit(1)).alias("rows"), *aggregates), observation
