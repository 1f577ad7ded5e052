"""Repeated reports of one visit: the last one of each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VISIT_KEYS = ("monitoring_ref", "item_identifier")
# Of reports recorded at the same time the later record counts.
REPORT_ORDER = ("kafka_timestamp", "kafka_topic", "kafka_partition", "kafka_offset", "item_identifier")


def last_reports(
    visits: DataFrame,
    keys: Sequence[str] = VISIT_KEYS,
    gap: str = "2 hours",
    time: str = "recorded_at_time",
) -> DataFrame:
    """The last report of each visit, with ``n_reports``, ``first_reported`` and ``settled_at``.

    A stop that is polled sends each visit again and again. Reports with equal ``keys`` are
    of one visit as long as none of them is recorded more than ``gap`` after the one before;
    ``settled_at`` is ``gap`` after the last. Rows without a recording time or without a key
    have no visit and are left out.

    The same code runs on a stream with a watermark on ``time``: there a visit comes out once
    the watermark has passed ``settled_at``, and only the open visits are kept as state.
    """
    known = visits.dropna(subset=[time, *keys])
    order = F.struct(*[F.col(name) for name in dict.fromkeys((time, *REPORT_ORDER))])
    settled = known.groupBy(F.session_window(time, gap).alias("open"), *keys).agg(
        F.max_by(F.struct(*visits.columns), order).alias("report"),
        F.count(F.lit(1)).alias("n_reports"),
    )
    return settled.select(
        "report.*",
        "n_reports",
        F.col("open.start").alias("first_reported"),
        F.col("open.end").alias("settled_at"),
    )
