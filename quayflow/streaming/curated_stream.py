"""Raw rows to the curated layer as a stream, with hot lines spread as they come up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from quayflow.functions.times import TimeMode
from quayflow.operators.hot_lines import SHARE, hot_lines, join_hot_lines, seen_lines, shares_of, widths
from quayflow.operators.lines import is_broadcast, line_marks, on_marked_lines, roi_only
from quayflow.operators.passages import project_passages, visits_of
from quayflow.schemas import LINE_COLUMNS
from quayflow.sinks.files import CODEC, GROUP_BYTES, unsorted_writes
from quayflow.streaming.control import DEFAULT_INTERVAL, triggered


class HotLines:
    """Shares of the lines that were hot in the last batches, halved with each batch.

    Holds the few lines above ``share`` only, so its size does not grow with the lines.
    """

    def __init__(self, share: float = SHARE):
        self.share = share
        self.shares: dict[str, float] = {}

    def seen(self, batch: dict[str, float]) -> None:
        names = self.shares.keys() | batch.keys()
        mixed = {n: (self.shares.get(n, batch.get(n, 0.0)) + batch.get(n, 0.0)) / 2 for n in names}
        self.shares = {n: s for n, s in mixed.items() if s >= self.share / 2}


def start_curated_stream(
    raw: DataFrame,
    lines: DataFrame,
    path: str,
    checkpoint: str,
    *,
    times: TimeMode = "tolerant",
    tasks: int | None = None,
    hot: HotLines | None = None,
    partitions: Sequence[str] = ("ingest_date", "roi_label"),
    interval: str = DEFAULT_INTERVAL,
    available_now: bool = False,
) -> StreamingQuery:
    """Append the curated rows of each batch of raw rows under ``path/batch_id=...``.

    Adaptive execution does not split the hot partitions of a stream's join, and a reference
    table that is too large to broadcast then puts a hot line in one task. Each batch is
    written with the lines spread that were hot in the ones before, and what it holds itself
    is counted on the way, so its documents are parsed once and nothing of it is kept. Where
    they are too many to broadcast, the lines of interest and their marks are read for the
    first batch and cached, so a table that changes is seen by the next start. A batch that
    runs again replaces its folder.
    """
    known = hot or HotLines()
    n_tasks = tasks or int(raw.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    marks = None
    if not is_broadcast(lines):
        lines = roi_only(lines.select("siri_line_ref", *LINE_COLUMNS)).persist()
        marks = line_marks(lines).repartition(1).persist()  # 8 MB at most

    def write_batch(batch: DataFrame, number: int) -> None:
        visits, seen = seen_lines(visits_of(batch), known.share)
        near = visits if marks is None else on_marked_lines(visits, lines, marks)
        joined = join_hot_lines(near, lines, widths(known.shares, n_tasks))
        rows = project_passages(roi_only(joined), times, LINE_COLUMNS)
        # one file for each task and partition would be as many as rows, or nearly
        writer = rows.hint("rebalance", *partitions).write.mode("overwrite")
        writer = writer.option("compression", CODEC).option("parquet.block.size", GROUP_BYTES)
        with unsorted_writes(batch.sparkSession):
            writer.partitionBy(*partitions).parquet(f"{path}/batch_id={number}")
        shares = shares_of(seen, known.share)
        if shares is None:  # no visit on a line of interest: at most 1 / share rows to collect
            found = hot_lines(visits_of(batch), known.share).collect()
            shares = {row.line_ref: row.share for row in found}
        known.seen(shares)

    writer = raw.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    return triggered(writer, interval, available_now).start()
