"""Fetched stop responses to the event topic."""

from __future__ import annotations

from collections.abc import Sequence

from quayflow.jobs.arguments import parser
from quayflow.plans.publish import publish_events
from quayflow.schemas import FETCH_OUTCOME
from quayflow.session import build_session, remove_scratch
from quayflow.sinks.kafka import write_records
from quayflow.sources.tables import stops_csv


def main(argv: Sequence[str] | None = None) -> None:
    options = parser(__doc__, "servers", "topic", "stops", "outcomes", "event-source")
    args = options.parse_args(argv)
    spark = build_session("publish events")
    outcomes = spark.read.schema(FETCH_OUTCOME).parquet(args.outcomes)
    counts = publish_events(
        stops_csv(spark, args.stops),
        outcomes,
        args.event_source,
        lambda events: write_records(events, args.servers, args.topic),
    )
    remove_scratch(spark)
    print(f"stops: {counts.total}, sent: {counts.ok}, failed: {counts.failed}")


if __name__ == "__main__":
    main()
