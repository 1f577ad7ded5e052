"""Cluster-metrics messages, one to a line of text files, to the metrics topic."""

from __future__ import annotations

from collections.abc import Sequence

from quayflow.jobs.arguments import parser
from quayflow.plans.publish import publish_metrics
from quayflow.session import build_session
from quayflow.sinks.kafka import write_records
from quayflow.sources.tables import message_lines


def main(argv: Sequence[str] | None = None) -> None:
    options = parser(__doc__, "servers", "metrics-topic", "messages")
    args = options.parse_args(argv)
    spark = build_session("publish metrics")
    publish_metrics(
        message_lines(spark, args.messages),
        "message",
        lambda records: write_records(records, args.servers, args.metrics_topic),
    )


if __name__ == "__main__":
    main()
