"""Metrics topic to points, in a time-series store or Parquet; unreadable messages aside."""

from __future__ import annotations

from collections.abc import Sequence

from quayflow.jobs.arguments import parser, require_store
from quayflow.operators.metrics import HOST_TAG
from quayflow.session import build_session
from quayflow.sources.kafka import metrics_stream
from quayflow.streaming.control import wait
from quayflow.streaming.metrics_ingest import file_sink, start_metrics_ingest, store_sink


def main(argv: Sequence[str] | None = None) -> None:
    options = parser(
        __doc__,
        "servers",
        "metrics-topic",
        "measurement",
        "rejected",
        "state",
        points=None,
        metrics_group=None,
        store_url=None,
        store_org=None,
        store_bucket=None,
        store_token=None,
        interval="30 seconds",
    )
    options.add_argument("--once", action="store_true", help="stop when the backlog is done")
    options.add_argument("--max-offsets", type=int, help="records in a batch at most")
    options.add_argument("--min-partitions", type=int, help="tasks that read the topic")
    options.add_argument("--host", default=HOST_TAG, help="value of the rm_host tag")
    options.add_argument("--sink", choices=["store", "parquet"], default="store")
    args = options.parse_args(argv)
    if args.sink == "store":
        require_store(options, args)
    if args.sink == "parquet" and not args.points:
        options.error("--points is required for the file sink")
    if args.sink == "parquet":
        sink = file_sink(args.points, args.rejected)
    else:
        sink = store_sink(
            args.rejected,
            url=args.store_url,
            org=args.store_org,
            bucket=args.store_bucket,
            token=args.store_token,
        )
    spark = build_session("metrics ingest")
    wait(
        start_metrics_ingest(
            metrics_stream(
                spark,
                args.servers,
                args.metrics_topic,
                args.metrics_group,
                max_offsets_per_trigger=args.max_offsets,
                min_partitions=args.min_partitions,
            ),
            args.measurement,
            sink,
            args.state,
            topic=args.metrics_topic,
            interval=args.interval,
            available_now=args.once,
            host=args.host,
        )
    )


if __name__ == "__main__":
    main()
