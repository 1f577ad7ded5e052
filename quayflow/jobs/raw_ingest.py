"""Event topic to raw layer, until stopped or once over what is there."""

from __future__ import annotations

from collections.abc import Sequence

from quayflow.jobs.arguments import parser
from quayflow.session import build_session
from quayflow.sources.kafka import event_stream
from quayflow.streaming.control import wait
from quayflow.streaming.raw_ingest import start_raw_ingest


def main(argv: Sequence[str] | None = None) -> None:
    options = parser(__doc__, "servers", "topic", "raw", "checkpoint", interval="30 seconds")
    options.add_argument("--starting", choices=["earliest", "latest"], default="earliest")
    options.add_argument("--once", action="store_true", help="stop when the backlog is done")
    options.add_argument("--max-offsets", type=int)
    options.add_argument("--min-partitions", type=int)
    args = options.parse_args(argv)
    spark = build_session("raw ingest")
    records = event_stream(
        spark,
        args.servers,
        args.topic,
        starting=args.starting,
        max_offsets_per_trigger=args.max_offsets,
        min_partitions=args.min_partitions,
    )
    wait(
        start_raw_ingest(
            records, args.raw, args.checkpoint, interval=args.interval, available_now=args.once
        )
    )


if __name__ == "__main__":
    main()
