"""Curated layer to points: a time-series store, line protocol text or Parquet."""

from __future__ import annotations

from collections.abc import Sequence

from quayflow.jobs.arguments import parser, require_store
from quayflow.operators.points import line_protocol
from quayflow.plans.export import export_points
from quayflow.session import build_session
from quayflow.sinks.files import write_lines, write_points
from quayflow.sinks.point_store import post_lines
from quayflow.sources.tables import curated_table


def main(argv: Sequence[str] | None = None) -> None:
    options = parser(
        __doc__,
        "curated",
        "measurement",
        store_url=None,
        store_org=None,
        store_bucket=None,
        store_token=None,
        output=None,
    )
    options.add_argument("--sink", choices=["store", "text", "parquet"], default="store")
    options.add_argument("--writers", type=int, help="tasks that call the store at once")
    args = options.parse_args(argv)
    if args.sink == "store":
        require_store(options, args)
    if args.sink != "store" and not args.output:
        options.error("--output is required for a file sink")

    def write(points) -> None:
        if args.sink == "parquet":
            write_points(points, args.output)
        elif args.sink == "text":
            write_lines(line_protocol(points), args.output)
        else:
            post_lines(
                line_protocol(points),
                url=args.store_url,
                org=args.store_org,
                bucket=args.store_bucket,
                token=args.store_token,
                writers=args.writers,
            )

    spark = build_session("point export")
    curated_table(spark, args.curated).printSchema()
    counts = export_points(spark, args.curated, args.measurement, write)
    print(f"points: {counts.points}, rows with a time out of range: {counts.unplaced}")


if __name__ == "__main__":
    main()
