"""Lost and repeated offsets of the raw layer, as Parquet."""

from __future__ import annotations

from collections.abc import Sequence

from quayflow.jobs.arguments import parser
from quayflow.operators.offsets import offset_report
from quayflow.session import build_session, remove_scratch
from quayflow.sources.tables import raw_table


def main(argv: Sequence[str] | None = None) -> None:
    options = parser(__doc__, "raw", "report", ingest_date=None)
    args = options.parse_args(argv)
    spark = build_session("offset report")
    report = offset_report(raw_table(spark, args.raw, args.ingest_date))
    report.write.mode("overwrite").parquet(args.report)
    remove_scratch(spark)


if __name__ == "__main__":
    main()
