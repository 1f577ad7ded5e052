"""Stop and line catalogues to the reference tables."""

from __future__ import annotations

from collections.abc import Sequence

from quayflow.jobs.arguments import parser
from quayflow.operators.passages import line_refs_of
from quayflow.plans.references import line_reference, stop_reference
from quayflow.session import build_session
from quayflow.sources.tables import lines_csv, raw_table, stops_csv


def main(argv: Sequence[str] | None = None) -> None:
    options = parser(
        __doc__, "stop-catalogue", "line-catalogue", "raw", "stop-output", "line-output"
    )
    options.add_argument("--line-selection", help="CSV of line_id and roi_label")
    options.add_argument("--whole-words", action="store_true")
    args = options.parse_args(argv)
    spark = build_session("prepare references")
    stops = stop_reference(stops_csv(spark, args.stop_catalogue), whole_words=args.whole_words)
    stops.write.mode("overwrite").option("header", True).option("escape", '"').csv(args.stop_output)
    selection = lines_csv(spark, args.line_selection) if args.line_selection else None
    lines = line_reference(
        lines_csv(spark, args.line_catalogue), line_refs_of(raw_table(spark, args.raw)), selection
    )
    lines.write.mode("overwrite").option("header", True).option("escape", '"').csv(args.line_output)


if __name__ == "__main__":
    main()
