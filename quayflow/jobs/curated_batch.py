"""Raw layer to curated layer, whole or for one ingestion date."""

from __future__ import annotations

from collections.abc import Sequence

from quayflow.jobs.arguments import parser
from quayflow.plans.curated import refresh_curated, refresh_versions
from quayflow.session import build_session


def main(argv: Sequence[str] | None = None) -> None:
    options = parser(__doc__, "raw", "curated-output", "lines", ingest_date=None)
    options.add_argument("--times", choices=["tolerant", "strict"], default="tolerant")
    options.add_argument("--overwrite", choices=["dynamic", "static"], default="dynamic")
    options.add_argument("--versions", action="store_true", help="keep versions with a manifest")
    options.add_argument("--incremental", action="store_true", help="parse new raw files only")
    args = options.parse_args(argv)
    if args.incremental and not args.versions:
        options.error("--incremental needs --versions")
    spark = build_session("curated batch")
    paths = (spark, args.raw, args.lines, args.curated_output)
    if args.versions:
        counts = refresh_versions(
            *paths, ingest_date=args.ingest_date, times=args.times, incremental=args.incremental
        )
    else:
        counts = refresh_curated(
            *paths, ingest_date=args.ingest_date, times=args.times, overwrite=args.overwrite
        )
    for name, value in counts.items():
        print(f"{name}: {value}")


if __name__ == "__main__":
    main()
