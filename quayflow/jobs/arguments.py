"""Command-line options with environment defaults."""

from __future__ import annotations

import argparse
import os

# Environment variables the options fall back to.
ENVIRONMENT = {
    "servers": "KAFKA_BOOTSTRAP_SERVERS",
    "topic": "STOPMON_TOPIC",
    "raw": "RAW_OUTPUT_PATH",
    "checkpoint": "RAW_CHECKPOINT_PATH",
    "lines": "ROI_LINES_CSV",
    "stops": "ROI_STOPS_CSV",
    "ingest-date": "INGEST_DATE_FILTER",
    "curated-output": "CURATED_OUTPUT_PATH",
    "curated": "CURATED_PATH",
    "metrics-topic": "HADOOP_METRICS_TOPIC",
    "metrics-group": "HADOOP_METRICS_GROUP",
    "store-url": "INFLUX_URL",
    "store-org": "INFLUX_ORG",
    "store-bucket": "INFLUX_BUCKET",
    "store-token": "INFLUX_TOKEN",
    "measurement": "INFLUX_MEASUREMENT",
}


def parser(description: str, *required: str, **optional: str | None) -> argparse.ArgumentParser:
    """Parser with the named options; an option is required when nothing else sets it."""
    result = argparse.ArgumentParser(description=description)
    defaults = {name.replace("_", "-"): value for name, value in optional.items()}
    for name in (*required, *defaults):
        variable = ENVIRONMENT.get(name)
        default = (os.environ.get(variable) if variable else None) or defaults.get(name)
        hint = f"default: ${variable}" if variable else None
        must = name in required and default is None
        result.add_argument(f"--{name}", default=default, required=must, help=hint)
    return result


def require_store(options: argparse.ArgumentParser, args: argparse.Namespace) -> None:
    """Stop before the session starts unless all settings of the point store are there."""
    names = ("store_url", "store_org", "store_bucket", "store_token")
    missing = [f"--{name.replace('_', '-')}" for name in names if not getattr(args, name)]
    if missing:
        options.error(f"the point store needs {', '.join(missing)}")
