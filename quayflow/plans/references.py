"""Catalogue extracts to the stop and line reference tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from quayflow.operators.reference import (
    ROI_STATIONS,
    identify_lines,
    identify_stops,
    observed_lines,
    select_lines,
    select_roi_stops,
)


def stop_reference(
    candidates: DataFrame, stations: Mapping[str, str] = ROI_STATIONS, whole_words: bool = False
) -> DataFrame:
    """The eight columns of the stop table, for the stations of interest."""
    return identify_stops(select_roi_stops(candidates, stations, whole_words=whole_words)).select(
        "id",
        "name",
        "stop_type",
        "town",
        "name_norm",
        "roi_station",
        "stop_numeric_id",
        "siri_monitoring_ref",
    )


def line_reference(
    catalogue: DataFrame, passages: DataFrame, selection: DataFrame | None = None
) -> DataFrame:
    """Catalogue lines with their real-time reference, as far as it was observed.

    ``selection(line_id, roi_label)`` names the lines of the region and their labels,
    which the curated job needs unless the catalogue already has them.
    """
    lines = catalogue if selection is None else select_lines(catalogue, selection)
    return observed_lines(identify_lines(lines), passages)
