"""Preparation of the stop and line reference tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayflow.functions.texts import line_code, line_ref, normalise_name, stop_number, stop_ref

# Station labels of the region of interest and the normalised
# name each one is recognised by.
ROI_STATIONS = {
    "NOISY_MONT_EST": "noisy le grand mont d est",
    "NOISY_CHAMPS": "noisy champs",
    "LA_DEFENSE": "la defense",
    "HAVRE_CAUMARTIN": "havre caumartin",
    "VAL_DE_FONTENAY": "val de fontenay",
    "GARE_DE_LYON": "gare de lyon",
    "AUBER": "auber",
    "ROSA_PARKS": "rosa parks",
    "OLYMPIADES": "olympiades",
}


def identify_stops(candidates: DataFrame) -> DataFrame:
    """Add the numeric identifier and the reference real-time responses use."""
    return candidates.withColumn("stop_numeric_id", stop_number(F.col("id"))).withColumn(
        "siri_monitoring_ref", stop_ref(F.col("stop_numeric_id"))
    )


def select_roi_stops(
    stops: DataFrame,
    stations: Mapping[str, str] = ROI_STATIONS,
    name: str = "name",
    whole_words: bool = False,
) -> DataFrame:
    """Stops whose normalised name contains a station keyword, with ``roi_station``.

    A stop that contains several keywords gives one row for each. By name alone,
    so stops of the same name in other towns are taken too; ``whole_words`` keeps
    a keyword from matching inside a longer word. The keywords are literals of the
    expression, so nothing is joined.
    """
    named = stops.withColumn("name_norm", normalise_name(F.col(name)))
    pad, text = "", F.col("name_norm")
    if whole_words:
        pad, text = " ", F.concat(F.lit(" "), text, F.lit(" "))
    hits = F.array_compact(
        F.array(
            *[
                F.when(F.contains(text, F.lit(f"{pad}{keyword}{pad}")), F.lit(station))
                for station, keyword in stations.items()
            ]
        )
    )
    # explode_outer and a filter on its output: see quayflow.operators.passages
    return named.withColumn("roi_station", F.explode_outer(hits)).where(
        F.col("roi_station").isNotNull()
    )


def identify_lines(lines: DataFrame) -> DataFrame:
    """Add the line code and the reference real-time responses use."""
    return lines.withColumn("line_code", line_code(F.col("line_id"))).withColumn(
        "siri_line_ref", line_ref(F.col("line_code"))
    )


def select_lines(lines: DataFrame, selection: DataFrame) -> DataFrame:
    """The lines of ``selection(line_id, roi_label)`` with their label.

    A line with several labels gives a row for each, a label repeated for a line one.
    """
    chosen = selection.select("line_id", "roi_label").where("roi_label IS NOT NULL").distinct()
    return lines.drop("roi_label").join(chosen, "line_id")


def observed_lines(lines: DataFrame, passages: DataFrame) -> DataFrame:
    """Lines whose reference occurs in the real-time data.

    The distinct runs before the join, so each task sends every reference at most
    once and a hot line costs no more than a rare one.
    """
    observed = passages.select(F.col("line_ref").alias("observed_ref")).distinct()
    return lines.join(observed, lines["siri_line_ref"] == observed["observed_ref"], "left_semi")
