"""PySpark building blocks for nested stop-monitoring events.

Keyed JSON events are landed in a raw Parquet layer, flattened and enriched
into a curated layer, and turned into time-series points. Every step is a
function from DataFrame to DataFrame made of built-in Spark expressions.
"""
