"""Row-by-row comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import math
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def _cell(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return (type(value).__name__, value)


def _rows(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def duckdb_rows(sql: str, sf_dir: str) -> tuple[list[str], Counter]:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    cursor = con.execute(sql)
    names = [column[0] for column in cursor.description]
    return sorted(names), _rows(names, cursor.fetchall())


def spark_rows(df: DataFrame) -> tuple[list[str], Counter]:
    return sorted(df.columns), _rows(df.columns, df.collect())


def difference(spark_result, duckdb_result) -> str | None:
    """None when equal, else a short description."""
    if spark_result[0] != duckdb_result[0]:
        return f"columns {spark_result[0]} != {duckdb_result[0]}"
    only_spark = spark_result[1] - duckdb_result[1]
    only_duckdb = duckdb_result[1] - spark_result[1]
    if not only_spark and not only_duckdb:
        return None
    return (
        f"{sum(only_spark.values())} rows only in Spark, {sum(only_duckdb.values())} only in "
        f"DuckDB, e.g. {next(iter(only_spark), None)} and {next(iter(only_duckdb), None)}"
    )
