"""All queries of the library and their SQL."""

from __future__ import annotations

from quayflow.plans import catalogue, catalogue_sql, operations, operations_sql

QUERIES = {**catalogue.QUERIES, **operations.QUERIES}
ORACLE_SQL = {**catalogue_sql.ORACLE_SQL, **operations_sql.ORACLE_SQL}
