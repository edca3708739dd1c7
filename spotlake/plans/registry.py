"""The registered queries and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .views import duckdb_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def register(sql: str = "", *names: str):
    """Register a query by its function's name; ``names``: derived views that its SQL reads."""

    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            views = ", ".join(f"{n} as ({duckdb_sql(n)})" for n in names)
            body = sql.strip()
            if views:
                body = f"with {views}, {body[5:]}" if body.startswith("with ") else f"with {views} {body}"
            ORACLE_SQL[f.__name__] = body
        return f

    return add
