"""Registry of queries and of the SQL each one is checked against."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskweft.sources.transactions import duckdb_views

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def with_views(sql: str, ctes: str = "") -> str:
    """Prefix the SQL with the WITH entries it mentions."""
    views = duckdb_views()
    text = f"{ctes} {sql}"
    used = [f"{name} AS ({body})" for name, body in views.items() if re.search(rf"\b{name}\b", text)]
    parts = used + ([ctes] if ctes else [])
    return f"WITH {', '.join(parts)} {sql}" if parts else sql


def query(name: str, sql: str | None = None, ctes: str = "") -> Callable[[Query], Query]:
    """Register a query, with its DuckDB equivalent when SQL can express it."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = with_views(sql, ctes)
        return function

    return register
