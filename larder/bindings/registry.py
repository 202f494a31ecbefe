"""Where queries and their SQL are collected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    """Register a query under its function's name, together with the equal SQL."""

    def add(function: Query) -> Query:
        QUERIES[function.__name__] = function
        ORACLE_SQL[function.__name__] = sql
        return function

    return add
