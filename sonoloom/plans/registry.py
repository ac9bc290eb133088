"""Registered queries: name -> Spark callable, and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(check: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with its check SQL where one exists."""

    def register(function: Query) -> Query:
        key = name or function.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        QUERIES[key] = function
        if check is not None:
            CHECKS[key] = check
        return function

    return register
