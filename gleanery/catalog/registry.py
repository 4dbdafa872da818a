"""Named queries over the test tables, each with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without a check only its rows are looked at."""

    def register(run: Query) -> Query:
        QUERIES[name] = run
        if check is not None:
            CHECKS[name] = check
        return run

    return register
