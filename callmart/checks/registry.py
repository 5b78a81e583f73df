"""The list of queries and, for each, a SQL statement of what it means."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from callmart.checks.fixtures import CTX, with_views
from callmart.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

# Success of a call, and day keys before the run, for the SQL statements.
OK = "(coalesce(talk_duration > 0, false) or coalesce(code_call_result_type = 'ANSWER', false))"
AS_OF = "timestamp '2024-01-31 00:00:00'"


def d(days: int) -> int:
    return CTX.day_key(days)


def check(name: str, sql: str | None = None, *extra: str):
    """Register a query and its SQL; ``extra`` are named queries the SQL builds on."""

    def register(build: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(configure(spark), folder)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = with_views(sql, *extra)
        return build

    return register
