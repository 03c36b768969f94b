"""Registration of queries with their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    """Queries by name, and the SQL that must give the same rows, where SQL can express them."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracle: dict[str, str] = {}

    def add(self, sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
        def put(f: Query) -> Query:
            key = name or f.__name__
            if key in self.queries:
                raise ValueError(f"query {key} is registered twice")
            self.queries[key] = f
            if sql is not None:
                self.oracle[key] = sql
            return f

        return put
