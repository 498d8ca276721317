"""Named queries with the SQL that an independent engine can run on the same tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a function (spark, sf_dir) under its name, with its oracle if SQL can express it."""

    def add(function: Query) -> Query:
        key = name or function.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        QUERIES[key] = function
        if sql is not None:
            ORACLE_SQL[key] = sql
        return function

    return add


def with_sql(body: str, *ctes: str) -> str:
    return ("WITH RECURSIVE " + ",\n".join(ctes) + "\n" if ctes else "") + body
