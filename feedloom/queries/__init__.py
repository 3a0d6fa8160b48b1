"""Registered queries, each over whole tables, with equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def register(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with SQL of the same result."""

    def add(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


from feedloom.queries import (  # noqa: E402, F401
    auditing,
    checking,
    loading,
    mapping,
    nesting,
    resolving,
    running,
    scanning,
    transforming,
)
