"""Registry of queries and their plain-SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .checks import sql

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
TWINS: dict[str, str] = {}


def query(name: str, twin: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``twin`` is SQL that may name check blocks as @block."""
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if twin is not None:
            TWINS[name] = sql(twin)
        return fn
    return add


def load() -> None:
    """Import the modules that register queries."""
    from . import file_queries, genome_queries, matrix_queries, pair_queries, read_queries  # noqa: F401
