"""Named queries and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}
_MODULES = ["trip_queries", "text_queries", "table_queries", "vector_queries", "segment_queries", "drift_queries", "run_queries"]


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a function under its name, with the comparison SQL where SQL can say it."""

    def add(fn: Query) -> Query:
        _QUERIES[fn.__name__] = fn
        if sql is not None:
            _SQL[fn.__name__] = sql
        return fn

    return add


def _load() -> None:
    for module in _MODULES:
        import_module(f"segmentry.plans.{module}")


def all_queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def all_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)
