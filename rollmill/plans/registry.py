"""Registered queries with their SQL, and what several of them share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_oracles: dict[str, str] = {}


def register(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _queries[f.__name__] = f
        if sql is not None:
            _oracles[f.__name__] = sql
        return f

    return add


def registered() -> dict[str, Query]:
    return dict(_queries)


def registered_sql() -> dict[str, str]:
    return dict(_oracles)
