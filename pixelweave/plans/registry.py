"""Registry of queries and of the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with an equivalent SQL text if there is one."""

    def register(fn: Query) -> Query:
        _QUERIES[fn.__name__] = fn
        if sql is not None:
            _ORACLES[fn.__name__] = sql.strip()
        return fn

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)
