"""All queries of the library and the SQL that must give the same rows."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}
#: Modules that register queries.
_MODULES = ("rollups", "joins", "sequences", "shaping", "text", "statistics", "checks", "creative_marts", "detect", "cuts", "beats", "media", "stores")


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its name, with SQL for the same rows if there is any."""

    def register(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return register


def _loaded() -> None:
    for m in _MODULES:
        importlib.import_module(f"tempograin.plans.{m}")


def queries() -> dict[str, Query]:
    _loaded()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _loaded()
    return dict(_SQL)
