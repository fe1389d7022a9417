"""Registry of the maritime queries and their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable
from functools import cache
from importlib import import_module

_QUERIES: dict[str, Callable] = {}
_SQL: dict[str, str] = {}
MODULES = ("correlation", "filtering", "joining", "aggregation", "projection", "imagery", "transfer")


def query(name: str, sql: str | None = None):
    """Registers fn(spark, sf_dir) under name, with the SQL that DuckDB runs for the same rows."""
    def add(fn: Callable) -> Callable:
        if name in _QUERIES:
            raise ValueError(f"{name} is registered twice")
        _QUERIES[name] = fn
        if sql:
            _SQL[name] = sql
        return fn
    return add


@cache
def _load() -> None:
    for m in MODULES:
        import_module(f"pelagos.plans.{m}")


def queries() -> dict[str, Callable]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)
