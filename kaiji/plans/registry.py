"""Registry of named queries and their DuckDB oracle statements."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLE: dict[str, str] = {}
_HEADLINE: list[str] = []

_MODULES = ("filings", "history", "facts", "hierarchy", "master", "sync", "audit", "text", "files", "merge", "archives", "streams")


def register(name: str, oracle: str | None = None, headline: bool = False):
    """Decorator: register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = fn
        if oracle is not None:
            _ORACLE[name] = oracle
        if headline:
            _HEADLINE.append(name)
        return fn
    return deco


def _load() -> None:
    for m in _MODULES:
        importlib.import_module(f"kaiji.plans.{m}")


def queries() -> dict[str, QueryFn]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLE)


def headline() -> list[str]:
    _load()
    return list(_HEADLINE)
