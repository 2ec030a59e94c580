"""Registry of named queries and their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from stockwise.plans.oracle_views import with_views

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    name: str
    fn: QueryFn
    oracle: str | None


_REGISTRY: dict[str, Entry] = {}


def register(name: str, oracle: str | None = None, extra_ctes: dict[str, str] | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``.

    ``oracle`` is DuckDB SQL over the base tables and the domain-view names
    of ``oracle_views``; the needed view CTEs are prepended automatically.
    """

    def deco(fn: QueryFn) -> QueryFn:
        if name in _REGISTRY:
            raise ValueError(f"duplicate query name {name}")
        sql = with_views(oracle, extra_ctes) if oracle is not None else None
        _REGISTRY[name] = Entry(name, fn, sql)
        return fn

    return deco


def entries() -> dict[str, Entry]:
    import stockwise.plans.catalog  # noqa: F401  (imports every plan module)

    return dict(_REGISTRY)
