"""Registry of named queries: ``name -> (spark, sf_dir) -> DataFrame`` plus an
optional DuckDB oracle SQL string over the same parquet tables.

Names follow SURVEY §2 ids (``g03_revenue_by_category``).  A query without an
oracle is checked on rows only (non-SQL operators such as ML fits).
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Decorator registering a query (and its oracle SQL when given)."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"duplicate query name {name}")
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLES[name] = sql.strip()
        return fn
    return deco


PLAN_MODULES = ("reports", "roundtrips", "relational", "quality", "textops", "mlops",
                "scans", "jobs", "streams")


def _load_all() -> None:
    # importing the modules runs their @query decorators
    import importlib
    for m in PLAN_MODULES:
        importlib.import_module(f"cauce.plans.{m}")


def all_queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(_QUERIES)


def all_oracles() -> dict[str, str]:
    _load_all()
    return dict(_ORACLES)
