"""Registry of the checked queries: each is a Spark plan over the given
tables and, where SQL can say the same thing, the DuckDB oracle SQL that
must give the same rows (same column names, order-insensitive).

Importing ``keelson.plans.checked`` fills the registry.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    """Register a query under ``name`` with its oracle SQL (None: rows-only)."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return deco


def all_queries() -> dict[str, QueryFn]:
    import keelson.plans.checked  # noqa: F401  (fills the registry)
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    import keelson.plans.checked  # noqa: F401
    return dict(ORACLES)
