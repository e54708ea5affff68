"""Registry of named queries (Spark callables) and their DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillbook.sources.adapters import with_adapters

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None, adapters: tuple[str, ...] = ()):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name`` with an optional SQL oracle.

    ``adapters`` names the FIXTURES §4 views the oracle reads; they are prefixed as CTEs.
    Queries without an oracle get the driver's weaker rows-only check.
    """
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query name {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = with_adapters(oracle, *adapters)
        return fn
    return deco
