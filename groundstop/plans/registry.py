"""Registry of named queries: ``key -> (spark, sf_dir) -> DataFrame`` and oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}
BENCH: list[str] = []


def query(key: str, oracle: str | None = None, bench: bool = False):
    """Register ``fn`` under ``key`` with its DuckDB oracle (None: rows-only check)."""

    def deco(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if oracle is not None:
            ORACLES[key] = oracle
        if bench:
            BENCH.append(key)
        return fn

    return deco
