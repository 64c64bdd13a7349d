"""Registry of named queries and their DuckDB oracle SQL.

Each query is ``f(spark, sf_dir) -> DataFrame`` over the supplied tables.
The oracle is ANSI SQL over the same tables (views named after them) that
computes the same rows; queries with no SQL form register ``sql=None``.
Float outputs are rounded to a fixed number of places on both sides so
the comparison does not depend on summation order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}
GROUPS: dict[str, str] = {}


def register(name: str, sql: str | None, group: str = "misc"):
    """Decorator: register a query under ``name`` with its oracle SQL."""

    def wrap(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query key {name}")
        QUERIES[name] = fn
        GROUPS[name] = group
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return wrap


def load_all() -> None:
    """Import every module that registers queries."""
    from layercake.plans import (  # noqa: F401
        gold_keys,
        quality_keys,
        silver_keys,
        bronze_keys,
        event_keys,
        sequence_keys,
        stream_keys,
        flow_keys,
    )
