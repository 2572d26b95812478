"""Registry of named queries: each is `(spark, sf_dir) -> DataFrame`, optionally paired with
an ANSI/DuckDB SQL oracle over the raw tables that must return the same rows and columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE_SQL[name] = oracle
        return fn
    return deco


def load_all() -> None:
    """Import every query module so their `register` calls run."""
    from . import (bar_queries, basic_queries, flow_queries, io_queries)  # noqa: F401
