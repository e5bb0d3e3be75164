"""Registry of named queries: a DataFrame builder plus (optionally) oracle SQL.

A query without oracle SQL is checked on row counts only, and by pytest
against a brute-force result on a small fixture.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}
OPS: dict[str, str] = {}


def query(name: str, ops: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        OPS[name] = ops
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def load_all() -> None:
    # Importing the modules registers their queries.
    from feedloom.plans import (q_monitor, q_clean, q_sinks, q_screen,  # noqa: F401
                                q_profile, q_xml, q_files, q_load, q_stream)
