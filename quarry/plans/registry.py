"""Registered queries: one per operator, each ``(spark, sf_dir) -> DataFrame``,
with the DuckDB oracle text when the operator is SQL-expressible.

Every query reads the driver's tables (``events`` via the raw fixture) so its
work grows with them; no row caps, id subsets or samples are applied to make
the check cheap.  Limits appear only where the limit is the feature (top-k
reports, ``preview``, sampling operators).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from quarry.plans import (queries_anomaly, queries_batch, queries_forest,  # noqa: F401
                              queries_ingest, queries_rules, queries_views)
