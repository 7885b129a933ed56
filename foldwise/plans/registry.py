"""Registry of named queries and their SQL oracles.

Each query is ``fn(spark, sf_dir) -> DataFrame``; the oracle is an SQL string DuckDB runs over
the same Parquet tables. Both sides alias every computed column identically and round doubles
to 6 decimals, so the results compare as values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def load_all() -> None:
    """Import every query module so it registers itself."""
    from foldwise.plans import (  # noqa: F401
        q_clean, q_profile, q_fit, q_text, q_model, q_tracking, q_io, q_pipeline, q_stream)
