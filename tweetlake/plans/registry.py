"""Named queries over the deployment's tables, each paired with an equivalent SQL text.

Every query reads whole tables from ``sf_dir`` (or data Spark derives from them) and returns a
DataFrame; computed columns carry the same names as in the SQL so results compare directly.
Queries whose result SQL cannot state (model fits judged by their own invariants only) have
no SQL text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``key`` with its SQL equivalent."""
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql.strip()
        return fn
    return deco


def load_all() -> None:
    """Import the query modules (each registers its queries on import)."""
    from tweetlake.plans import holdout_queries, io_queries, ml_queries, programs, stem_queries, text_queries  # noqa: F401
