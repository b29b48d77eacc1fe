"""Name -> (Spark query, oracle SQL) registry filled by the plan modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``; ``sql`` is the
    DuckDB oracle over the pre-registered table views (None: rows-only check)."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


def load_all() -> None:
    """Import every plan module so that its queries register."""
    from pickwise.plans import (collab_plans, content_plans, eval_plans,  # noqa: F401
                                popularity_plans, rerank_plans, sequence_plans,
                                source_plans, stream_plans, model_plans)
