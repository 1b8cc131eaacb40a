"""Registry of named queries (one per SURVEY operator key) and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditspark.operators import cache

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _fresh(fn):
    """The query, after releasing what earlier queries' operators persisted."""
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        cache.release_all()
        return fn(spark, sf_dir)
    return run


def register(key: str, sql: str | None = None):
    """Register a query ``fn(spark, sf_dir) -> DataFrame`` under ``key`` with optional oracle SQL."""
    def deco(fn):
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = _fresh(fn)
        if sql is not None:
            ORACLES[key] = sql
        return fn
    return deco


def r6(c: str | Column, name: str | None = None) -> Column:
    """Round a double to 6 places for order-insensitive comparison."""
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col, 6).alias(name or (c if isinstance(c, str) else None))


def load_all() -> None:
    """Import every query module so their ``register`` calls run."""
    from creditspark.plans import (  # noqa: F401
        queries_io, queries_quality, queries_prep, queries_profile, queries_woe,
        queries_sampling, queries_models, queries_evaluate, queries_scorecard, queries_closed_form, queries_trees)
