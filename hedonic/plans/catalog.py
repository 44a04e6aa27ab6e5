"""Registry of named queries over the test tables and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    ops: str


REGISTRY: dict[str, Query] = {}


def query(name: str, ops: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name`` with its oracle SQL."""
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, ops)
        return fn
    return deco


def load_all() -> dict[str, Query]:
    # importing the modules registers their queries
    import importlib
    for mod in MODULES:
        importlib.import_module(f"hedonic.plans.{mod}")
    return REGISTRY


MODULES = ["q_pairs", "q_clean", "q_slices", "q_condo", "q_neighbors", "q_evaluate", "q_encode", "q_io", "q_models",
           "q_retrain", "q_state"]
