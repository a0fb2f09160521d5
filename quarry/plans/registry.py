"""Query catalogue: every registered query is ``(spark, sf_dir) -> DataFrame``
over the driver tables, optionally paired with an equivalent DuckDB SQL text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    """Decorator: add a query (and its SQL oracle, when expressible) to the catalogue."""
    def wrap(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return wrap


PLAN_MODULES = ["text_plans", "links_plans", "repo_plans", "code_plans", "sft_plans", "quality_plans", "vector_plans", "block_plans", "discovery_plans", "review_plans", "doc_plans", "source_plans", "io_plans"]


def load_all() -> None:
    """Import every plan module so their queries register."""
    import importlib

    for m in PLAN_MODULES:
        importlib.import_module(f"quarry.plans.{m}")
