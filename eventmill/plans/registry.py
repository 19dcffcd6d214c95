"""Name -> (Spark query, DuckDB oracle SQL) registry.

Each registered callable takes (spark, sf_dir) and returns a DataFrame over the driver
tables (or data Spark derives from them).  Oracle SQL uses the same output column names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from eventmill.session import ensure_session_conf

QueryFn = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query name {name}")
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_session_conf(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        REGISTRY[name] = run
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def _load_all() -> None:
    # Importing the modules fills the registry.
    from eventmill.plans import (analytic_queries, metric_queries, rollup_queries,  # noqa: F401
                                 stream_queries, transform_queries)


def queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(REGISTRY)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(ORACLE)
