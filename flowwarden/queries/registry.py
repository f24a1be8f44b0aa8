from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from flowwarden.plans.bindings import with_views
from flowwarden.session import apply_settings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, views: tuple[str, ...] = ()):
    """Register a function under its own name, with SQL over the given tables and views."""

    def register(fn):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(apply_settings(spark), sf_dir)

        if fn.__name__ in QUERIES:
            raise ValueError(f"registered twice: {fn.__name__}")
        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLES[fn.__name__] = with_views(sql, list(views))
        return run

    return register
