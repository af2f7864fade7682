"""Registry of the demonstration queries and their SQL checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register ``f(spark, sf_dir)`` under its own name, with the SQL that gives the same rows."""

    def wrap(f):
        key = name or f.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} registered twice")
        QUERIES[key] = f
        if sql is not None:
            ORACLES[key] = sql
        return f

    return wrap
