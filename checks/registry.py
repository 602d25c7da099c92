"""Registered queries with their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .domain import Domain

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(domain)`` under ``name`` with the SQL that gives the same rows."""

    def register(fn: Callable[[Domain], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Domain(spark, folder))

        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register
