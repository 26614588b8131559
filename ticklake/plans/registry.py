"""Query registry: each entry pairs a Spark plan with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ticklake.bridge import Market

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(market) -> DataFrame`` under ``name``, with its SQL if one exists."""

    def add(fn: Callable[[Market], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: fn(Market(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add
