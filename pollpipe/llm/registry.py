"""Queries of the subpackage: name, Spark callable, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pollpipe.session import prepare

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function ``(spark, sf_dir) -> DataFrame`` under its name."""

    def register(fn: Query) -> Query:
        if fn.__name__ in QUERIES:
            raise ValueError(f"query {fn.__name__!r} is registered twice")
        QUERIES[fn.__name__] = lambda spark, sf_dir: fn(prepare(spark), sf_dir)
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register
