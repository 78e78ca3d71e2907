"""Registry of queries: name, Spark callable and the SQL that must give the same rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pollpipe.session import prepare, shared_dir

Query = Callable[[SparkSession, str], DataFrame]

#: Rows of a landed file; a feed arrives in many files, whatever the layout of its table.
ROWS_PER_FILE = 10_000

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a function ``(spark, sf_dir) -> DataFrame`` under its name."""

    def register(fn: Query) -> Query:
        key = name or fn.__name__
        if key in QUERIES:
            raise ValueError(f"query {key!r} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)

        run.__name__, run.__doc__ = key, fn.__doc__
        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, not yet existing folder in the shared scratch space."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def arrived(df: DataFrame, label: str, kind: str = "parquet") -> str:
    """Folder of files in which ``df``, a feed made from the given tables, has arrived."""
    path = fresh_dir(df.sparkSession, label)
    df.write.option("maxRecordsPerFile", ROWS_PER_FILE).format(kind).save(path)
    return path


def landed(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to and read from the shared scratch space, as if it had arrived there."""
    path = fresh_dir(df.sparkSession, label)
    df.write.option("maxRecordsPerFile", ROWS_PER_FILE).parquet(path)
    return df.sparkSession.read.parquet(path)
