"""Landed polls: one JSON envelope per line, written by whatever fetches the feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENVELOPE = T.StructType(
    [
        T.StructField("fetched_at", T.StringType()),
        T.StructField("status_code", T.IntegerType()),
        T.StructField("headers", T.MapType(T.StringType(), T.StringType())),
        T.StructField("url", T.StringType()),
        T.StructField("payload", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)


def read_polls(spark: SparkSession, path: str) -> DataFrame:
    """All landed polls under ``path``; the declared schema saves the inference pass."""
    return spark.read.schema(ENVELOPE).json(path)


def stream_polls(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Newly landed poll files as a stream."""
    reader = spark.readStream.schema(ENVELOPE)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def poll_failure(status: Column, error: Column) -> Column:
    """Why a poll is unusable; NULL for a good one (status 200)."""
    return (
        F.when(status == 200, F.lit(None).cast("string"))
        .when(status.isNull(), F.concat(F.lit("network_error: "), F.coalesce(error, F.lit("no response"))))
        .when(status == 429, "rate_limit_or_quota_exceeded")
        .otherwise(F.concat(F.lit("unexpected_status_"), status.cast("string")))
    )


def classify_polls(polls: DataFrame) -> DataFrame:
    """Adds ``success`` and ``reason``. Only successful polls go on to the explode."""
    reason = poll_failure(F.col("status_code"), F.col("error"))
    return polls.withColumns({"success": reason.isNull(), "reason": reason})
