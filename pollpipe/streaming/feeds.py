"""The same layer loads driven by Structured Streaming.

Bronze is stateless and uses the exactly-once file sink. Silver and gold run the batch
loads inside ``foreachBatch``: they merge by key, and rows without a key by a hash of the row,
so a batch that is replayed after a failure changes nothing. Row-offset features cannot be expressed as a streaming
aggregate, hence gold reads its short lookback from the silver table in every batch.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators.explode import explode_polls
from ..operators.features import ChangeSpec
from ..operators.lags import Cut
from ..operators.merge import insert_all, insert_into, one_per_key
from ..plans.features_load import build_features, repair_late_rows
from ..plans.layers import SilverPlan, silver_rows
from ..session import written
from ..sources.tables import DATE, FeedTable
from ..spec import FeedSpec


def stream_bronze(polls: DataFrame, feed: FeedSpec, bronze: FeedTable, checkpoint: str) -> StreamingQuery:
    """All newly landed polls to the bronze path, then stop.

    Each poll file is taken once. The path belongs to this stream: its file log, not the
    folder listing, says which files count, so nothing else may append there.
    """
    rows = bronze.with_date(explode_polls(polls, feed.vendor_fields))
    return (
        rows.writeStream.format("parquet").partitionBy(DATE).outputMode("append")
        .option("path", bronze.location).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def stream_silver(
    bronze: FeedTable, silver: FeedTable, plan: SilverPlan, checkpoint: str, unkeyed: FeedTable, keep_copies: bool = True
) -> StreamingQuery:
    """New bronze rows to silver, insert-only by key, then stop.

    Takes polls however late. Rows without a complete key go to ``unkeyed``.
    """
    spark = bronze.spark
    rows = spark.readStream.schema(bronze.read().schema).parquet(bronze.location)
    typed = silver_rows(rows, plan)

    def merge(batch: DataFrame, _batch_id: int) -> None:
        here = _here(silver, batch)
        rows = written(batch, "batch")
        insert_all(here, _here(unkeyed, batch), rows, plan.feed.key, here.earliest_in(rows), keep_copies)

    return (
        typed.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def stream_features(
    arrivals: DataFrame,
    source: FeedTable,
    target: FeedTable,
    spec: ChangeSpec,
    columns: Sequence[str],
    lookback: dt.timedelta | None,
    checkpoint: str,
    late: str = "drop",
    domain: tuple[str, str] | None = None,
    slicing: Cut | int | str | None = "auto",
) -> StreamingQuery:
    """For every batch of ``arrivals``: insert it into ``source``, then update the features.

    ``late`` says what happens to rows older than the newest feature row: ``"drop"``
    leaves them out for good, ``"repair"`` adds them and recomputes the rows after them.
    """
    if late not in ("drop", "repair"):
        raise ValueError("late must be 'drop' or 'repair'")
    key = (*spec.entity, spec.time)

    def load(batch: DataFrame, _batch_id: int) -> None:
        rows, features = _here(source, batch), _here(target, batch)
        arrived = written(one_per_key(batch, key), "arrived")
        insert_into(rows, arrived, key)
        build_features(rows, features, spec, columns, lookback, domain, slicing)
        if late == "repair":
            repair_late_rows(rows, features, spec, columns, lookback, arrived, domain, slicing)

    return (
        arrivals.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def _here(table: FeedTable, batch: DataFrame) -> FeedTable:
    # a micro-batch runs in the stream's own session
    return replace(table, spark=batch.sparkSession)
