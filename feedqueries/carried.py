"""Loads by arrival, and features and newest rows from carried state."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pollpipe.plans import SeriesState, load_bronze, load_gold_carried, load_silver_arrived, silver_rows
from pollpipe.plans.analytics import latest_values
from pollpipe.presets import perpetuals as preset
from pollpipe.operators import explode_polls
from pollpipe.session import written
from pollpipe.sources import FeedTable
from pollpipe.streaming import stream_features_stateful

from .changes import FEATURE_COLUMNS, FEATURES_SQL, LEVELS, SERIES, measures
from .loads import event_tables
from .polls import GOLD_COLUMNS, GOLD_SQL, PLAN, SILVER_SQL, landed_polls, layer_tables, plain
from .registry import fresh_dir, query

#: Rows of this poll minute arrive last, up to 30 days after their time.
LATE_MINUTE = 17


def load_by_arrival(spark: SparkSession, sf_dir: str) -> tuple[FeedTable, FeedTable, SeriesState]:
    """The feed in three loads: the first half, the second half, and polls of one minute of every hour
    of the whole month, so the last load holds rows up to 30 days old."""
    bronze, silver, gold, unkeyed = layer_tables(spark)
    state = SeriesState(spark, fresh_dir(spark, "state"), preset.FEED.entity, preset.FEED.time)
    polls = landed_polls(spark, sf_dir)
    late = F.minute(F.col("fetched_at").cast("timestamp")) == LATE_MINUTE
    half = F.col("fetched_at") < "2024-01-16"
    log = fresh_dir(spark, "taken")
    for part in (polls.where(~late & half), polls.where(~late & ~half), polls.where(late)):
        load_bronze(part, preset.FEED, bronze)
        load_silver_arrived(bronze, silver, PLAN, unkeyed, log)
        load_gold_carried(silver, gold, preset.FEATURES, GOLD_COLUMNS, state)
    return silver, gold, state


@query(f"SELECT exchange, symbol, fetched_at, rate, rate_per_8h, quality_issues FROM ({SILVER_SQL}) s")
def silver_any_age(spark, sf_dir):
    """Silver by arrival: rows up to 30 days late are in, and each load reads new files only."""
    bronze, silver, _, unkeyed = layer_tables(spark)
    polls, log = landed_polls(spark, sf_dir), fresh_dir(spark, "taken")
    late = F.minute(F.col("fetched_at").cast("timestamp")) == LATE_MINUTE
    for part in (polls.where(~late), polls.where(late)):
        load_bronze(part, preset.FEED, bronze)
        load_silver_arrived(bronze, silver, PLAN, unkeyed, log)
    issues = F.concat_ws(",", "silver_quality_issues").alias("quality_issues")
    return plain(silver.read().select("exchange", "symbol", "fetched_at", "rate", "rate_per_8h", issues))


@query(f"SELECT {', '.join(GOLD_COLUMNS)} FROM ({GOLD_SQL}) g")
def gold_any_age(spark, sf_dir):
    """All layers by arrival, with features from carried state and no lookback, late rows of any age included."""
    return plain(load_by_arrival(spark, sf_dir)[1].read())


def carried_events(spark: SparkSession, sf_dir: str) -> tuple[FeedTable, FeedTable, SeriesState]:
    """Features of events in three loads; series of some users are silent in the second one."""
    source, target = event_tables(spark, "source", "features")
    state = SeriesState(spark, fresh_dir(spark, "state"), SERIES, "ts")
    rows = measures(spark, sf_dir).select("event_id", "user_id", "event_type", "ts", "value", "level", "k")
    first, second = (F.lit(t).cast("timestamp_ntz") for t in (dt.datetime(2024, 1, 8), dt.datetime(2024, 1, 22)))
    for part in (F.col("ts") < first, (F.col("ts") >= first) & (F.col("ts") < second), F.col("ts") >= second):
        source.append(rows.where(part))
        load_gold_carried(source, target, LEVELS, STATE_COLUMNS, state)
    return source, target, state


STATE_COLUMNS = (*FEATURE_COLUMNS, "value", "k")


@query(f"SELECT {', '.join(FEATURE_COLUMNS)} FROM ({FEATURES_SQL}) f")
def carried_features(spark, sf_dir):
    """Three loads that read only new files and the state equal one full computation."""
    return carried_events(spark, sf_dir)[1].read().select(*FEATURE_COLUMNS)


@query(f"""
    SELECT user_id, event_type, value, level_change, is_frozen, ts FROM ({FEATURES_SQL}) f
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1
""")
def latest_from_state(spark, sf_dir):
    """Newest row per series, read from the carried state instead of all history."""
    source, _, state = carried_events(spark, sf_dir)
    return latest_values(state.rows(source), SERIES, "ts", ["value", "level_change", "is_frozen"], ("event_id",))


@query(f"""
    SELECT exchange, symbol, rate_per_8h, funding_change, is_large_move, is_frozen, fetched_at FROM ({GOLD_SQL}) g
    QUALIFY row_number() OVER (PARTITION BY exchange, symbol ORDER BY fetched_at DESC) = 1
""")
def latest_rate_any_age(spark, sf_dir):
    """Newest rate and flags per series from the state, after late rows of any age."""
    silver, _, state = load_by_arrival(spark, sf_dir)
    measures = ["rate_per_8h", "funding_change", "is_large_move", "is_frozen"]
    return plain(latest_values(state.rows(silver), preset.FEED.entity, "fetched_at", measures))


def stateful_stream(spark: SparkSession, sf_dir: str, late_minute: int | None) -> tuple[FeedTable, FeedTable]:
    """Gold from the keyed state of a stream that is stopped and started again between three parts of
    the month. With ``late_minute`` the rows of that minute of every hour land with the part after theirs."""
    root = fresh_dir(spark, "stateful")
    gold, late = (FeedTable(spark, f"{root}/{name}", "fetched_at") for name in ("gold", "late"))
    typed = written(silver_rows(explode_polls(landed_polls(spark, sf_dir), preset.FEED.vendor_fields), PLAN), "typed")
    part = F.floor((F.dayofmonth("fetched_at") - 1) / 11)
    if late_minute is not None:
        part = F.when(F.minute("fetched_at") == late_minute, part + 1).otherwise(part)
    for number in range(3 if late_minute is None else 4):
        typed.where(part == number).write.mode("append").parquet(f"{root}/silver")
        arrivals = spark.readStream.schema(typed.schema).parquet(f"{root}/silver")
        stream_features_stateful(arrivals, gold, late, preset.FEATURES, GOLD_COLUMNS, f"{root}/progress").awaitTermination()
    return gold, late


@query(f"SELECT {', '.join(GOLD_COLUMNS)} FROM ({GOLD_SQL}) g")
def stream_gold_state(spark, sf_dir):
    """Features from keyed streaming state over three batches and two restarts."""
    return plain(stateful_stream(spark, sf_dir, None)[0].read())


@query(f"""
    WITH rows AS (
        SELECT exchange, symbol, fetched_at, rate_per_8h, (day(fetched_at) - 1) // 11
            + CASE WHEN minute(fetched_at) = {LATE_MINUTE} THEN 1 ELSE 0 END AS part FROM ({SILVER_SQL}) s
    )
    SELECT exchange, symbol, fetched_at, rate_per_8h FROM rows r
    WHERE EXISTS (SELECT 1 FROM rows b WHERE b.exchange = r.exchange AND b.symbol = r.symbol AND b.part < r.part
                  AND b.fetched_at >= r.fetched_at)
""")
def stream_late_rows(spark, sf_dir):
    """What the stateful stream sets aside: rows older than what their series has seen in an earlier batch."""
    late = stateful_stream(spark, sf_dir, LATE_MINUTE)[1]
    return plain(late.read().select("exchange", "symbol", "fetched_at", "rate_per_8h"))
