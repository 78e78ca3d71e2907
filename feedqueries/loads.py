"""Merges, incremental feature builds, late rows and streams."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pollpipe.operators import explode_polls, insert_into, insert_only, new_rows, one_per_key, upsert, upsert_into
from pollpipe.plans import build_features, late_keys, repair_late_rows, silver_rows
from pollpipe.presets import perpetuals as preset
from pollpipe.sources import FeedTable, stream_polls
from pollpipe.streaming import stream_bronze, stream_features, stream_silver

from .changes import FEATURE_COLUMNS, FEATURES_SQL, LEVELS, MEASURES_SQL, features_sql, measures
from .polls import GOLD_COLUMNS, GOLD_SQL, PLAN, SILVER_SQL, feed_polls, landed_polls, plain
from .registry import arrived, fresh_dir, query, table

CUT = dt.datetime(1998, 1, 1)
OVERLAP = dt.datetime(1997, 1, 1)


def order_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A target up to a date, and an overlapping later batch with changed values."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    cut, overlap = (F.lit(t).cast("timestamp_ntz") for t in (CUT, OVERLAP))
    target = orders.where(F.col("o_orderdate") < cut)
    batch = orders.where(F.col("o_orderdate") >= overlap).withColumn("o_totalprice", -F.col("o_totalprice"))
    return target, batch


ORDER_KEY = ("o_orderkey", "o_orderdate")


@query("""
    SELECT o_orderkey, o_orderdate,
           CASE WHEN o_orderdate < TIMESTAMP '1998-01-01 00:00:00' THEN o_totalprice ELSE -o_totalprice END
               AS o_totalprice
    FROM orders
""")
def merge_insert_only(spark, sf_dir):
    """Known keys keep their row, unknown keys are added."""
    return insert_only(*order_sides(spark, sf_dir), ORDER_KEY)


@query("""
    SELECT o_orderkey, o_orderdate,
           CASE WHEN o_orderdate < TIMESTAMP '1997-01-01 00:00:00' THEN o_totalprice ELSE -o_totalprice END
               AS o_totalprice
    FROM orders
""")
def merge_upsert(spark, sf_dir):
    """Known keys are replaced, unknown keys are added."""
    return upsert(*order_sides(spark, sf_dir), ORDER_KEY)


@query("SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01 00:00:00'")
def merge_new_rows(spark, sf_dir):
    """Only the rows an insert-only merge would add."""
    target, batch = order_sides(spark, sf_dir)
    return new_rows(batch, target, ORDER_KEY).select("o_orderkey", "o_orderdate")


@query("""
    SELECT l_orderkey, l_linenumber, min(l_extendedprice) AS l_extendedprice FROM lineitem
    GROUP BY l_orderkey, l_linenumber
""")
def one_row_per_key(spark, sf_dir):
    """Copies of a key reduced to the smallest row."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return one_per_key(lines, ["l_orderkey", "l_linenumber"], ["l_extendedprice"])


# ------------------------------------------------------------------ tables on disk

EVENT_KEY = ("user_id", "event_type", "ts")
EVENT_CUT = dt.datetime(2024, 1, 16)
EVENT_CUT_SQL = "TIMESTAMP '2024-01-16 00:00:00'"


def event_tables(spark: SparkSession, *names: str) -> list[FeedTable]:
    return [FeedTable(spark, fresh_dir(spark, name), "ts") for name in names]


def before(df: DataFrame, moment: dt.datetime) -> DataFrame:
    return df.where(F.col("ts") < F.lit(moment).cast("timestamp_ntz"))


def from_(df: DataFrame, moment: dt.datetime) -> DataFrame:
    return df.where(F.col("ts") >= F.lit(moment).cast("timestamp_ntz"))


@query("SELECT event_id, user_id, event_type, ts, value FROM events")
def table_insert_only(spark, sf_dir):
    """A stored table after an overlapping load that was run twice."""
    (target,) = event_tables(spark, "insert")
    events = table(spark, sf_dir, "events").drop("props")
    changed = events.withColumn("value", F.when(F.col("ts") < F.lit(EVENT_CUT).cast("timestamp_ntz"), -1.0).otherwise(
        F.col("value")))
    insert_into(target, before(events, EVENT_CUT), EVENT_KEY)
    for _ in range(2):
        insert_into(target, from_(changed, dt.datetime(2024, 1, 10)), EVENT_KEY)
    return target.read()


@query("""
    SELECT event_id, user_id, event_type, ts,
           CASE WHEN ts >= TIMESTAMP '2024-01-10 12:00:00' THEN -value ELSE value END AS value FROM events
""")
def table_upsert(spark, sf_dir):
    """A stored table after an upsert that rewrites only the touched dates, run twice."""
    (target,) = event_tables(spark, "upsert")
    events = table(spark, sf_dir, "events").drop("props")
    upsert_into(target, before(events, EVENT_CUT), EVENT_KEY)
    batch = from_(events, dt.datetime(2024, 1, 10, 12)).withColumn("value", -F.col("value"))
    for _ in range(2):
        upsert_into(target, batch, EVENT_KEY)
    return target.read()


@query("SELECT event_id, ts FROM events "
       "WHERE ts > TIMESTAMP '2024-01-16 00:00:00' AND ts < TIMESTAMP '2024-01-18 06:00:00'")
def incremental_scan(spark, sf_dir):
    """Rows between two times of a stored table; dates are pruned, the rest is pushed down."""
    (stored,) = event_tables(spark, "scan")
    stored.append(table(spark, sf_dir, "events").select("event_id", "ts"))
    return stored.read(after=EVENT_CUT, before=dt.datetime(2024, 1, 18, 6))


@query("""
    SELECT max(ts) AS watermark, count(DISTINCT date_trunc('day', ts)) AS dates FROM events
""")
def table_watermark(spark, sf_dir):
    """Newest time of a stored table, found in its last date partition, and its dates."""
    (stored,) = event_tables(spark, "watermark")
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    stored.append(events)
    watermark = F.lit(stored.max_time()).cast("timestamp_ntz")
    days = F.lit(len(stored.dates_in(events))).cast("bigint")
    return spark.range(1).select(watermark.alias("watermark"), days.alias("dates"))


@query("""
    SELECT column_name, CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string'
        WHEN 'DOUBLE' THEN 'double' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' END AS data_type FROM (DESCRIBE events)
""")
def table_columns(spark, sf_dir):
    """Columns and types of a stored table."""
    (stored,) = event_tables(spark, "columns")
    stored.append(table(spark, sf_dir, "events"))
    return stored.columns().select("column_name", "data_type")


# ------------------------------------------------------------------ incremental features

SOURCE_COLUMNS = ("event_id", "user_id", "event_type", "ts", "value", "level", "k")
_FEATURES = ", ".join(FEATURE_COLUMNS)


def load_twice(spark: SparkSession, sf_dir: str, lookback: dt.timedelta | None) -> FeedTable:
    """Features built up to a date, then from there on."""
    source, target = event_tables(spark, "source", "features")
    rows = measures(spark, sf_dir).select(*SOURCE_COLUMNS)
    for part in (before(rows, EVENT_CUT), from_(rows, EVENT_CUT)):
        source.append(part)
        build_features(source, target, LEVELS, FEATURE_COLUMNS, lookback)
    return target


@query(f"SELECT {_FEATURES} FROM ({FEATURES_SQL}) f")
def incremental_features(spark, sf_dir):
    """Two incremental loads with enough lookback equal one full computation."""
    return load_twice(spark, sf_dir, dt.timedelta(days=60)).read()


_BOUNDED = f"""
    SELECT * FROM ({MEASURES_SQL}) m
    WHERE ts >= (SELECT min(ts) FROM events WHERE ts >= {EVENT_CUT_SQL}) - INTERVAL 2 DAY
"""


@query(f"""
    SELECT {_FEATURES} FROM ({FEATURES_SQL}) f WHERE ts < {EVENT_CUT_SQL}
    UNION ALL
    SELECT {_FEATURES} FROM ({features_sql('user_id, event_type', _BOUNDED)}) f WHERE ts >= {EVENT_CUT_SQL}
""")
def incremental_features_bounded(spark, sf_dir):
    """With two days of lookback, predecessors further back are unknown."""
    return load_twice(spark, sf_dir, dt.timedelta(days=2)).read()


def with_late_rows(spark: SparkSession, sf_dir: str) -> tuple[FeedTable, FeedTable]:
    """Features built while some of the clicks were missing, which then arrive late."""
    source, target = event_tables(spark, "source", "features")
    rows = measures(spark, sf_dir).select(*SOURCE_COLUMNS)
    late = (F.col("event_type") == "click") & (F.col("k") < 20)
    source.append(rows.where(~late))
    build_features(source, target, LEVELS, FEATURE_COLUMNS, None)
    source.append(rows.where(late))
    return source, target


@query(f"SELECT {_FEATURES} FROM ({FEATURES_SQL}) f")
def late_repair(spark, sf_dir):
    """Late rows are added and the rows after them recomputed: equal to a full computation."""
    source, target = with_late_rows(spark, sf_dir)
    repair_late_rows(source, target, LEVELS, FEATURE_COLUMNS, None)
    # rows newer than the watermark at that time are no late rows but new ones
    build_features(source, target, LEVELS, FEATURE_COLUMNS, dt.timedelta(days=60))
    return target.read()


@query("""
    SELECT count(*) AS late_rows FROM events
    WHERE event_type = 'click' AND CAST(json_extract_string(props, '$.k') AS INT) < 20
      AND ts <= (SELECT max(ts) FROM events
                 WHERE NOT (event_type = 'click' AND CAST(json_extract_string(props, '$.k') AS INT) < 20))
""")
def late_row_count(spark, sf_dir):
    """How many rows a load that drops late rows leaves out for good."""
    source, target = with_late_rows(spark, sf_dir)
    return late_keys(source, target, EVENT_KEY).agg(F.count(F.lit(1)).alias("late_rows"))


# ------------------------------------------------------------------ streams


@query(f"SELECT exchange, symbol, fetched_at, rate_per_8h, quality_issues FROM ({SILVER_SQL}) s")
def stream_silver_rows(spark, sf_dir):
    """Landed files through the bronze and silver streams."""
    polls, root = arrived(feed_polls(spark, sf_dir), "feed", "json"), fresh_dir(spark, "layers")
    bronze, silver, unkeyed = (FeedTable(spark, f"{root}/{name}", "fetched_at") for name in ("bronze", "silver", "unkeyed"))
    stream_bronze(stream_polls(spark, polls), preset.FEED, bronze, f"{root}/bronze_progress").awaitTermination()
    stream_silver(bronze, silver, PLAN, f"{root}/silver_progress", unkeyed).awaitTermination()
    return plain(silver.read().select(
        "exchange", "symbol", "fetched_at", "rate_per_8h",
        F.concat_ws(",", "silver_quality_issues").alias("quality_issues"),
    ))


@query(f"SELECT {', '.join(GOLD_COLUMNS)} FROM ({GOLD_SQL}) g")
def stream_gold_rows(spark, sf_dir):
    """Silver rows that arrive file by file and out of order, late ones repaired."""
    root = fresh_dir(spark, "gold")
    typed = silver_rows(explode_polls(landed_polls(spark, sf_dir), preset.FEED.vendor_fields), PLAN)
    arrivals = f"{root}/arrivals"
    # the middle of the month lands last
    middle = F.col("fetched_at").between(dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 12))
    typed.where(~middle).write.parquet(f"{arrivals}/part=1")
    typed.where(middle).write.parquet(f"{arrivals}/part=2")
    silver, gold = (FeedTable(spark, f"{root}/{name}", "fetched_at") for name in ("silver", "gold"))
    schema = spark.read.parquet(f"{arrivals}/part=1").schema
    for part in ("part=1", "part=2"):
        stream = spark.readStream.schema(schema).parquet(f"{arrivals}/{part}")
        stream_features(
            stream, silver, gold, preset.FEATURES, GOLD_COLUMNS, dt.timedelta(days=60), f"{root}/{part}_progress",
            late="repair",
        ).awaitTermination()
    return plain(gold.read())
