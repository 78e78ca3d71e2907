"""Loads and gates over feeds with late, damaged, copied and replayed polls; skewed series."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pollpipe.operators import Case, change_features, scorecard, write_report
from pollpipe.operators.features import ChangeSpec
from pollpipe.plans import build_features, gates, load_bronze, load_gold, load_silver
from pollpipe.presets import perpetuals as preset
from pollpipe.sources import read_polls
from pollpipe.streaming import stream_silver

from .audits import status_totals
from .changes import FEATURE_COLUMNS, MEASURES_SQL, features_sql, measures
from .polls import GOLD_COLUMNS, GOLD_SQL, PLAN, SILVER_SQL, feed_polls, landed_polls, layer_tables, plain
from .registry import arrived, fresh_dir, query

KEY = preset.FEED.key
LOOKBACK = dt.timedelta(days=60)


def unreadable(polls: DataFrame) -> DataFrame:
    """Some records without a symbol, some polls without a readable time, some rejected polls."""
    number = F.get_json_object("payload", "$.data[0].age_seconds").cast("int") + 3
    nameless = F.regexp_replace("payload", '"symbol":"[^"]*"', '"symbol":null')
    return polls.withColumns({
        "payload": F.when(number == 33, nameless).otherwise(F.col("payload")),
        "fetched_at": F.when(number == 44, "no time").otherwise(F.col("fetched_at")),
        "status_code": F.when(number == 55, 429).otherwise(F.col("status_code")),
    })


def damaged_polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_polls(spark, arrived(unreadable(feed_polls(spark, sf_dir)), "damaged", "json"))


DAMAGED = "(age_seconds + 3 IN (33, 44))"
REJECTED = "(age_seconds + 3 = 55)"


@query(f"SELECT exchange, symbol, fetched_at, rate_per_8h FROM ({SILVER_SQL}) s")
def silver_late_rows(spark, sf_dir):
    """Polls of the last days that land after newer ones: the next load takes them all."""
    bronze, silver, _, unkeyed = layer_tables(spark)
    polls = landed_polls(spark, sf_dir)
    late = (F.col("fetched_at") >= "2024-01-25") & (F.crc32(F.col("payload").cast("binary")) % 5 == 0)
    for part in (polls.where(~late), polls.where(late)):
        load_bronze(part, preset.FEED, bronze)
        load_silver(bronze, silver, PLAN, unkeyed, reread=dt.timedelta(days=7))
    return plain(silver.read().select("exchange", "symbol", "fetched_at", "rate_per_8h"))


@query(f"""
    SELECT exchange, count(*) AS rows, count(*) FILTER (WHERE age_seconds + 3 = 33) AS nameless
    FROM ({SILVER_SQL}) s WHERE {DAMAGED} GROUP BY exchange
""")
def silver_unkeyed_rows(spark, sf_dir):
    """Rows without a symbol or a readable time: kept apart, once, however often they are loaded."""
    bronze, silver, _, unkeyed = layer_tables(spark)
    load_bronze(damaged_polls(spark, sf_dir), preset.FEED, bronze)
    for _ in range(2):
        load_silver(bronze, silver, PLAN, unkeyed)
    nameless = F.sum(F.when(F.col("symbol").isNull(), F.col("copies")).otherwise(0))
    return unkeyed.read().groupBy("exchange").agg(F.sum("copies").alias("rows"), nameless.alias("nameless"))


@query(f"""
    SELECT count(*) + count(*) FILTER (WHERE age_seconds < 20) AS rows, count(*) AS unique_keys,
           count(*) FILTER (WHERE age_seconds < 20) AS copies,
           'duplicate keys: ' || (count(*) + count(*) FILTER (WHERE age_seconds < 20)) || ' rows, ' || count(*)
               || ' unique keys' AS breach
    FROM ({SILVER_SQL}) s
""")
def silver_copies(spark, sf_dir):
    """Two records for one key in a load: both are kept and counted, and the key gate sees them."""
    bronze, silver, gold, unkeyed = layer_tables(spark)
    polls = landed_polls(spark, sf_dir)
    few = F.get_json_object("payload", "$.data[0].age_seconds").cast("int") < 20
    changed = polls.where(few).withColumn("payload", F.replace("payload", F.lit('"asset_class":"crypto"'), F.lit('"asset_class":"other"')))
    load_bronze(polls.unionByName(changed), preset.FEED, bronze)
    added = load_silver(bronze, silver, PLAN, unkeyed)
    gate = gates.gold_gate(silver.read(), with_flags(silver.read()), KEY, "fetched_at", 30)
    facts = gate.metrics.select("rows", "unique_keys")
    return facts.select(
        "*", F.lit(added.copies).cast("bigint").alias("copies"), F.lit(", ".join(gate.breaches)).alias("breach")
    )


def with_flags(df: DataFrame) -> DataFrame:
    return df.withColumns({"is_large_move": F.lit(False), "is_frozen": F.lit(False)})


@query(f"""
    SELECT count(*) FILTER (WHERE NOT {DAMAGED}) AS rows, count(*) FILTER (WHERE {DAMAGED}) AS unkeyed
    FROM ({SILVER_SQL}) s WHERE NOT {REJECTED}
""")
def silver_replay(spark, sf_dir):
    """A silver stream that lost its progress takes every poll again and changes nothing."""
    bronze, silver, _, unkeyed = layer_tables(spark)
    load_bronze(damaged_polls(spark, sf_dir), preset.FEED, bronze)
    for _ in range(2):
        stream_silver(bronze, silver, PLAN, fresh_dir(spark, "progress"), unkeyed).awaitTermination()
    apart = unkeyed.read().agg(F.sum("copies").alias("n")).scalar()
    return silver.read().agg(F.count(F.lit(1)).alias("rows")).withColumn("unkeyed", apart)


@query(f"SELECT {', '.join(GOLD_COLUMNS)} FROM ({GOLD_SQL}) g")
def gold_of_copies(spark, sf_dir):
    """Features of a silver table in which keys occur twice, in two loads: one row per key."""
    bronze, silver, gold, unkeyed = layer_tables(spark)
    polls = landed_polls(spark, sf_dir)
    few = F.get_json_object("payload", "$.data[0].age_seconds").cast("int") < 20
    doubled = polls.unionByName(polls.where(few))
    for part in (doubled.where(F.col("fetched_at") < "2024-01-16"), doubled.where(F.col("fetched_at") >= "2024-01-16")):
        load_bronze(part, preset.FEED, bronze)
        load_silver(bronze, silver, PLAN, unkeyed)
        load_gold(silver, gold, preset.FEATURES, GOLD_COLUMNS, LOOKBACK)
    return plain(gold.read())


_AT = "TIMESTAMP '2024-02-02 00:00:00'"


@query(f"""
    WITH b AS (SELECT * FROM ({SILVER_SQL}) s WHERE NOT {REJECTED}),
    k AS (SELECT * FROM b WHERE NOT {DAMAGED}),
    t AS (SELECT * FROM b WHERE age_seconds + 3 <> 44),
    n AS (SELECT max(fetched_at) AS newest, count(*) FILTER (WHERE fetched_at = (SELECT max(fetched_at) FROM t)) AS polled,
                 round((epoch_us({_AT}) - epoch_us(max(fetched_at))) / 6e7, 1) AS age FROM t)
    SELECT 'bronze' AS gate, (SELECT count(*) FROM k) AS rows, 'stale: newest poll is ' || age || ' min old (limit 5); newest poll has '
        || polled || ' rows (expected at least 35)' AS breaches FROM n
    UNION ALL SELECT 'silver', count(*), '' FROM k
    UNION ALL SELECT 'gold', count(*), '' FROM k
    UNION ALL SELECT 'reconciliation', (SELECT count(*) FROM b), 'row counts differ: bronze ' || (SELECT count(*) FROM b) || ', silver '
        || (SELECT count(*) FROM k) || ', difference ' || ((SELECT count(*) FROM b) - (SELECT count(*) FROM k))
""")
def gate_breaches(spark, sf_dir):
    """All four gates on tables as the loads write them, with rejected polls and an unreadable time."""
    bronze, silver, gold, unkeyed = layer_tables(spark)
    load_bronze(damaged_polls(spark, sf_dir), preset.FEED, bronze)
    load_silver(bronze, silver, PLAN, unkeyed)
    load_gold(silver, gold, preset.FEATURES, GOLD_COLUMNS, LOOKBACK)
    domain, as_of, time = preset.FEED.domain, F.lit(dt.datetime(2024, 2, 2)), "fetched_at"
    eligible = F.col("rate").isNotNull() & F.coalesce(F.col("interval_hours") > 0, F.lit(False))
    layers = gates.gate_rows(bronze.read(), time, domain), silver.read(), gold.read()
    # a poll that misses the day is newer than the last keyed row by less than a day
    results = {
        "bronze": gates.bronze_gate(bronze.read(), KEY, time, 35, 5, as_of, domain=domain),
        "silver": gates.silver_gate(bronze.read(), layers[1], KEY, time, eligible, ["rate_per_8h", "rate_annualized"], 1440, domain=domain),
        "gold": gates.gold_gate(layers[1], layers[2], KEY, time, 30),
        "reconciliation": gates.reconciliation_gate(*layers),
    }
    rows = [(name, r.values.get("rows", r.values.get("bronze_count")), "; ".join(r.breaches)) for name, r in results.items()]
    return spark.createDataFrame(rows, "gate string, rows bigint, breaches string")


@query("SELECT count(*) > 0 AS first, false AS again, count(*) > 0 AS built, false AS rebuilt FROM events")
def empty_batches(spark, sf_dir):
    """A load with nothing new says so and writes nothing."""
    bronze, silver, gold, unkeyed = layer_tables(spark)
    load_bronze(landed_polls(spark, sf_dir), preset.FEED, bronze)
    loads = [bool(load_silver(bronze, silver, PLAN, unkeyed)) for _ in range(2)]
    builds = [build_features(silver, gold, preset.FEATURES, GOLD_COLUMNS, LOOKBACK) for _ in range(2)]
    return spark.createDataFrame([(*loads, *builds)], "first boolean, again boolean, built boolean, rebuilt boolean")


@query("SELECT 1 AS passed, 2 AS total, (SELECT count(DISTINCT o_custkey) FROM orders) AS missing")
def report_summary(spark, sf_dir):
    """The JSON report of two comparisons, one of them with an empty side, read back."""
    totals = status_totals(spark, sf_dir)
    cards = scorecard([
        Case("same", totals, totals, ("o_custkey",), True), Case("empty", totals, totals.where(F.col("n") < 0), ("o_custkey",), True),
    ])
    path = fresh_dir(spark, "report")
    write_report(cards, path)
    missing = spark.read.json(f"{path}/cases").agg(F.sum("missing")).scalar()
    return spark.read.json(f"{path}/summary").withColumn("missing", missing)


# ------------------------------------------------------------------ skewed series

SKEWED = ChangeSpec(
    entity=("series",), time="ts", measure="level", change_as="level_change", threshold=2.0,
    changes=(("value", "value_change"), ("k", "k_change")), lookback=5, tiebreak=("event_id",),
)
_SERIES_SQL = f"""
    SELECT *, CASE WHEN k < 40 THEN 'hot' WHEN k < 60 THEN 'warm' ELSE event_type || user_id END AS series
    FROM ({MEASURES_SQL}) m0
"""


@query(f"SELECT {', '.join(FEATURE_COLUMNS)} FROM ({features_sql('series', _SERIES_SQL)}) f")
def change_features_skewed(spark, sf_dir):
    """Two series with most of the rows, found and cut by themselves; the others stay whole."""
    k = F.col("k")
    named = F.when(k < 40, "hot").when(k < 60, "warm").otherwise(F.concat("event_type", "user_id"))
    rows = measures(spark, sf_dir).withColumn("series", named)
    return change_features(rows, SKEWED, "auto", rows_per_task=150).select(*FEATURE_COLUMNS)
