"""Landed polls: explode, drift, quarantine, and the bronze, silver and gold layers.

``events`` is turned into a feed of the perpetuals preset, one poll per event. Every
property of interest occurs: drift in both directions, cast failures, broken quality
rules, invalid intervals, missing values and a second domain.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pollpipe.operators import accepted, drift_counts, explode_polls, issue_rows
from pollpipe.plans import SilverPlan, gates, load_bronze, load_gold, load_silver, silver_rows
from pollpipe.presets import perpetuals as preset
from pollpipe.sources import FeedTable, classify_polls, read_polls

from .registry import arrived, fresh_dir, landed, query, table

PLAN = SilverPlan(preset.FEED, preset.derived_columns, preset.quality_rules)
GOLD_COLUMNS = preset.GOLD_CONTRACT.names


def iso(time: Column) -> Column:
    return F.concat(F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))


def listed(tags) -> Column:
    return F.concat_ws(",", tags)


# ------------------------------------------------------------------ small payloads


def props_polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One poll per event around its ``props``, which gains a field for some events."""
    events = table(spark, sf_dir, "events")
    drifted = F.when(F.col("event_id") % 3 == 0, F.replace("props", F.lit("}"), F.lit(', "x": 1}'))).otherwise(
        F.col("props")
    )
    polls = events.select(
        "event_id",
        iso(F.col("ts")).alias("fetched_at"),
        F.lit(200).alias("status_code"),
        F.concat(F.lit('{"data": ['), drifted, F.lit("]}")).alias("payload"),
    )
    return spark.read.parquet(arrived(polls, "props"))


PROPS_SQL = """
    SELECT event_id, CASE WHEN event_id % 3 = 0 THEN replace(props, '}', ', "x": 1}') ELSE props END AS record
    FROM events
"""


@query(f"""
    SELECT event_id,
           array_to_string(list_sort(list_filter(json_keys(record), lambda f: NOT list_contains(['k', 'z'], f))), ',')
               AS extra,
           array_to_string(list_sort(list_filter(['k', 'z'], lambda f: NOT list_contains(json_keys(record), f))), ',')
               AS missing
    FROM ({PROPS_SQL}) p
""")
def schema_drift(spark, sf_dir):
    """Unexpected and absent fields of every record."""
    rows = accepted(explode_polls(props_polls(spark, sf_dir), ["k", "z"]))
    return rows.select(
        "event_id", listed("schema_extra_fields").alias("extra"), listed("schema_missing_fields").alias("missing")
    )


@query(f"""
    SELECT count(*) FILTER (WHERE list_contains(json_keys(record), 'x')) AS extra_field_rows,
           count(*) FILTER (WHERE NOT list_contains(json_keys(record), 'z')) AS missing_field_rows
    FROM ({PROPS_SQL}) p
""")
def drift_counters(spark, sf_dir):
    """How many records drifted."""
    return drift_counts(accepted(explode_polls(props_polls(spark, sf_dir), ["k", "z"])))


@query("""
    SELECT event_id, event_type AS kind, value, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events
    UNION ALL
    SELECT event_id, 'echo', -value, NULL FROM events
""")
def poll_explode(spark, sf_dir):
    """Polls of two records each become one row per record, with their poll's columns."""
    events = table(spark, sf_dir, "events")
    first = F.to_json(F.struct("event_id", F.col("event_type").alias("kind"), "value", F.get_json_object(
        "props", "$.k").cast("bigint").alias("k")))
    second = F.to_json(
        F.struct("event_id", F.lit("echo").alias("kind"), (-F.col("value")).alias("value"),
                 F.lit(None).cast("bigint").alias("k")),
        {"ignoreNullFields": "false"},
    )
    polls = events.select(
        iso(F.col("ts")).alias("fetched_at"), F.lit(200).alias("status_code"),
        F.concat(F.lit('{"data":['), first, F.lit(","), second, F.lit("]}")).alias("payload"),
    )
    rows = accepted(explode_polls(spark.read.parquet(arrived(polls, "pairs")), ["event_id", "kind", "value", "k"]))
    return rows.select(
        F.get_json_object("raw_record_json", "$.event_id").cast("bigint").alias("event_id"),
        "kind", F.col("value").cast("double").alias("value"), F.col("k").cast("bigint").alias("k"),
    )


def broken_polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One poll per event; the events' kinds decide what is wrong with it."""
    events = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    whole = F.concat(F.lit('{"data": ['), "props", F.lit("]}"))
    polls = events.select(
        "event_id",
        iso(F.col("ts")).alias("fetched_at"),
        F.when(k < 5, 429).when(k < 10, 500).when(k >= 15, 200).alias("status_code"),
        F.when((k >= 10) & (k < 15), "timed out").alias("error"),
        F.when(k < 20, whole)
        .when(k < 25, "not valid json {{{")
        .when(k < 30, '{"unexpected": []}')
        .when(k < 35, '{"data": {"k": 1}}')
        .when(k < 40, '{"data": [7]}')
        .when(k < 45, '{"data": []}')
        .when(k < 50, F.concat(whole, F.lit(" rest")))
        .otherwise(whole).alias("payload"),
    )
    return spark.read.parquet(arrived(polls, "broken"))


BROKEN_SQL = """
    SELECT event_id, k,
           CASE WHEN k < 5 THEN 429 WHEN k < 10 THEN 500 WHEN k < 15 THEN NULL ELSE 200 END AS status_code,
           CASE WHEN k >= 10 AND k < 15 THEN 'timed out' END AS error,
           CASE WHEN k < 20 THEN whole WHEN k < 25 THEN 'not valid json {{{' WHEN k < 30 THEN '{"unexpected": []}'
                WHEN k < 35 THEN '{"data": {"k": 1}}' WHEN k < 40 THEN '{"data": [7]}' WHEN k < 45 THEN '{"data": []}'
                WHEN k < 50 THEN whole || ' rest' ELSE whole END AS payload
    FROM (SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k,
                 '{"data": [' || props || ']}' AS whole FROM events) e
"""


@query(f"""
    SELECT event_id, status_code, payload AS raw_json, reject_reason FROM (
        SELECT event_id, status_code, payload,
               CASE WHEN status_code IS NULL THEN 'network_error: ' || error
                    WHEN status_code = 429 THEN 'rate_limit_or_quota_exceeded'
                    WHEN status_code <> 200 THEN 'unexpected_status_' || status_code
                    WHEN NOT json_valid(payload) THEN 'invalid_json'
                    WHEN json_type(CASE WHEN json_valid(payload) THEN payload END, '$.data') IS DISTINCT FROM 'ARRAY'
                        THEN 'no_data_array' END AS reject_reason
        FROM ({BROKEN_SQL}) b
    ) judged WHERE reject_reason IS NOT NULL
    UNION ALL
    SELECT event_id, status_code, '7', 'record_not_object' FROM ({BROKEN_SQL}) b
    WHERE status_code = 200 AND payload = '{{"data": [7]}}'
""")
def payload_quarantine(spark, sf_dir):
    """Everything that is not a record, with the reason."""
    exploded = explode_polls(broken_polls(spark, sf_dir), ["k"])
    return exploded.where(F.col("reject_reason").isNotNull()).select(
        "event_id", "status_code", F.col("raw_record_json").alias("raw_json"), "reject_reason"
    )


@query(f"SELECT count(*) AS records, sum(k) AS total FROM ({BROKEN_SQL}) b WHERE (k >= 15 AND k < 20) OR k >= 50")
def accepted_records(spark, sf_dir):
    """What is left after the quarantine."""
    rows = accepted(explode_polls(broken_polls(spark, sf_dir), ["k"]))
    return rows.agg(F.count(F.lit(1)).alias("records"), F.sum(F.col("k").cast("bigint")).alias("total"))


@query(f"""
    SELECT status_code = 200 AND status_code IS NOT NULL AS success,
           CASE WHEN status_code IS NULL THEN 'network_error: ' || error
                WHEN status_code = 429 THEN 'rate_limit_or_quota_exceeded'
                WHEN status_code <> 200 THEN 'unexpected_status_' || status_code END AS reason,
           count(*) AS polls
    FROM ({BROKEN_SQL}) b GROUP BY ALL
""")
def poll_outcomes(spark, sf_dir):
    """Polls per outcome."""
    polls = classify_polls(broken_polls(spark, sf_dir))
    return polls.groupBy("success", "reason").agg(F.count(F.lit(1)).alias("polls"))


# ------------------------------------------------------------------ the perpetuals feed


def feed_polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Poll envelopes of the preset's feed, one per event."""
    events = table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))
    k, ts = F.col("k"), F.col("ts").cast("timestamp")
    seconds = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (10 - k).cast("decimal(18,6)"))
    minutes = F.make_dt_interval(F.lit(0), F.lit(0), (k - 20).cast("int"))
    updated, following = iso(ts + seconds), iso(ts + minutes)
    record = F.to_json(
        F.struct(
            F.col("event_type").alias("exchange"),
            F.concat(F.lit("U"), F.col("user_id")).alias("symbol"),
            F.when(F.col("event_type") == "error", "ETH").otherwise("BTC").alias("base_coin"),
            (F.floor(F.col("value") / 20) / 1000).alias("rate"),
            F.lit(None).cast("double").alias("predicted_rate"),
            (k % 9).alias("interval_hours"),
            following.alias("next_funding_time"),
            F.when(k == 7, "not-a-timestamp").otherwise(updated).alias("updated_at"),
            F.when(k >= 50, "linear").otherwise("inverse").alias("margin_type"),
            F.lit("crypto").alias("asset_class"),
            (F.col("value") - 5).alias("mark_price"),
            updated.alias("mark_price_updated_at"),
            F.when(k >= 5, k * 10.0 - 100).alias("open_interest"),
            F.lit(1).alias("market_cap_rank"),
            (k - 3).alias("age_seconds"),
            F.lit(600).alias("freshness_sla_seconds"),
        ),
        {"ignoreNullFields": "false"},
    )
    tail = F.concat(
        F.when(k == 95, F.lit(', "is_stale": "true"')).when(k > 90, F.lit(', "is_stale": true')).otherwise(
            ', "is_stale": false'
        ),
        F.when(k == 13, "").otherwise(', "data_source": "landed"'),
        F.when(k > 80, ', "settlement_currency": "USDT"').otherwise(""),
    )
    whole = F.concat(F.lit('{"data": ['), F.substring(record, F.lit(1), F.length(record) - 1), tail, F.lit("}]}"))
    return events.select(
        iso(ts).alias("fetched_at"),
        F.lit(200).alias("status_code"),
        F.create_map(F.lit("X-RateLimit-Remaining"), F.lit("29")).alias("headers"),
        F.lit("https://feed.example/rates").alias("url"),
        whole.alias("payload"),
    )


def landed_polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed after a round trip through landed JSON files."""
    return read_polls(spark, arrived(feed_polls(spark, sf_dir), "feed", "json"))


FEED_SQL = """
    SELECT event_type AS exchange, 'U' || user_id AS symbol,
           CASE WHEN event_type = 'error' THEN 'ETH' ELSE 'BTC' END AS base_coin,
           floor(value / 20) / 1000 AS rate, CAST(k % 9 AS BIGINT) AS interval_hours,
           ts + (k - 20) * INTERVAL 1 MINUTE AS next_funding_time,
           CASE WHEN k <> 7 THEN ts + (10 - k) * INTERVAL 1 SECOND END AS updated_at,
           ts AS fetched_at, CASE WHEN k >= 50 THEN 'linear' ELSE 'inverse' END AS margin_type,
           value - 5 AS mark_price, CASE WHEN k >= 5 THEN k * 10.0::DOUBLE - 100 END AS open_interest,
           k - 3 AS age_seconds, CASE WHEN k <> 13 THEN 'landed' END AS data_source,
           CASE WHEN k <> 95 THEN k > 90 END AS is_stale,
           CASE WHEN k > 80 THEN 'settlement_currency' ELSE '' END AS extra,
           CASE WHEN k = 13 THEN 'data_source' ELSE '' END AS missing,
           concat_ws(',', CASE WHEN k = 7 THEN 'updated_at' END, CASE WHEN k = 95 THEN 'is_stale' END) AS cast_issues
    FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) e
"""

SILVER_SQL = f"""
    SELECT *,
           CASE WHEN interval_hours > 0 THEN rate * 8.0::DOUBLE / interval_hours END AS rate_per_8h,
           CASE WHEN interval_hours > 0 THEN rate * (8760.0::DOUBLE / interval_hours) END AS rate_annualized,
           (epoch_us(fetched_at) - epoch_us(updated_at)) / 1e6 AS poll_lag_seconds,
           concat_ws(',',
               CASE WHEN interval_hours <= 0 THEN 'invalid_interval_hours' END,
               CASE WHEN age_seconds <= 0 THEN 'invalid_age_seconds' END,
               CASE WHEN updated_at > fetched_at THEN 'updated_at_after_fetched_at' END,
               CASE WHEN next_funding_time < fetched_at THEN 'stale_next_funding_time' END,
               CASE WHEN next_funding_time <= updated_at THEN 'next_funding_time_not_after_updated_at' END,
               CASE WHEN mark_price <= 0 THEN 'invalid_mark_price' END,
               CASE WHEN open_interest < 0 THEN 'negative_open_interest' END,
               CASE WHEN abs(rate) > 0.05 THEN 'implausible_rate_magnitude' END) AS quality_issues
    FROM ({FEED_SQL}) f WHERE base_coin = 'BTC'
"""

GOLD_SQL = f"""
    SELECT exchange, symbol, margin_type, fetched_at, rate_per_8h, rate_per_8h - r1 AS funding_change,
           abs(rate_per_8h - r1) >= 0.00008 AS is_large_move,
           CASE WHEN rate_per_8h IS NULL OR r1 IS NULL OR r2 IS NULL OR r3 IS NULL OR r4 IS NULL OR r5 IS NULL
                THEN NULL
                ELSE rate_per_8h = r1 AND rate_per_8h = r2 AND rate_per_8h = r3 AND rate_per_8h = r4
                     AND rate_per_8h = r5 END AS is_frozen,
           open_interest, open_interest - o1 AS oi_change, mark_price, mark_price - p1 AS price_change
    FROM (
        SELECT *, lag(rate_per_8h, 1) OVER w AS r1, lag(rate_per_8h, 2) OVER w AS r2,
               lag(rate_per_8h, 3) OVER w AS r3, lag(rate_per_8h, 4) OVER w AS r4, lag(rate_per_8h, 5) OVER w AS r5,
               lag(open_interest, 1) OVER w AS o1, lag(mark_price, 1) OVER w AS p1
        FROM ({SILVER_SQL}) s
        WINDOW w AS (PARTITION BY exchange, symbol ORDER BY fetched_at)
    ) lagged
"""

_SILVER_COLUMNS = (
    "exchange", "symbol", "base_coin", "rate", "interval_hours", "next_funding_time", "updated_at", "fetched_at",
    "margin_type", "mark_price", "open_interest", "age_seconds", "data_source", "is_stale", "rate_per_8h",
    "rate_annualized", "poll_lag_seconds",
)


def plain(df: DataFrame) -> DataFrame:
    """Instants as UTC times without a zone, for comparison."""
    return df.select(*[
        F.col(name).cast("timestamp_ntz").alias(name) if kind == "timestamp" else F.col(name)
        for name, kind in df.dtypes
    ])


@query(f"""
    SELECT fetched_at, exchange, symbol, rate, interval_hours, extra, missing FROM ({FEED_SQL}) f
""")
def bronze_rows(spark, sf_dir):
    """Bronze of all domains, from landed files."""
    rows = accepted(explode_polls(landed_polls(spark, sf_dir), preset.FEED.vendor_fields))
    return plain(rows.select(
        F.col("fetched_at").cast("timestamp").alias("fetched_at"), "exchange", "symbol",
        F.col("rate").cast("double").alias("rate"), F.col("interval_hours").cast("bigint").alias("interval_hours"),
        listed("schema_extra_fields").alias("extra"), listed("schema_missing_fields").alias("missing"),
    ))


@query(f"SELECT {', '.join(_SILVER_COLUMNS)}, extra, missing, cast_issues, quality_issues FROM ({SILVER_SQL}) s")
def silver_rows_of_feed(spark, sf_dir):
    """Typed rows with derived columns, cast issues and quality tags."""
    bronze = explode_polls(landed_polls(spark, sf_dir), preset.FEED.vendor_fields)
    rows = silver_rows(bronze, PLAN)
    return plain(rows.select(
        *_SILVER_COLUMNS,
        listed("bronze_schema_extra_fields").alias("extra"),
        listed("bronze_schema_missing_fields").alias("missing"),
        listed("silver_cast_issues").alias("cast_issues"),
        listed("silver_quality_issues").alias("quality_issues"),
    ))


@query(f"""
    SELECT exchange, symbol, fetched_at, 'cast' AS kind, unnest(string_split(cast_issues, ',')) AS tag
    FROM ({SILVER_SQL}) s WHERE cast_issues <> ''
    UNION ALL
    SELECT exchange, symbol, fetched_at, 'quality', unnest(string_split(quality_issues, ','))
    FROM ({SILVER_SQL}) s WHERE quality_issues <> ''
""")
def issue_table(spark, sf_dir):
    """Side table: one row per issue of a silver row."""
    silver = silver_rows(explode_polls(landed_polls(spark, sf_dir), preset.FEED.vendor_fields), PLAN)
    issues = {"cast": "silver_cast_issues", "quality": "silver_quality_issues"}
    return plain(issue_rows(silver, preset.FEED.key, issues))


def layer_tables(spark: SparkSession) -> list[FeedTable]:
    """New bronze, silver and gold tables, and one for silver rows without a key."""
    return [FeedTable(spark, fresh_dir(spark, name), "fetched_at") for name in ("bronze", "silver", "gold", "unkeyed")]


def load_layers(spark: SparkSession, sf_dir: str) -> tuple[FeedTable, FeedTable, FeedTable]:
    """All three layer tables, loaded from landed files in two incremental rounds."""
    bronze, silver, gold, unkeyed = layer_tables(spark)
    polls = landed_polls(spark, sf_dir)
    cut = "2024-01-16"
    for part in (polls.where(F.col("fetched_at") < cut), polls.where(F.col("fetched_at") >= cut)):
        load_bronze(part, preset.FEED, bronze)
        load_silver(bronze, silver, PLAN, unkeyed)
        # a lookback as long as the data: same result as one full computation
        load_gold(silver, gold, preset.FEATURES, GOLD_COLUMNS, dt.timedelta(days=60))
    return bronze, silver, gold


@query(f"SELECT {', '.join(GOLD_COLUMNS)} FROM ({GOLD_SQL}) g")
def gold_from_polls(spark, sf_dir):
    """Landed files to gold in two incremental rounds of all three loads."""
    return plain(load_layers(spark, sf_dir)[2].read())


_AS_OF = dt.datetime(2024, 1, 31)


@query(f"""
    SELECT count(*) AS rows, count(DISTINCT (exchange, symbol, fetched_at)) AS unique_keys, 0 AS unkeyed_rows,
           count(*) FILTER (WHERE extra <> '') AS extra_field_rows,
           count(*) FILTER (WHERE missing <> '') AS missing_field_rows,
           max(fetched_at) AS latest_fetched_at,
           count(*) FILTER (WHERE fetched_at = (SELECT max(fetched_at) FROM ({FEED_SQL}) m WHERE base_coin = 'BTC'))
               AS latest_poll_contract_count,
           round((epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(max(fetched_at))) / 6e7, 1) AS age_minutes
    FROM ({FEED_SQL}) f WHERE base_coin = 'BTC'
""")
def bronze_gate_metrics(spark, sf_dir):
    """Bronze gate: keys, drift, newest poll and its age."""
    bronze = landed(explode_polls(landed_polls(spark, sf_dir), preset.FEED.vendor_fields), "bronze")
    return plain(gates.bronze_metrics(bronze, preset.FEED.key, "fetched_at", F.lit(_AS_OF), preset.FEED.domain))


@query(f"""
    SELECT count(*) AS rows, count(DISTINCT (exchange, symbol, fetched_at)) AS unique_keys,
           count(*) FILTER (WHERE cast_issues <> '') AS cast_issue_rows,
           count(*) FILTER (WHERE quality_issues <> '') AS quality_issue_rows,
           count(*) FILTER (WHERE rate IS NOT NULL AND interval_hours > 0) AS eligible_rows,
           count(*) FILTER (WHERE rate IS NOT NULL AND interval_hours > 0 AND rate_per_8h IS NULL) AS null_rate_per_8h,
           count(*) FILTER (WHERE rate IS NOT NULL AND interval_hours > 0 AND rate_annualized IS NULL)
               AS null_rate_annualized
    FROM ({SILVER_SQL}) s
""")
def silver_gate_metrics(spark, sf_dir):
    """Silver gate: keys, issues and gaps in derived columns."""
    silver = landed(silver_rows(explode_polls(landed_polls(spark, sf_dir), preset.FEED.vendor_fields), PLAN), "silver")
    eligible = F.col("rate").isNotNull() & F.coalesce(F.col("interval_hours") > 0, F.lit(False))
    return gates.silver_metrics(silver, preset.FEED.key, eligible, ["rate_per_8h", "rate_annualized"])


@query(f"""
    SELECT (SELECT count(*) FROM ({SILVER_SQL}) s) AS bronze_count,
           (SELECT count(*) FROM ({SILVER_SQL}) s) AS silver_count,
           (SELECT count(*) FROM ({SILVER_SQL}) s) AS gold_count, 0 AS bronze_minus_silver, 0 AS silver_minus_gold
""")
def layer_reconciliation(spark, sf_dir):
    """Row counts of the three loaded layers."""
    bronze, silver, gold = load_layers(spark, sf_dir)
    domain = accepted(bronze.read()).where(F.col("base_coin") == "BTC")
    return gates.reconciliation_gate(domain, silver.read(), gold.read()).metrics


