"""Questions over the change features of ``events``: the ways a feature table is asked."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from pollpipe.operators import cap_rows, governed, latest_rows, top_k
from pollpipe.plans import analytics as ask
from pollpipe.spec import Contract, ContractColumn

from .changes import FEATURES_SQL, SERIES, features
from .registry import query, table

AS_OF = dt.datetime(2024, 1, 31)
AS_OF_SQL = "TIMESTAMP '2024-01-31 00:00:00'"


def as_of():
    return F.lit(AS_OF).cast("timestamp_ntz")


@query(f"""
    SELECT event_type, round(avg(value), 6) AS average_value FROM events
    WHERE ts >= {AS_OF_SQL} - INTERVAL 7 DAY
    GROUP BY event_type ORDER BY avg(value) DESC, event_type
""")
def average_by_type(spark, sf_dir):
    """Average value per type over the last 7 days."""
    means = ask.average_by(
        table(spark, sf_dir, "events"), ["event_type"], "value", "ts", 7, as_of(), name="average_value"
    )
    return means.withColumn("average_value", F.round("average_value", 6))


@query(f"""
    SELECT user_id, round(avg(value), 6) AS average_value FROM events
    WHERE ts >= {AS_OF_SQL} - INTERVAL 30 DAY GROUP BY user_id
""")
def average_by_user(spark, sf_dir):
    """Average value of every user over the default window."""
    means = ask.average_by(table(spark, sf_dir, "events"), ["user_id"], "value", "ts", as_of=as_of(), name="average_value")
    return means.withColumn("average_value", F.round("average_value", 6))


@query("""
    SELECT user_id, event_type, value, ts FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1
""")
def latest_per_entity(spark, sf_dir):
    """Newest value of every series."""
    events = table(spark, sf_dir, "events")
    return ask.latest_values(events, SERIES, "ts", ["value"], ["event_id"]).drop("event_id")


@query(f"""
    SELECT user_id, max(abs(value_change)) AS largest_move FROM ({FEATURES_SQL}) f
    WHERE ts >= {AS_OF_SQL} - INTERVAL 30 DAY
    GROUP BY user_id ORDER BY largest_move DESC NULLS LAST, user_id LIMIT 10
""")
def largest_moves(spark, sf_dir):
    """Users with the largest absolute change."""
    return ask.largest_moves(features(spark, sf_dir), ["user_id"], "value_change", "ts", 30, as_of(), k=10)


@query(f"""
    SELECT user_id, event_type, count(*) AS large_move_count, max(ts) AS last_large_move_at
    FROM ({FEATURES_SQL}) f
    WHERE is_large_move AND ts >= {AS_OF_SQL} - INTERVAL 30 DAY
    GROUP BY user_id, event_type
    ORDER BY large_move_count DESC, user_id, event_type
""")
def large_move_counts(spark, sf_dir):
    """Series with large moves: how many, and when last."""
    return ask.large_move_counts(features(spark, sf_dir), SERIES, "ts", 30, as_of())


@query("SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey ORDER BY n DESC, l_orderkey")
def counts_of_many_groups(spark, sf_dir):
    """Rows per order, most first: far more than 10,000 groups, all of them returned."""
    return ask.rows_by(table(spark, sf_dir, "lineitem"), ["l_orderkey"])


@query("""
    SELECT user_id, event_type, value, ts FROM (
        SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1
    ) newest ORDER BY ts DESC, user_id, event_type LIMIT 25
""")
def newest_series(spark, sf_dir):
    """The 25 series that were seen last, newest first."""
    return ask.latest_values(table(spark, sf_dir, "events"), SERIES, "ts", ["value"], ["event_id"], k=25)


@query("SELECT least(count(*), 5000) AS rows, count(*) > 5000 AS truncated FROM events")
def capped_rows(spark, sf_dir):
    """A capped result says whether it was cut."""
    capped = cap_rows(table(spark, sf_dir, "events").select("event_id"), 5000)
    return capped.rows.agg(F.count(F.lit(1)).alias("rows")).withColumn("truncated", F.lit(capped.truncated))


@query(f"""
    SELECT user_id, event_type, max(ts) AS last_seen_at FROM ({FEATURES_SQL}) f
    WHERE is_frozen AND ts >= {AS_OF_SQL} - INTERVAL 30 DAY
    GROUP BY user_id, event_type ORDER BY last_seen_at DESC, user_id, event_type
""")
def frozen_entities(spark, sf_dir):
    """Series that were frozen at some time in the window."""
    return ask.frozen_series(features(spark, sf_dir), SERIES, "ts", 30, as_of())


@query(f"""
    SELECT user_id, event_type, level, ts FROM (
        SELECT * FROM ({FEATURES_SQL}) f
        QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1
    ) newest WHERE is_frozen
""")
def currently_frozen(spark, sf_dir):
    """Series whose newest row is frozen."""
    return ask.currently_frozen(features(spark, sf_dir), SERIES, "ts", ["level"], ["event_id"])


@query(f"""
    SELECT event_type, user_id, count(*) AS pairs,
           round(covar_pop(value_change, k_change)
                 / nullif(stddev_pop(value_change) * stddev_pop(k_change), 0), 6) AS correlation
    FROM ({FEATURES_SQL}) f
    WHERE value_change IS NOT NULL AND k_change IS NOT NULL
    GROUP BY event_type, user_id
""")
def change_correlation(spark, sf_dir):
    """Do two changes of a series move together?"""
    rows = ask.change_correlation(features(spark, sf_dir), SERIES, "value_change", "k_change")
    return rows.where(F.col("pairs") > 0).withColumn("correlation", F.round("correlation", 6))


@query("SELECT event_type, count(*) AS n FROM events GROUP BY event_type ORDER BY n DESC, event_type")
def entity_counts(spark, sf_dir):
    """Rows per type, largest first."""
    return ask.rows_by(table(spark, sf_dir, "events"), ["event_type"])


@query("SELECT count(DISTINCT user_id) AS users FROM events")
def distinct_users(spark, sf_dir):
    return table(spark, sf_dir, "events").agg(F.count_distinct("user_id").alias("users"))


@query("SELECT user_id, max(value) AS m FROM events GROUP BY user_id HAVING max(value) > 400")
def users_above(spark, sf_dir):
    """Users whose largest value exceeds a limit."""
    return ask.groups_above(table(spark, sf_dir, "events"), ["user_id"], "value", 400.0)


@query("SELECT user_id, event_type, max(ts) AS last_seen_at FROM events GROUP BY user_id, event_type")
def last_seen(spark, sf_dir):
    """The series that exist, with the time they were last seen."""
    return table(spark, sf_dir, "events").groupBy(*SERIES).agg(F.max("ts").alias("last_seen_at"))


@query("""
    SELECT event_id, user_id, value FROM events
    WHERE user_id IN (SELECT user_id FROM events WHERE value > 400)
""")
def semi_join_filter(spark, sf_dir):
    """Rows of users that exceeded a limit at any time."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    return ask.rows_of_members(events, ["user_id"], events.where(F.col("value") > 400))


@query("SELECT event_id, ts, value FROM events WHERE event_type = 'click' AND user_id = 8")
def one_series(spark, sf_dir):
    """All rows of one series; both conditions reach the scan."""
    events = table(spark, sf_dir, "events")
    mine = (F.col("event_type") == "click") & (F.col("user_id") == 8)
    return events.where(mine).select("event_id", "ts", "value")


ORDER_CONTRACT = Contract(
    columns=(
        ContractColumn("O_ORDERKEY", "bigint"),
        ContractColumn("o_totalprice", "double"),
        ContractColumn("o_orderdate", "timestamp_ntz"),
    ),
    grain=("o_orderkey",),
    max_rows=100,
)


@query("""
    SELECT o_orderkey AS "O_ORDERKEY", o_totalprice, o_orderdate FROM orders
    ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 100
""")
def governed_topk(spark, sf_dir):
    """Published columns only, ranked, with the contract's cap on an oversized request."""
    visible = governed(table(spark, sf_dir, "orders"), ORDER_CONTRACT)
    return top_k(visible, "o_totalprice", ["o_orderkey"], k=1_000_000, cap=ORDER_CONTRACT.max_rows)


@query(f"""
    SELECT event_type, n, newest FROM (
        SELECT event_type, count(*) AS n, max(ts) AS newest FROM (
            SELECT event_type, ts FROM events
            QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1
        ) latest GROUP BY event_type
    ) counted
""")
def latest_rows_by_type(spark, sf_dir):
    """Aggregate over the newest rows of all series."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    newest = latest_rows(events, SERIES, "ts", 1, ("event_id",))
    return newest.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.max("ts").alias("newest"))
