"""Key, freshness, lag, reconciliation and contract audits, and result comparison."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pollpipe.functions import minutes_between
from pollpipe.operators import (
    Case, approx_key_metrics, check_contract, compare_results, key_counts, key_differences, key_metrics, latest_poll, layer_lag,
    lost_keys,
    repeated_keys, row_counts, rows_at_latest, score_summary, scorecard, side_by_side,
)
from pollpipe.plans.gates import gold_metrics
from pollpipe.spec import Contract, ContractColumn

from .changes import FEATURES_SQL, features
from .registry import query, table

LINE_KEY = ("l_orderkey", "l_linenumber")


@query("""
    SELECT count(*) AS rows, count(DISTINCT (l_orderkey, l_linenumber)) AS unique_keys,
           count(*) = count(DISTINCT (l_orderkey, l_linenumber)) AS ok
    FROM lineitem
""")
def dup_key_audit(spark, sf_dir):
    """Rows against distinct keys, in one pass."""
    totals = table(spark, sf_dir, "lineitem").agg(*key_metrics(LINE_KEY))
    return totals.withColumn("ok", F.col("rows") == F.col("unique_keys"))


@query("""
    SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem
    GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
""")
def duplicate_keys(spark, sf_dir):
    """The keys that occur more than once."""
    return repeated_keys(table(spark, sf_dir, "lineitem"), LINE_KEY)


@query("""
    SELECT count(*) AS rows, count(DISTINCT (l_orderkey, l_linenumber)) AS exact_keys, true AS within FROM lineitem
""")
def dup_key_audit_approx(spark, sf_dir):
    """The same audit from a sketch, and whether it is within four of its standard errors."""
    lines = table(spark, sf_dir, "lineitem")
    sketch, exact = lines.agg(*approx_key_metrics(LINE_KEY)), key_counts(lines, LINE_KEY)
    both = side_by_side(sketch.withColumnRenamed("unique_keys", "sketched"), exact.select(F.col("unique_keys").alias("exact_keys")))
    within = F.abs(F.col("sketched") - F.col("exact_keys")) <= 4 * 0.01 * F.col("exact_keys")
    return both.select("rows", "exact_keys", within.alias("within"))


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as polls: all rows of an hour share their poll time."""
    return table(spark, sf_dir, "events").withColumn("poll", F.date_trunc("hour", "ts").cast("timestamp_ntz"))


@query("""
    SELECT max(poll) AS latest_fetched_at,
           count(*) FILTER (WHERE poll = (SELECT max(date_trunc('hour', ts)) FROM events))
               AS latest_poll_contract_count,
           round((epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(max(poll))) / 6e7, 1) AS age_minutes
    FROM (SELECT date_trunc('hour', ts)::TIMESTAMP AS poll FROM events) e
""")
def latest_poll_audit(spark, sf_dir):
    """Newest poll, its size and its age at a given time."""
    as_of = F.lit(dt.datetime(2024, 1, 31))
    newest = latest_poll(hourly(spark, sf_dir), "poll")
    return newest.withColumn("age_minutes", minutes_between(as_of, F.col("latest_fetched_at")))


@query("""
    SELECT event_id, user_id, value FROM events
    WHERE date_trunc('hour', ts) = (SELECT max(date_trunc('hour', ts)) FROM events)
""")
def rows_of_latest_poll(spark, sf_dir):
    """The rows of the newest poll."""
    return rows_at_latest(hourly(spark, sf_dir), "poll").select("event_id", "user_id", "value")


@query("""
    SELECT *, round((epoch_us(orders_latest) - epoch_us(shipments_latest)) / 6e7, 1) AS lag_minutes FROM (
        SELECT (SELECT max(o_orderdate) FROM orders) AS orders_latest,
               (SELECT max(l_shipdate) FROM lineitem) AS shipments_latest
    ) latest
""")
def layer_lag_minutes(spark, sf_dir):
    """How far one table is behind another."""
    up = table(spark, sf_dir, "orders").select(F.col("o_orderdate").alias("at"))
    down = table(spark, sf_dir, "lineitem").select(F.col("l_shipdate").alias("at"))
    lag = layer_lag(up, down, "at", ("orders", "shipments"))
    return lag.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("orders_latest", "shipments_latest")})


@query(f"""
    SELECT count(*) AS rows, count(DISTINCT event_id) AS unique_keys,
           count(*) FILTER (WHERE is_large_move) AS large_move_rows, count(*) FILTER (WHERE is_frozen) AS frozen_rows
    FROM ({FEATURES_SQL}) f
""")
def flag_counts(spark, sf_dir):
    """Rows per flag, with the key audit, in one pass."""
    return gold_metrics(features(spark, sf_dir), ["event_id"])


@query("""
    SELECT *, orders_count - fulfilled_count AS orders_minus_fulfilled FROM (
        SELECT (SELECT count(*) FROM orders) AS orders_count,
               (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') AS fulfilled_count
    ) counts
""")
def row_reconciliation(spark, sf_dir):
    """Row counts of two layers and their signed difference."""
    orders = table(spark, sf_dir, "orders")
    return row_counts({"orders": orders, "fulfilled": orders.where(F.col("o_orderstatus") == "F")})


@query("""
    SELECT DISTINCT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
""")
def lost_order_keys(spark, sf_dir):
    """Keys of one layer that never reached the next."""
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return lost_keys(table(spark, sf_dir, "orders"), lines, ["o_orderkey"])


CONTRACT = Contract(
    columns=(
        ContractColumn("o_orderkey", "bigint"),
        ContractColumn("o_custkey", "int"),
        ContractColumn("o_orderstatus", "string", values=("F", "O")),
        ContractColumn("o_orderpriority", "string", nullable=True, values=("1-URGENT", "2-HIGH")),
        ContractColumn("o_orderdate", "timestamp_ntz"),
        ContractColumn("o_comment", "string"),
    ),
    grain=("o_custkey", "o_orderdate"),
    time="o_orderdate",
    max_lag_minutes=30,
)


@query("""
    SELECT 'missing_column' AS rule, 'o_comment' AS column_name, 1 AS violations
    UNION ALL SELECT 'unexpected_column', 'o_totalprice', 1
    UNION ALL SELECT 'wrong_type', 'o_custkey', 1
    UNION ALL SELECT 'not_null', 'o_orderkey', count(*) FILTER (WHERE o_orderkey IS NULL) FROM orders
    UNION ALL SELECT 'not_null', 'o_custkey', count(*) FILTER (WHERE o_custkey IS NULL) FROM orders
    UNION ALL SELECT 'not_null', 'o_orderstatus', count(*) FILTER (WHERE o_orderstatus IS NULL) FROM orders
    UNION ALL SELECT 'not_null', 'o_orderdate', count(*) FILTER (WHERE o_orderdate IS NULL) FROM orders
    UNION ALL SELECT 'allowed_values', 'o_orderstatus', count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O'))
        FROM orders
    UNION ALL SELECT 'allowed_values', 'o_orderpriority',
        count(*) FILTER (WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')) FROM orders
    UNION ALL SELECT 'unique_grain', 'o_custkey,o_orderdate', count(*) - count(DISTINCT (o_custkey, o_orderdate))
        FROM orders
    UNION ALL SELECT 'freshness', 'o_orderdate',
        CASE WHEN max(o_orderdate) >= TIMESTAMP '2001-08-02 00:00:00' - INTERVAL 30 MINUTE THEN 0 ELSE 1 END
        FROM orders
""")
def contract_check(spark, sf_dir):
    """Schema, nullability, values, grain and freshness against a declared contract."""
    as_of = F.lit(dt.datetime(2001, 8, 2))
    return check_contract(table(spark, sf_dir, "orders"), CONTRACT, as_of)


# ------------------------------------------------------------------ comparing results


def status_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


def perturbed(golden: DataFrame) -> DataFrame:
    """Renamed columns; some totals slightly off, some far off, some keys lost or new."""
    n, total = F.col("n"), F.col("total")
    shifted = F.when(n == 9, total * 1.5).when(n == 11, total * 1.0005).otherwise(total)
    key = F.when(n == 12, F.col("o_custkey") + 1_000_000_000).otherwise(F.col("o_custkey"))
    return golden.select(key.alias("o_custkey"), shifted.alias("amount"), n.alias("orders"))


_GOLDEN = "SELECT o_custkey, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY o_custkey"


@query(f"""
    SELECT o_custkey, 1 AS golden_rows, CASE WHEN n = 12 THEN 0 ELSE 1 END AS actual_rows,
           CASE WHEN n = 9 THEN 'total' END AS mismatch
    FROM ({_GOLDEN}) g
    UNION ALL SELECT o_custkey + 1000000000, 0, 1, NULL FROM ({_GOLDEN}) g WHERE n = 12
""")
def result_differences(spark, sf_dir):
    """Per key: present on which side, and the first value without a close number."""
    golden = status_totals(spark, sf_dir)
    return key_differences(golden, perturbed(golden), ["o_custkey"])


@query("""
    WITH g AS (SELECT o_orderstatus, count(*) AS n, sum(o_totalprice) AS total FROM orders GROUP BY o_orderstatus)
    SELECT 'same' AS case_id, true AS passed, 'ok' AS reason, 0 AS repeated_golden, 0 AS missing
    UNION ALL SELECT 'empty', false, 'the actual side is empty', 0, count(*) FROM g
    UNION ALL SELECT 'grain', max(n) <= 1,
        CASE WHEN max(n) > 1 THEN 'the actual side has several rows for one key' ELSE 'ok' END, 0, 0 FROM g
    UNION ALL SELECT 'key', false, 'the actual side lacks the key columns o_orderstatus', 0, NULL
    UNION ALL SELECT 'values', false, 'no number near golden total at key ' || min(o_orderstatus), 0, 0 FROM g
    UNION ALL SELECT 'lost', count(*) FILTER (WHERE n = (SELECT min(n) FROM g)) = 0,
        count(*) FILTER (WHERE n = (SELECT min(n) FROM g)) || ' golden keys were not found, the smallest is '
            || min(o_orderstatus) FILTER (WHERE n = (SELECT min(n) FROM g)),
        0, count(*) FILTER (WHERE n = (SELECT min(n) FROM g)) FROM g
""")
def comparison_scorecard(spark, sf_dir):
    """One verdict per case, each case failing for another reason."""
    orders = table(spark, sf_dir, "orders")
    counted = orders.groupBy("o_orderstatus").agg(F.sum("o_totalprice").alias("total"), F.count(F.lit(1)).alias("n"))
    golden = counted.drop("n")
    renamed = golden.withColumnRenamed("total", "amount")
    cases = {
        "same": renamed,
        "empty": golden.where(F.col("total") < 0),
        "grain": orders.select("o_orderstatus", F.col("o_totalprice").alias("total")),
        "key": golden.withColumnRenamed("o_orderstatus", "status"),
        "values": renamed.withColumn("amount", F.col("amount") * 1.01),
        "lost": counted.where(F.col("n") > counted.agg(F.min("n")).scalar()).select("o_orderstatus", F.col("total").alias("amount")),
    }
    return scorecard([Case(name, golden, actual, ("o_orderstatus",), True) for name, actual in cases.items()])


@query(f"""
    SELECT count(*) FILTER (WHERE ok) AS passed, count(*) AS total FROM (
        SELECT count(*) FILTER (WHERE n <= 10) = 0 AS ok FROM ({_GOLDEN}) g
        UNION ALL SELECT count(*) FILTER (WHERE n > 10) > 0 FROM ({_GOLDEN}) g
        UNION ALL SELECT count(DISTINCT o_orderstatus) = 1 FROM orders
        UNION ALL SELECT count(*) > 0 FROM orders
    ) cases
""")
def comparison_summary(spark, sf_dir):
    """Passed and total; lost keys fail a case of any size unless it allows for them."""
    orders = table(spark, sf_dir, "orders")
    large, small = status_totals(spark, sf_dir), orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    cases = [
        Case("cut large", large, large.where(F.col("n") > 10), ("o_custkey",), True),
        Case("capped large", large, large.where(F.col("n") > 10), ("o_custkey",), True, allow_missing=True),
        Case("cut small", small, small.where(F.col("o_orderstatus") == "F"), ("o_orderstatus",), True),
        Case("whole small", small, small, ("o_orderstatus",), True),
    ]
    return score_summary(scorecard(cases))


@query(f"""
    SELECT false AS passed, count(*) || ' keys are unknown to golden, the smallest is '
           || min(CAST(o_custkey + 1000000000 AS VARCHAR)) AS reason, 0 AS repeated_golden, count(*) AS missing
    FROM ({_GOLDEN}) g WHERE n = 12
""")
def result_verdict(spark, sf_dir):
    """The first failed check as one row."""
    golden = status_totals(spark, sf_dir)
    return compare_results(golden, perturbed(golden), ["o_custkey"], check_values=True)
