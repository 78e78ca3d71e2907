"""Casting, derivations, quality rules and profiles over ``lineitem`` and ``orders``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pollpipe.functions import Rule, quality_tags, rate_per_basis, rate_per_year, seconds_between
from pollpipe.operators import (
    accepted, cast_fields, derived_metrics, explode_polls, issue_rows, problem_fields, profile_fields,
)
from pollpipe.presets.perpetuals import quality_rules
from pollpipe.session import written
from pollpipe.spec import Field

from .polls import listed
from .registry import arrived, query, table

# ------------------------------------------------------------------ casting

FIELDS = (
    Field("quantity", "float"),
    Field("line", "int"),
    Field("shipped", "datetime"),
    Field("flag", "str"),
    Field("late", "bool"),
    Field("tax", "float", nullable=True),
)


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as JSON records in which the line number decides what is malformed."""
    li = table(spark, sf_dir, "lineitem")
    n = F.col("l_linenumber")
    quantity = F.col("l_quantity").cast("string")
    day = F.date_format("l_shipdate", "yyyy-MM-dd")

    def quoted(text):
        return F.concat(F.lit('"'), text, F.lit('"'))

    fields = {
        "quantity": F.when(n == 1, quantity).when(n == 2, quoted(quantity)).when(n == 3, '"1.5d"').when(
            n == 4, '"NaN"').when(n == 5, "true").when(n == 6, "[1]").otherwise('"not_a_number"'),
        "line": F.when(n == 1, "1").when(n == 2, "2.9").when(n == 3, '"3"').when(n == 4, '"4.9"').when(
            n == 5, '"1_000"').when(n == 6, "1e400").otherwise("null"),
        "shipped": F.when(n == 1, quoted(day)).when(n == 2, quoted(F.concat(day, F.lit("T08:30:00+02:00")))).when(
            n == 3, '"2026"').when(n == 4, '"12:00:00"').when(n == 5, '"2026-02-30"').when(n == 6, "20260918").otherwise(
            quoted(F.concat(day, F.lit("T00:00:00.250Z")))),
        "flag": F.when(n == 7, "7").otherwise(quoted(F.col("l_returnflag"))),
        "late": F.when(n == 1, "true").when(n == 2, '"true"').when(n == 3, "1").otherwise("false"),
    }
    tax = F.when(n > 4, F.lit(', "tax": null')).when(n > 2, F.concat(F.lit(', "tax": '), F.col("l_tax"))).otherwise("")
    body = F.concat(
        *[F.concat(F.lit(f'"{name}": '), value, F.lit(", ") if name != "late" else F.lit(""))
          for name, value in fields.items()],
        tax,
    )
    polls = li.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.lit("2024-01-01T00:00:00+00:00").alias("fetched_at"),
        F.lit(200).alias("status_code"),
        F.concat(F.lit('{"data": [{'), body, F.lit("}]}")).alias("payload"),
    )
    return accepted(explode_polls(spark.read.parquet(arrived(polls, "lines")), [f.name for f in FIELDS]))


TYPED_SQL = """
    SELECT l_orderkey, l_linenumber, l_partkey,
           CASE l_linenumber WHEN 1 THEN l_quantity WHEN 2 THEN l_quantity WHEN 5 THEN 1.0 END AS quantity,
           CASE l_linenumber WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 3 WHEN 5 THEN 1000 END AS line,
           CASE l_linenumber WHEN 1 THEN l_shipdate WHEN 2 THEN l_shipdate + INTERVAL 390 MINUTE
                             WHEN 7 THEN l_shipdate + INTERVAL 250 MILLISECOND END AS shipped,
           CASE WHEN l_linenumber < 7 THEN l_returnflag END AS flag,
           CASE WHEN l_linenumber = 1 THEN true WHEN l_linenumber > 3 THEN false END AS late,
           CASE WHEN l_linenumber IN (3, 4) THEN l_tax END AS tax,
           concat_ws(',', CASE WHEN l_linenumber IN (3, 4, 6, 7) THEN 'quantity' END,
                          CASE WHEN l_linenumber IN (4, 6) THEN 'line' END,
                          CASE WHEN l_linenumber IN (3, 4, 5, 6) THEN 'shipped' END,
                          CASE WHEN l_linenumber = 7 THEN 'flag' END,
                          CASE WHEN l_linenumber IN (2, 3) THEN 'late' END) AS issues
    FROM lineitem
"""


def typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = {k: F.col(k) for k in ("l_orderkey", "l_linenumber", "l_partkey")}
    return cast_fields(raw_records(spark, sf_dir), FIELDS, keys, issues="issues")


@query(f"SELECT l_orderkey, l_linenumber, l_partkey, quantity, line, shipped, flag, late, tax FROM ({TYPED_SQL}) t")
def typed_cast(spark, sf_dir):
    """Strict casts of well-formed and malformed values of every type."""
    return typed(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", "l_partkey", "quantity", "line",
        F.col("shipped").cast("timestamp_ntz").alias("shipped"), "flag", "late", "tax",
    )


@query(f"SELECT l_orderkey, l_linenumber, l_partkey, issues FROM ({TYPED_SQL}) t")
def cast_issues(spark, sf_dir):
    """Names of the fields that failed, in field order."""
    return typed(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_partkey", listed("issues").alias("issues"))


PROFILE_SQL = """
    SELECT 'quantity' AS field, 0 AS null_count, 0 AS unexpected_null_count,
           count(*) FILTER (WHERE l_linenumber IN (3, 4, 6, 7)) AS cast_failure_count FROM lineitem
    UNION ALL SELECT 'line', count(*) FILTER (WHERE l_linenumber = 7), count(*) FILTER (WHERE l_linenumber = 7),
           count(*) FILTER (WHERE l_linenumber IN (4, 6)) FROM lineitem
    UNION ALL SELECT 'shipped', 0, 0, count(*) FILTER (WHERE l_linenumber IN (3, 4, 5, 6)) FROM lineitem
    UNION ALL SELECT 'flag', 0, 0, count(*) FILTER (WHERE l_linenumber = 7) FROM lineitem
    UNION ALL SELECT 'late', 0, 0, count(*) FILTER (WHERE l_linenumber IN (2, 3)) FROM lineitem
    UNION ALL SELECT 'tax', count(*) FILTER (WHERE l_linenumber NOT IN (3, 4)), 0, 0 FROM lineitem
"""


@query(f"""
    SELECT p.*, coalesce(x.examples, '') AS examples FROM ({PROFILE_SQL}) p LEFT JOIN (
        SELECT field, string_agg(value, ',' ORDER BY value) AS examples FROM (
            SELECT field, value FROM (
                SELECT 'quantity' AS field, unnest(CASE l_linenumber WHEN 3 THEN ['1.5d'] WHEN 4 THEN ['NaN']
                    WHEN 6 THEN ['[1]'] WHEN 7 THEN ['not_a_number'] END) AS value FROM lineitem
                UNION ALL SELECT 'line', unnest(CASE l_linenumber WHEN 4 THEN ['4.9']
                    WHEN 6 THEN ['Infinity'] END) FROM lineitem
                UNION ALL SELECT 'shipped', unnest(CASE l_linenumber WHEN 3 THEN ['2026'] WHEN 4 THEN ['12:00:00']
                    WHEN 5 THEN ['2026-02-30'] WHEN 6 THEN ['20260918'] END) FROM lineitem
                UNION ALL SELECT 'flag', unnest(CASE WHEN l_linenumber = 7 THEN ['7'] END) FROM lineitem
                UNION ALL SELECT 'late', unnest(CASE l_linenumber WHEN 2 THEN ['true'] WHEN 3 THEN ['1'] END)
                FROM lineitem
            ) v QUALIFY row_number() OVER (PARTITION BY field ORDER BY value) <= 3
        ) s GROUP BY field
    ) x USING (field)
""")
def column_profile(spark, sf_dir):
    """Nulls, cast failures and three failing texts per field."""
    report = profile_fields(written(raw_records(spark, sf_dir), "bronze"), FIELDS)
    return report.withColumn("examples", listed("cast_failure_examples")).drop("cast_failure_examples")


@query(f"""
    SELECT field, unexpected_null_count, cast_failure_count FROM ({PROFILE_SQL}) p
    WHERE unexpected_null_count > 0 OR cast_failure_count > 0
""")
def profile_problems(spark, sf_dir):
    """Only the fields that need attention."""
    report = problem_fields(profile_fields(written(raw_records(spark, sf_dir), "bronze"), FIELDS))
    return report.select("field", "unexpected_null_count", "cast_failure_count")


# ------------------------------------------------------------------ derivations and rules


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their order date, in the roles that the rules look at."""
    li, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    joined = li.join(orders.select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.col("l_discount").alias("rate"),
        (F.col("l_linenumber") - 1).cast("bigint").alias("interval_hours"),
        (F.col("l_extendedprice") - 20000).alias("mark_price"),
        F.when(F.col("l_linenumber") > 1, F.col("l_quantity") - 5).alias("open_interest"),
        F.col("o_orderdate").alias("fetched_at"),
        F.col("l_shipdate").alias("updated_at"),
        (F.col("l_shipdate") + F.make_dt_interval(F.col("l_linenumber") - 4)).alias("next_funding_time"),
        (F.col("l_quantity") - 3).cast("bigint").alias("age_seconds"),
    )


SHIPMENTS_SQL = """
    SELECT l_orderkey, l_linenumber, l_partkey, l_discount AS rate, CAST(l_linenumber - 1 AS BIGINT) AS interval_hours,
           l_extendedprice - 20000 AS mark_price,
           CASE WHEN l_linenumber > 1 THEN l_quantity - 5 END AS open_interest,
           o_orderdate AS fetched_at, l_shipdate AS updated_at,
           l_shipdate + (l_linenumber - 4) * INTERVAL 1 DAY AS next_funding_time,
           CAST(l_quantity - 3 AS BIGINT) AS age_seconds
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""

TAGS_SQL = f"""
    SELECT l_orderkey, l_linenumber, l_partkey, concat_ws(',',
               CASE WHEN interval_hours <= 0 THEN 'invalid_interval_hours' END,
               CASE WHEN age_seconds <= 0 THEN 'invalid_age_seconds' END,
               CASE WHEN updated_at > fetched_at THEN 'updated_at_after_fetched_at' END,
               CASE WHEN next_funding_time < fetched_at THEN 'stale_next_funding_time' END,
               CASE WHEN next_funding_time <= updated_at THEN 'next_funding_time_not_after_updated_at' END,
               CASE WHEN mark_price <= 0 THEN 'invalid_mark_price' END,
               CASE WHEN open_interest < 0 THEN 'negative_open_interest' END,
               CASE WHEN abs(rate) > 0.05 THEN 'implausible_rate_magnitude' END) AS tags
    FROM ({SHIPMENTS_SQL}) s
"""


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey,
           CASE WHEN l_linenumber > 1 THEN l_discount * 8.0::DOUBLE / (l_linenumber - 1) END AS rate_per_8h,
           CASE WHEN l_linenumber > 1 THEN l_discount * (8760.0::DOUBLE / (l_linenumber - 1)) END AS rate_annualized
    FROM lineitem
""")
def normalize_rates(spark, sf_dir):
    """Rates on an 8-hour and a yearly basis; NULL for an interval of zero."""
    rate, hours = F.col("l_discount"), F.col("l_linenumber") - 1
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        rate_per_basis(rate, hours).alias("rate_per_8h"),
        rate_per_year(rate, hours).alias("rate_annualized"),
    )


@query(f"""
    SELECT l_orderkey, l_linenumber, l_partkey, (epoch_us(updated_at) - epoch_us(fetched_at)) / 1e6 AS lag_seconds
    FROM ({SHIPMENTS_SQL}) s
""")
def poll_lag(spark, sf_dir):
    """Signed seconds between two times of a row."""
    lag = seconds_between(F.col("updated_at"), F.col("fetched_at"))
    return shipments(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_partkey", lag.alias("lag_seconds"))


@query(TAGS_SQL)
def quality_tags_of_rows(spark, sf_dir):
    """All broken rules of each row; rows are kept."""
    tags = listed(quality_tags(quality_rules()))
    return shipments(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_partkey", tags.alias("tags"))


@query(f"SELECT tag, count(*) AS rows FROM (SELECT unnest(string_split(tags, ',')) AS tag FROM ({TAGS_SQL}) t) u "
       "WHERE tag <> '' GROUP BY tag")
def rows_per_tag(spark, sf_dir):
    """How many rows each rule flags."""
    tagged = shipments(spark, sf_dir).withColumn("tags", quality_tags(quality_rules()))
    issues = issue_rows(tagged, ["l_orderkey"], {"quality": "tags"})
    return issues.groupBy("tag").agg(F.count(F.lit(1)).alias("rows"))


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey,
           concat_ws(',', CASE WHEN l_quantity >= 50 THEN 'bulk' END, CASE WHEN l_tax = 0 THEN 'untaxed' END) AS tags
    FROM lineitem
""")
def custom_rules(spark, sf_dir):
    """Rules of the caller's own, on the same footing."""
    rules = [Rule("bulk", F.col("l_quantity") >= 50), Rule("untaxed", F.col("l_tax") == 0)]
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", listed(quality_tags(rules)).alias("tags")
    )


@query("""
    SELECT count(*) FILTER (WHERE l_discount IS NOT NULL AND l_linenumber > 1) AS eligible_rows,
           count(*) FILTER (WHERE l_discount IS NOT NULL AND l_linenumber > 1
               AND l_discount * 8.0 / nullif(l_linenumber - 1, 0) IS NULL) AS null_rate_per_8h,
           count(*) FILTER (WHERE l_discount IS NOT NULL AND l_linenumber > 1 AND l_quantity >= 45) AS null_rate_annualized
    FROM lineitem
""")
def derived_populated(spark, sf_dir):
    """Derived columns are filled wherever they can be computed; one of them was emptied here and there."""
    rate, hours = F.col("l_discount"), F.col("l_linenumber") - 1
    rows = table(spark, sf_dir, "lineitem").select(
        rate.alias("rate"), hours.alias("hours"),
        rate_per_basis(rate, hours).alias("rate_per_8h"), F.when(F.col("l_quantity") < 45, rate_per_year(rate, hours)).alias("rate_annualized"),
    )
    eligible = F.col("rate").isNotNull() & F.coalesce(F.col("hours") > 0, F.lit(False))
    return rows.agg(*derived_metrics(eligible, ["rate_per_8h", "rate_annualized"]))
