"""Window questions answered from daily partials that are kept up through appends and late repairs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pollpipe.plans import DayPartials, PartialSpec, build_features, repair_late_rows
from pollpipe.plans import partials as ask

from .carried import STATE_COLUMNS
from .changes import FEATURES_SQL, LEVELS, SERIES, measures
from .loads import SOURCE_COLUMNS, event_tables
from .registry import fresh_dir, query

SPEC = PartialSpec(
    measures=("value", "level_change"), flags=("is_large_move", "is_frozen"), pairs=(("value_change", "k_change"),), calibrated=("value_change",)
)
#: Clicks with a small number on these days of the month arrive late.
LATE_DAYS = (10, 12)
_LATE = "event_type = 'click' AND CAST(json_extract_string(props, '$.k') AS INT) < 20 AND day(ts) BETWEEN 10 AND 12"
#: Windows end at the end of the data; this one begins within a day.
SINCE, SINCE_SQL = dt.datetime(2024, 1, 8, 13, 30), "TIMESTAMP '2024-01-08 13:30:00'"


def kept_partials(spark: SparkSession, sf_dir: str) -> tuple[DayPartials, list[dt.date]]:
    """Partials of the features of events: kept up from a first load, then refreshed after late rows were
    repaired. Also the days that the second refresh computed."""
    source, target = event_tables(spark, "source", "features")
    rows = measures(spark, sf_dir).select(*SOURCE_COLUMNS)
    late = (F.col("event_type") == "click") & (F.col("k") < 20) & F.dayofmonth("ts").between(*LATE_DAYS)
    source.append(rows.where(~late))
    build_features(source, target, LEVELS, STATE_COLUMNS, None)
    partials = DayPartials(target, fresh_dir(spark, "partials"), SERIES, SPEC)
    partials.refresh()
    source.append(rows.where(late))
    repair_late_rows(source, target, LEVELS, STATE_COLUMNS, None, arrived=rows.where(late))
    return partials, partials.refresh()


def kept_states(spark: SparkSession, sf_dir: str, since: dt.datetime | None = SINCE) -> DataFrame:
    return kept_partials(spark, sf_dir)[0].states(since)


@query(f"""
    SELECT strftime(ts, '%Y-%m-%d') AS day FROM (
        SELECT ts, max(CASE WHEN {_LATE} THEN 1 ELSE 0 END) OVER (
            PARTITION BY user_id, event_type ORDER BY ts, event_id ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS touched
        FROM events
    ) marked WHERE touched = 1 GROUP BY 1
""")
def partial_days_rebuilt(spark, sf_dir):
    """Days that a refresh after a late repair computes again: those with late rows or rows that see one."""
    days = kept_partials(spark, sf_dir)[1]
    return spark.createDataFrame([(str(d),) for d in days], "day string")


@query(f"""
    SELECT event_type, round(avg(value), 6) AS average_value FROM events WHERE ts >= {SINCE_SQL} GROUP BY event_type
""")
def partial_averages(spark, sf_dir):
    """Average value per type over a window, from the partials."""
    means = ask.average_of_states(kept_states(spark, sf_dir), ["event_type"], "value", name="average_value")
    return means.withColumn("average_value", F.round("average_value", 6))


@query(f"""
    SELECT user_id, event_type, count_if(is_large_move) AS large_move_count,
           max(ts) FILTER (WHERE is_large_move) AS last_large_move_at
    FROM ({FEATURES_SQL}) f WHERE ts >= {SINCE_SQL} GROUP BY user_id, event_type HAVING count_if(is_large_move) > 0
""")
def partial_large_moves(spark, sf_dir):
    """Large moves per series over a window and the last of them, from the partials."""
    return ask.flagged_of_states(kept_states(spark, sf_dir), SERIES, "is_large_move")


@query(f"""
    SELECT user_id, max(abs(level_change)) AS largest_move FROM ({FEATURES_SQL}) f WHERE ts >= {SINCE_SQL}
    GROUP BY user_id ORDER BY largest_move DESC NULLS LAST, user_id LIMIT 10
""")
def partial_largest_moves(spark, sf_dir):
    """The ten users with the largest change over a window, from the partials."""
    return ask.largest_of_states(kept_states(spark, sf_dir), ["user_id"], "level_change", k=10)


@query(f"""
    SELECT user_id, event_type, count(*) AS frozen_rows, max(ts) AS last_seen_at
    FROM ({FEATURES_SQL}) f WHERE is_frozen AND ts >= {SINCE_SQL} GROUP BY user_id, event_type
""")
def partial_frozen(spark, sf_dir):
    """Series that were frozen in a window, from the partials."""
    return ask.flagged_of_states(kept_states(spark, sf_dir), SERIES, "is_frozen", count="frozen_rows", last="last_seen_at")


@query(f"""
    SELECT event_type, user_id, count(*) AS pairs,
           round(covar_pop(value_change, k_change) / nullif(stddev_pop(value_change) * stddev_pop(k_change), 0), 6) AS correlation
    FROM ({FEATURES_SQL}) f WHERE value_change IS NOT NULL AND k_change IS NOT NULL AND ts >= {SINCE_SQL}
    GROUP BY event_type, user_id
""")
def partial_correlation(spark, sf_dir):
    """Correlation of two changes per series over a window, from co-moments of days."""
    rows = ask.correlation_of_states(kept_states(spark, sf_dir), SERIES, "value_change", "k_change")
    return rows.withColumn("correlation", F.round("correlation", 6))


@query("""
    SELECT user_id, count(*) AS n, max(ts) AS last_seen_at FROM events GROUP BY user_id ORDER BY n DESC, user_id
""")
def partial_rows(spark, sf_dir):
    """Rows of every user and when it was seen last, over all days, from the partials."""
    return ask.rows_of_states(kept_states(spark, sf_dir, None), ["user_id"])


@query(f"""
    SELECT round(quantile_cont(abs(value_change), 0.99), 6) AS threshold, count(value_change) AS counted,
           count(*) - count(value_change) AS missing
    FROM ({FEATURES_SQL}) f WHERE ts >= {SINCE_SQL}
""")
def window_threshold(spark, sf_dir):
    """Exact calibration over a window: kept sketches of days bracket the rank, one pass counts inside."""
    found = kept_partials(spark, sf_dir)[0].threshold("value_change", 0.99, SINCE)
    rows = [(found.value, found.counted, found.missing)]
    return spark.createDataFrame(rows, "threshold double, counted long, missing long").withColumn("threshold", F.round("threshold", 6))


@query(f"""
    WITH first AS (SELECT DISTINCT user_id, event_type FROM events WHERE ts < TIMESTAMP '2024-01-03 00:00:00'),
    second AS (SELECT DISTINCT user_id, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-29 13:30:00'),
    counted AS (SELECT (SELECT count(*) FROM first) AS first, (SELECT count(*) FROM second) AS second,
                       (SELECT count(*) FROM (SELECT * FROM first INTERSECT SELECT * FROM second)) AS shared)
    SELECT first, second, first + second - shared AS either, shared FROM counted
""")
def distinct_by_window(spark, sf_dir):
    """Series of the first two days, of the last ones, and of both, from sketches of days: exact up to
    16,384 series per window, beyond that within 2 % in 99 of 100 cases (``shared``: 2 % of ``either``)."""
    partials = kept_partials(spark, sf_dir)[0]
    return ask.series_in_both(partials.sketches(until=dt.date(2024, 1, 2)), partials.sketches(dt.datetime(2024, 1, 29, 13, 30)))
