"""Predecessors, change features, calibration and latest rows over ``events``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pollpipe.operators import ChangeSpec, approx_percentile, change_features, exact_percentile, latest_rows
from pollpipe.operators.lags import with_previous

from .registry import query, table

SERIES = ("user_id", "event_type")
DAY = 86_400_000_000

LEVELS = ChangeSpec(
    entity=SERIES,
    time="ts",
    measure="level",
    change_as="level_change",
    threshold=2.0,
    changes=(("value", "value_change"), ("k", "k_change")),
    lookback=5,
    tiebreak=("event_id",),
)
BY_TYPE = ChangeSpec(
    entity=("event_type",),
    time="ts",
    measure="level",
    change_as="level_change",
    threshold=2.0,
    changes=(("value", "value_change"), ("k", "k_change")),
    lookback=5,
    tiebreak=("event_id",),
)
FEATURE_COLUMNS = (
    "event_id", "user_id", "event_type", "ts", "level", "level_change", "is_large_move", "is_frozen",
    "value_change", "k_change",
)


def measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a coarse level, the value and the number in ``props``."""
    events = table(spark, sf_dir, "events")
    return events.select(
        "event_id", "user_id", "event_type", "ts", "value",
        F.floor(F.col("value") / 100).cast("double").alias("level"),
        F.get_json_object("props", "$.k").cast("double").alias("k"),
    )


def features(spark: SparkSession, sf_dir: str, spec: ChangeSpec = LEVELS, slicing="auto") -> DataFrame:
    return change_features(measures(spark, sf_dir), spec, slicing)


MEASURES_SQL = """
    SELECT event_id, user_id, event_type, ts, value,
           floor(value / 100)::DOUBLE AS level,
           CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k
    FROM events
"""


def features_sql(entity: str, source: str = MEASURES_SQL) -> str:
    return f"""
    SELECT event_id, user_id, event_type, ts, level, value, k,
           level - l1 AS level_change,
           abs(level - l1) >= 2.0 AS is_large_move,
           CASE WHEN level IS NULL OR l1 IS NULL OR l2 IS NULL OR l3 IS NULL OR l4 IS NULL OR l5 IS NULL
                THEN NULL
                ELSE level = l1 AND level = l2 AND level = l3 AND level = l4 AND level = l5 END AS is_frozen,
           value - v1 AS value_change,
           k - k1 AS k_change
    FROM (
        SELECT *,
               lag(level, 1) OVER w AS l1, lag(level, 2) OVER w AS l2, lag(level, 3) OVER w AS l3,
               lag(level, 4) OVER w AS l4, lag(level, 5) OVER w AS l5,
               lag(value, 1) OVER w AS v1, lag(k, 1) OVER w AS k1
        FROM ({source}) m
        WINDOW w AS (PARTITION BY {entity} ORDER BY ts, event_id)
    ) lagged
    """


FEATURES_SQL = features_sql("user_id, event_type")
_COLUMNS = ", ".join(FEATURE_COLUMNS)


@query(f"SELECT {_COLUMNS} FROM ({FEATURES_SQL}) f")
def change_features_by_series(spark, sf_dir):
    """Change, large move and frozen flag against the predecessors in each series."""
    return features(spark, sf_dir).select(*FEATURE_COLUMNS)


@query(f"SELECT {_COLUMNS} FROM ({features_sql('event_type')}) f")
def change_features_hot_series(spark, sf_dir):
    """The same for five very long series, cut into days."""
    return features(spark, sf_dir, BY_TYPE, slicing=DAY).select(*FEATURE_COLUMNS)


@query(f"SELECT {_COLUMNS} FROM ({features_sql('event_type')}) f")
def change_features_range_cut(spark, sf_dir):
    """The same, cut by sampled ranges: for series that no time slice bounds."""
    return features(spark, sf_dir, BY_TYPE, slicing="range").select(*FEATURE_COLUMNS)


@query(f"SELECT event_id, value, k, value_change, k_change FROM ({FEATURES_SQL}) f")
def measure_changes(spark, sf_dir):
    """Changes of two measures from one shuffle."""
    return features(spark, sf_dir).select("event_id", "value", "k", "value_change", "k_change")


@query(f"""
    SELECT event_id, lag(value, 1) OVER w AS prev_value_1, lag(value, 2) OVER w AS prev_value_2,
           lag(value, 3) OVER w AS prev_value_3, lag(k, 1) OVER w AS prev_k_1
    FROM ({MEASURES_SQL}) m
    WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts, event_id)
""")
def previous_values(spark, sf_dir):
    """Raw predecessors: three of one column, one of another."""
    lagged = with_previous(measures(spark, sf_dir), SERIES, "ts", {"value": 3, "k": 1}, ("event_id",))
    return lagged.select("event_id", "prev_value_1", "prev_value_2", "prev_value_3", "prev_k_1")


@query("""
    SELECT event_id, user_id, event_type, ts, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) <= 5
""")
def lookback_top5(spark, sf_dir):
    """The five newest rows of each series."""
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts", "value")
    return latest_rows(rows, SERIES, "ts", 5, ("event_id",))


@query(f"""
    SELECT round(quantile_cont(abs(value_change), 0.99), 6) AS threshold
    FROM ({FEATURES_SQL}) f WHERE value_change IS NOT NULL
""")
def large_move_threshold(spark, sf_dir):
    """Calibration: exact 99th percentile of the absolute change."""
    moves = features(spark, sf_dir).select(F.abs("value_change").alias("move"))
    threshold = exact_percentile(moves, "move", 0.99)
    return spark.range(1).select(F.round(F.lit(threshold), 6).alias("threshold"))


@query(f"SELECT count(value_change) AS moves, count(value_change) > 0 AS within FROM ({FEATURES_SQL}) f")
def large_move_threshold_approx(spark, sf_dir):
    """Calibration from a sketch, and whether its rank is as near to the wanted one as promised."""
    moves = features(spark, sf_dir).select(F.abs("value_change").alias("move")).where("move is not null")
    threshold, accuracy = approx_percentile(moves, "move", 0.99, 10_000).first()[0], 10_000
    ranks = moves.agg(
        F.count(F.lit(1)).alias("moves"), F.count_if(F.col("move") < threshold).alias("below"),
        F.count_if(F.col("move") <= threshold).alias("upto"),
    )
    room = F.greatest(F.col("moves") * (2 / accuracy), F.lit(1.0))
    within = (F.col("below") <= 0.99 * F.col("moves") + room) & (F.col("upto") >= 0.99 * F.col("moves") - room)
    return ranks.select("moves", within.alias("within"))
