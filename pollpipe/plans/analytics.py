"""Questions over a feature table, as queries with a total order; ``k`` keeps the first rows only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.changes import safe_corr
from ..functions.derive import within_days
from ..operators.lags import latest_rows
from ..operators.topk import top_k

DEFAULT_DAYS = 30


def recent(df: DataFrame, time: str, days: int = DEFAULT_DAYS, as_of: Column | None = None) -> DataFrame:
    """Rows of the last ``days`` days. ``as_of`` replaces the clock."""
    return df.where(within_days(F.col(time), days, as_of))


def average_by(
    df: DataFrame, group: Sequence[str], measure: str, time: str, days: int = DEFAULT_DAYS,
    as_of: Column | None = None, k: int | None = None, name: str = "average_rate",
) -> DataFrame:
    """Average of a measure per group over the window, largest first."""
    means = recent(df, time, days, as_of).groupBy(*group).agg(F.avg(measure).alias(name))
    return top_k(means, name, group, k)


def latest_values(
    df: DataFrame, entity: Sequence[str], time: str, measures: Sequence[str], tiebreak: Sequence[str] = (),
    k: int | None = None, newest_first: bool = False,
) -> DataFrame:
    """Newest row per series, over all of the table; newest series first if asked for or with ``k``."""
    newest = latest_rows(df.select(*entity, time, *measures, *tiebreak), entity, time, 1, tiebreak)
    rows = newest.select(*entity, *measures, time)
    return top_k(rows, time, entity, k) if newest_first or k is not None else rows


def largest_moves(
    df: DataFrame, group: Sequence[str], change: str, time: str, days: int = DEFAULT_DAYS,
    as_of: Column | None = None, k: int | None = None, name: str = "largest_move",
) -> DataFrame:
    """Largest absolute change per group over the window, largest first."""
    moves = recent(df, time, days, as_of).groupBy(*group).agg(F.max(F.abs(change)).alias(name))
    return top_k(moves, name, group, k)


def large_move_counts(
    df: DataFrame, entity: Sequence[str], time: str, days: int = DEFAULT_DAYS, as_of: Column | None = None,
    k: int | None = None,
) -> DataFrame:
    """Large moves per series over the window and when the last one was, most first."""
    moves = recent(df, time, days, as_of).where(F.col("is_large_move")).groupBy(*entity).agg(
        F.count(F.lit(1)).alias("large_move_count"), F.max(time).alias("last_large_move_at")
    )
    return top_k(moves, "large_move_count", entity, k)


def frozen_series(
    df: DataFrame, entity: Sequence[str], time: str, days: int = DEFAULT_DAYS, as_of: Column | None = None,
    k: int | None = None,
) -> DataFrame:
    """Series that were frozen at some time in the window, most recent first."""
    seen = recent(df, time, days, as_of).where(F.col("is_frozen")).groupBy(*entity).agg(
        F.max(time).alias("last_seen_at")
    )
    return top_k(seen, "last_seen_at", entity, k)


def currently_frozen(
    df: DataFrame, entity: Sequence[str], time: str, measures: Sequence[str] = (), tiebreak: Sequence[str] = ()
) -> DataFrame:
    """Series whose newest row is frozen; no time window."""
    newest = latest_rows(df.select(*entity, time, "is_frozen", *measures, *tiebreak), entity, time, 1, tiebreak)
    return newest.where(F.col("is_frozen")).select(*entity, *measures, time)


def change_correlation(
    df: DataFrame, entity: Sequence[str], a: str, b: str, time: str | None = None, days: int | None = None,
    as_of: Column | None = None,
) -> DataFrame:
    """Correlation of two changes per series, with the number of pairs; NULL if one is constant."""
    rows = df if days is None else recent(df, time, days, as_of)
    pairs = F.count_if(F.col(a).isNotNull() & F.col(b).isNotNull())
    return rows.groupBy(*entity).agg(safe_corr(F.col(a), F.col(b)).alias("correlation"), pairs.alias("pairs"))


def rows_by(df: DataFrame, group: Sequence[str], k: int | None = None, name: str = "n") -> DataFrame:
    """Row count per group, largest first."""
    return top_k(df.groupBy(*group).agg(F.count(F.lit(1)).alias(name)), name, group, k)


def groups_above(df: DataFrame, group: Sequence[str], measure: str, limit: float, name: str = "m") -> DataFrame:
    """Groups whose largest value exceeds ``limit``."""
    return df.groupBy(*group).agg(F.max(measure).alias(name)).where(F.col(name) > limit)


def rows_of_members(df: DataFrame, member: Sequence[str], selected: DataFrame) -> DataFrame:
    """Rows whose ``member`` columns occur in ``selected``, each row once."""
    return df.join(selected.select(*member).distinct(), list(member), "left_semi")
