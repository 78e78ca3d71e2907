"""The gates that run after each layer.

Counts of conditions are one scan without a shuffle. Exact key uniqueness has to shuffle
the keys, so it is kept apart: combined, every key would drag all other counts along.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.derive import as_time, minutes_between
from ..functions.quality import has_issues
from ..operators.audit import (
    GateResult,
    derived_metrics,
    key_counts,
    latest_poll,
    layer_lag,
    row_counts,
    run_gate,
    side_by_side,
)
from ..operators.clean import CAST_ISSUES, QUALITY_ISSUES
from ..operators.explode import accepted, drift_counts
from ..operators.merge import has_null_key
from ..sources.tables import to_micros


def _unique(values) -> str | None:
    if values["rows"] != values["unique_keys"]:
        return f"duplicate keys: {values['rows']} rows, {values['unique_keys']} unique keys"
    return None


def _lag(upstream: str, downstream: str, limit: float):
    def check(values) -> str | None:
        if values[f"{upstream}_latest"] is None or values[f"{downstream}_latest"] is None:
            return f"{upstream} or {downstream} has no data, the lag is unknown"
        if values["lag_minutes"] > limit:
            return f"{downstream} lags {upstream} by {values['lag_minutes']} min (limit {limit})"
        return None

    return check


def gate_rows(
    bronze: DataFrame, time: str, domain: tuple[str, str] | None = None, since: dt.datetime | None = None
) -> DataFrame:
    """The bronze rows that a gate judges: accepted ones of the domain, their time as an instant
    (NULL where it is unreadable), not before ``since``."""
    rows = accepted(bronze) if "reject_reason" in bronze.columns else bronze
    if domain is not None:
        rows = rows.where(F.col(domain[0]) == F.lit(domain[1]))
    rows = rows.withColumn(time, as_time(F.col(time)))
    return rows if since is None else rows.where(F.col(time) >= F.timestamp_micros(F.lit(to_micros(since))))


def bronze_metrics(
    bronze: DataFrame,
    key: Sequence[str],
    time: str,
    as_of: Column | None = None,
    domain: tuple[str, str] | None = None,
    since: dt.datetime | None = None,
) -> DataFrame:
    """One row: rows, unique keys, rows without a key, drift counts, newest poll, its size and age.

    Takes the table as it was loaded. Rejected polls and records have no key and are no poll
    results, so they are not looked at; rows whose key is incomplete are counted apart.
    """
    rows = gate_rows(bronze, time, domain, since)
    unkeyed = has_null_key(key)
    keys = key_counts(rows.where(~unkeyed), key)
    without = rows.agg(F.count_if(unkeyed).alias("unkeyed_rows"))
    now = F.current_timestamp() if as_of is None else as_of
    age = minutes_between(now, F.col("latest_fetched_at"))
    return side_by_side(keys, without, drift_counts(rows), latest_poll(rows, time)).withColumn("age_minutes", age)


def bronze_gate(
    bronze: DataFrame,
    key: Sequence[str],
    time: str,
    min_rows_per_poll: int,
    max_age_minutes: float,
    as_of: Column | None = None,
    strict: bool = False,
    domain: tuple[str, str] | None = None,
    since: dt.datetime | None = None,
) -> GateResult:
    """Unique keys, a recent and complete newest poll. Drift and rows without a key are reported,
    never a breach; a feed of which only rejected polls arrive grows stale. ``since`` keeps
    the gate from reading all history."""

    def fresh(values) -> str | None:
        if values["latest_fetched_at"] is None:
            return "no rows"
        if values["age_minutes"] > max_age_minutes:
            return f"stale: newest poll is {values['age_minutes']} min old (limit {max_age_minutes})"
        return None

    def complete(values) -> str | None:
        n = values["latest_poll_contract_count"]
        if values["latest_fetched_at"] is not None and n < min_rows_per_poll:
            return f"newest poll has {n} rows (expected at least {min_rows_per_poll})"
        return None

    return run_gate(bronze_metrics(bronze, key, time, as_of, domain, since), [_unique, fresh, complete], strict)


def silver_metrics(silver: DataFrame, key: Sequence[str], eligible: Column, derived: Sequence[str]) -> DataFrame:
    """One row: rows, unique keys, rows with issues, and gaps in derived columns."""
    counts = silver.agg(
        F.count_if(has_issues(F.col(CAST_ISSUES))).alias("cast_issue_rows"),
        F.count_if(has_issues(F.col(QUALITY_ISSUES))).alias("quality_issue_rows"),
        *derived_metrics(eligible, derived),
    )
    return side_by_side(key_counts(silver, key), counts)


def silver_gate(
    bronze: DataFrame,
    silver: DataFrame,
    key: Sequence[str],
    time: str,
    eligible: Column,
    derived: Sequence[str],
    max_lag_minutes: float,
    strict: bool = False,
    domain: tuple[str, str] | None = None,
    since: dt.datetime | None = None,
) -> GateResult:
    """Unique keys, silver close behind bronze, derived columns filled where computable."""
    bronze = gate_rows(bronze, time, domain, since)
    silver = silver if since is None else gate_rows(silver, time, None, since)

    def filled(values) -> str | None:
        gaps = {c: values[f"null_{c}"] for c in derived if values[f"null_{c}"]}
        return f"derived columns are NULL on eligible rows: {gaps}" if gaps else None

    metrics = side_by_side(
        silver_metrics(silver, key, eligible, derived), layer_lag(bronze, silver, time, ("bronze", "silver"))
    )
    return run_gate(metrics, [_unique, _lag("bronze", "silver", max_lag_minutes), filled], strict)


def gold_metrics(gold: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: rows, unique keys, and rows per flag."""
    flags = gold.agg(
        F.count_if(F.col("is_large_move")).alias("large_move_rows"),
        F.count_if(F.col("is_frozen")).alias("frozen_rows"),
    )
    return side_by_side(key_counts(gold, key), flags)


def gold_gate(
    silver: DataFrame, gold: DataFrame, key: Sequence[str], time: str, max_lag_minutes: float, strict: bool = False,
    since: dt.datetime | None = None,
) -> GateResult:
    """Unique keys, gold close behind silver. Flags are reported, never a breach."""
    if since is not None:
        silver, gold = (gate_rows(layer, time, None, since) for layer in (silver, gold))
    metrics = side_by_side(gold_metrics(gold, key), layer_lag(silver, gold, time, ("silver", "gold")))
    return run_gate(metrics, [_unique, _lag("silver", "gold", max_lag_minutes)], strict)


def reconciliation_gate(
    bronze: DataFrame, silver: DataFrame, gold: DataFrame, strict: bool = False
) -> GateResult:
    """Equal row counts in the three layers; ``bronze`` already reduced to the domain."""

    def equal(a: str, b: str):
        def check(values) -> str | None:
            if values[f"{a}_count"] != values[f"{b}_count"]:
                return (
                    f"row counts differ: {a} {values[f'{a}_count']}, {b} {values[f'{b}_count']}, "
                    f"difference {values[f'{a}_minus_{b}']}"
                )
            return None

        return check

    metrics = row_counts({"bronze": bronze, "silver": silver, "gold": gold})
    return run_gate(metrics, [equal("bronze", "silver"), equal("silver", "gold")], strict)
