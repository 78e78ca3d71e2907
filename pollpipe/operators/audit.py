"""Audits: one-row metric frames, and the thresholds that turn them into breaches."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.derive import as_time, minutes_between


class GateError(ValueError):
    """A gate found breaches and was asked to raise."""


@dataclass(frozen=True)
class GateResult:
    """Metrics of a gate as a one-row frame, the same row as a dict, and what is wrong."""

    metrics: DataFrame
    values: Mapping[str, object]
    breaches: tuple[str, ...]

    @property
    def ok(self) -> bool:
        return not self.breaches


def run_gate(
    metrics: DataFrame, checks: Sequence[Callable[[Mapping[str, object]], str | None]], strict: bool = False
) -> GateResult:
    """Evaluate ``checks`` on a one-row frame. Each returns a message or None."""
    values = metrics.first().asDict()
    breaches = tuple(message for check in checks if (message := check(values)))
    if strict and breaches:
        raise GateError("; ".join(breaches))
    return GateResult(metrics, values, breaches)


def key_metrics(key: Sequence[str]) -> list[Column]:
    """``rows`` and ``unique_keys``, exact, for one aggregate pass.

    Keys with a NULL part are not counted as keys, hence show up as a difference.
    """
    return [F.count(F.lit(1)).alias("rows"), F.count_distinct(*[F.col(k) for k in key]).alias("unique_keys")]


def key_counts(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """The row of :func:`key_metrics`, from rows counted by key first.

    Spark merges scalar subqueries that aggregate the same rows. A distinct count merged with other
    aggregates keeps a buffer of all of them for every key, of a sketch many kilobytes; an aggregate
    over an aggregate is not merged.
    """
    counted = df.groupBy(*key).agg(F.count(F.lit(1)).alias("__rows"))
    return counted.agg(
        F.coalesce(F.sum("__rows"), F.lit(0)).alias("rows"), F.count_if(~_any_null(key)).alias("unique_keys")
    )


def approx_key_metrics(key: Sequence[str], rsd: float = 0.01) -> list[Column]:
    """As :func:`key_metrics` with a sketch: no shuffle of keys, relative error ``rsd``."""
    known = F.when(~_any_null(key), F.xxhash64(*key))
    return [F.count(F.lit(1)).alias("rows"), F.approx_count_distinct(known, rsd).alias("unique_keys")]


def _any_null(key: Sequence[str]) -> Column:
    some = F.lit(False)
    for k in key:
        some = some | F.col(k).isNull()
    return some


def latest_poll(df: DataFrame, time: str) -> DataFrame:
    """One row: newest time and its row count. Two aggregates over one column, without a shuffle
    of its values; the newest time is a scalar subquery of the second."""
    newest = df.agg(F.max(time)).scalar()
    return df.agg(
        F.max(time).alias("latest_fetched_at"), F.count_if(F.col(time) == newest).alias("latest_poll_contract_count")
    )


def rows_at_latest(df: DataFrame, time: str) -> DataFrame:
    """Rows of the newest poll. The newest time is a scalar subquery of the scan filter."""
    return df.where(F.col(time) == df.agg(F.max(time)).scalar())


def layer_lag(upstream: DataFrame, downstream: DataFrame, time: str, names: tuple[str, str]) -> DataFrame:
    """One row: newest time on both sides and how far downstream lags, in minutes.

    Newest as an instant: text that is no time does not count, and offsets are respected.
    """
    up = upstream.agg(F.max(as_time(F.col(time))).alias(f"{names[0]}_latest"))
    down = downstream.agg(F.max(as_time(F.col(time))).alias(f"{names[1]}_latest"))
    lag = minutes_between(F.col(f"{names[0]}_latest"), F.col(f"{names[1]}_latest"))
    return side_by_side(up, down).withColumn("lag_minutes", lag)


def side_by_side(*one_row: DataFrame) -> DataFrame:
    """Columns of several one-row frames as one row; each is a scalar subquery, so a frame of more
    rows is an error and not a product."""
    spark = one_row[0].sparkSession
    columns = [
        frame.select(F.struct(*frame.columns)).scalar().getField(name).alias(name) for frame in one_row for name in frame.columns
    ]
    return spark.range(1).select(*columns)


def derived_metrics(eligible: Column, derived: Sequence[str]) -> list[Column]:
    """Eligible rows, and per derived column the eligible rows where it is still NULL."""
    return [
        F.count_if(eligible).alias("eligible_rows"),
        *[F.count_if(eligible & F.col(c).isNull()).alias(f"null_{c}") for c in derived],
    ]


def row_counts(layers: Mapping[str, DataFrame]) -> DataFrame:
    """One row: the row count of each layer and the difference to the next one."""
    counts = [df.agg(F.count(F.lit(1)).alias(f"{name}_count")) for name, df in layers.items()]
    names = list(layers)
    differences = {
        f"{a}_minus_{b}": F.col(f"{a}_count") - F.col(f"{b}_count") for a, b in zip(names, names[1:])
    }
    return side_by_side(*counts).withColumns(differences)


def lost_keys(upstream: DataFrame, downstream: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys present upstream and absent downstream, each once."""
    return upstream.select(*key).distinct().join(downstream.select(*key).distinct(), list(key), "left_anti")
