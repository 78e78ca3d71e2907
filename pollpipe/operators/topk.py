"""Bounded results: ranked rows, and a row cap that says whether it cut anything."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint

MAX_ROWS = 10_000


class Capped(NamedTuple):
    rows: DataFrame
    truncated: bool


def top_k(
    df: DataFrame, metric: str | Column, key: Sequence[str], k: int | None = None, cap: int | None = None,
    largest_first: bool = True,
) -> DataFrame:
    """The first ``k`` rows by ``metric``, ties by ``key``; all rows, in that order, without ``k``.

    ``cap`` is a policy's bound on ``k`` and applies only where a caller passes it. The
    order is mandatory and total if ``key`` identifies a row, so the result is the same
    on every run. With a bound each task keeps at most that many rows.
    """
    bounds = [n for n in (k, cap) if n is not None]
    if any(n < 1 for n in bounds):
        raise ValueError("ask for at least one row")
    measure = F.col(metric) if isinstance(metric, str) else metric
    order = measure.desc_nulls_last() if largest_first else measure.asc_nulls_last()
    ordered = df.orderBy(order, *[F.col(k_).asc() for k_ in key])
    return ordered.limit(min(bounds)) if bounds else ordered


def cap_rows(df: DataFrame, max_rows: int = MAX_ROWS) -> Capped:
    """At most ``max_rows`` rows, and whether there were more. Looks one row beyond the cap.

    The input runs once: what it gives up to one row beyond the cap is kept, and both the
    rows and the flag come from that.
    """
    if max_rows < 1:
        raise ValueError("max_rows must be at least 1")
    seen = checkpoint(df.limit(max_rows + 1))
    return Capped(seen.limit(max_rows), seen.count() > max_rows)
