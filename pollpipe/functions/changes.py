"""Change features between a row and its predecessors in the same series."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def change(current: Column, previous: Column) -> Column:
    """Signed difference; NULL if either value is missing."""
    return current - previous


def is_large_move(delta: Column, threshold: float) -> Column:
    """Whether the absolute change reaches the threshold (inclusive); NULL in, NULL out."""
    return F.abs(delta) >= F.lit(threshold)


def is_frozen(current: Column, previous: Sequence[Column]) -> Column:
    """Whether the value equals every given predecessor.

    NULL as soon as one of the values is missing. A plain conjunction would say
    false there if another predecessor differs, hence the guard.
    """
    if not previous:
        raise ValueError("is_frozen needs at least one predecessor")
    known = reduce(Column.__and__, [p.isNotNull() for p in previous], current.isNotNull())
    equal = reduce(Column.__and__, [p == current for p in previous])
    return F.when(known, equal)


def safe_corr(a: Column, b: Column) -> Column:
    """Pearson correlation as an aggregate; NULL where a side does not vary.

    ``corr`` raises a division by zero on such groups in ANSI mode. All three parts
    use only the rows where both values are known.
    """
    both = a.isNotNull() & b.isNotNull()
    x, y = F.when(both, a), F.when(both, b)
    spread = F.stddev_pop(x) * F.stddev_pop(y)
    return F.covar_pop(x, y) / F.nullif(spread, F.lit(0.0))
