"""Exact percentile of a column in two passes, without gathering its values.

Spark's exact ``percentile`` keeps all distinct values in one task. Here a KLL sketch of fixed
size, merged from the tasks' own, brackets the wanted rank first. The second pass counts what lies below the
bracket and keeps the values inside with their counts, about one percent of the rows; the rank
is then found among these. Summaries can be kept per date and merged, which saves the first pass.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from ..session import written

#: Most rows that the driver sees of a histogram.
BINS = 4096
#: Size of a sketch; its ranks are right within ``RANK_ERROR`` of all values with 99 % confidence.
SKETCH_K = 4096
RANK_ERROR = 0.0013

_FACTS = ("counted", "missing", "not_finite")


@dataclass(frozen=True)
class Percentile:
    """The ``value`` (None without any), of how many ``counted`` values, and what was left out."""

    value: float | None
    counted: int
    missing: int
    not_finite: int


def _finite(column: str) -> Column:
    value = F.col(column).cast("double")
    return F.when(F.abs(value) < float("inf"), value)  # NaN is larger than anything


def value_summary(column: str) -> Column:
    """Aggregate: counts, range and sketch of a column, mergeable by :func:`merged_summary`."""
    value = _finite(column)
    known = F.col(column).isNotNull()
    return F.struct(
        F.count(value).alias("counted"), F.count_if(~known).alias("missing"), F.count_if(known & value.isNull()).alias("not_finite"),
        F.min(value).alias("low"), F.max(value).alias("high"), F.kll_sketch_agg_double(value, SKETCH_K).alias("sketch"),
    )


def merged_summary(summary: str) -> Column:
    """Aggregate: the summary of all rows from the summaries of their parts."""
    part = F.col(summary)
    sums = [F.coalesce(F.sum(part[c]), F.lit(0)).alias(c) for c in _FACTS]
    # a part without values has nothing to merge
    sketch = F.kll_merge_agg_double(F.when(part["counted"] > 0, part["sketch"]), SKETCH_K)
    return F.struct(*sums, F.min(part["low"]).alias("low"), F.max(part["high"]).alias("high"), sketch.alias("sketch"))


def percentile(
    df: DataFrame, column: str, fraction: float, summary: DataFrame | None = None, bins: int = BINS, error: float = RANK_ERROR
) -> Percentile:
    """Linear-interpolated percentile of the non-null, finite values of ``df``, and how many were not.

    ``summary`` is a frame of one column and one row with the summary of these very rows; without it one pass
    over ``df`` makes it. The bracket only saves work: if the rank lies outside, it is
    widened, so the result is exact whatever the sketch says.
    """
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must be between 0 and 1")
    if summary is None:
        summary = df.agg(value_summary(column).alias("s"))
    s = F.col(summary.columns[0])
    ends = F.array(*[F.lit(min(max(fraction + side * 3 * error, 0.0), 1.0)) for side in (-1, 1)])
    bracket = F.when(s["counted"] > 0, F.kll_sketch_get_quantile_double(s["sketch"], ends))
    said = summary.select(*[s[c].alias(c) for c in (*_FACTS, "low", "high")], bracket.alias("bracket")).first()
    facts = {c: said[c] for c in _FACTS}
    if not said["counted"]:
        return Percentile(None, **facts)
    position = fraction * (said["counted"] - 1)
    below, share = math.floor(position), position - math.floor(position)
    return Percentile(_at(df, column, below, share, said, bins), **facts)


def exact_percentile(df: DataFrame, column: str, fraction: float, bins: int = BINS) -> float | None:
    """Value of :func:`percentile` alone; None without any value."""
    return percentile(df, column, fraction, bins=bins).value


def _at(df: DataFrame, column: str, rank: int, share: float, said: Row, bins: int) -> float:
    values = df.select(_finite(column).alias("v")).where("v is not null")
    last = rank + (share > 0.0)
    low, high = said["bracket"]
    # the ends of all values are known; the sketch may not have kept them
    if rank == 0:
        low = said["low"]
    if last == said["counted"] - 1:
        high = said["high"]
    while True:
        # one pass: all values below the bracket are one group, each value inside it another
        upto = values.where(F.col("v") <= F.lit(high))
        inside = written(upto.groupBy(F.when(F.col("v") >= F.lit(low), F.col("v")).alias("v")).agg(F.count(F.lit(1)).alias("n")), "bracket")
        under, within, distinct, least, most = inside.agg(
            F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)),
            F.coalesce(F.sum(F.when(F.col("v").isNotNull(), F.col("n"))), F.lit(0)),
            F.count("v"), F.min("v"), F.max("v"),
        ).first()
        if rank >= under and last < under + within:
            break
        low = low if rank >= under else float("-inf")
        high = high if last < under + within else float("inf")
    inside = inside.where("v is not null")
    if distinct <= bins:
        listed = [(r["v"], r["n"]) for r in inside.orderBy("v").collect()]
        first = _nth(listed, rank - under)
        return first if share == 0.0 else first + (_nth(listed, last - under) - first) * share
    first = _value_at(inside, rank - under, least, most, bins)
    if share == 0.0:
        return first
    return first + (_value_at(inside, last - under, least, most, bins) - first) * share


def _value_at(values: DataFrame, rank: int, low: float, high: float, bins: int) -> float:
    """The value with ``rank`` smaller or equal values before it, all within [low, high]."""
    while low < high:
        width = high / bins - low / bins
        within = values.where((F.col("v") >= F.lit(low)) & (F.col("v") <= F.lit(high)))
        if width == 0.0 or low + width == low:
            # neighbouring doubles: only a handful of distinct values are left
            return _nth([(r["v"], r["n"]) for r in within.orderBy("v").collect()], rank)
        bin_of = F.least(F.floor(F.col("v") / F.lit(width) - F.lit(low / width)), F.lit(bins - 1))
        counted = (
            within.groupBy(bin_of.alias("bin"))
            .agg(F.sum("n").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
            .orderBy("bin")
            .collect()
        )
        for row in counted:
            if rank < row["n"]:
                low, high = row["lo"], row["hi"]
                break
            rank -= row["n"]
    return low


def _nth(counted: list[tuple[float, int]], rank: int) -> float:
    for value, n in counted:
        if rank < n:
            return value
        rank -= n
    raise AssertionError("rank outside the counted range")


def approx_percentile(df: DataFrame, column: str, fraction: float, accuracy: int = 10_000) -> DataFrame:
    """One-row sketch estimate in a single pass."""
    return df.agg(F.percentile_approx(column, fraction, accuracy).alias("threshold"))
