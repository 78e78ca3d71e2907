"""Compare two result sets by key and by numeric value with a tolerance.

Columns may carry different names on the two sides: a golden number matches if any
number of the actual row is close to it. Both sides are stacked and grouped by key, so
there is one shuffle, NULL keys match each other, and a key with very many copies is
combined before the shuffle and never multiplies out.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

REL_TOL, ABS_TOL = 1e-3, 1e-12
NO_ROWS, REPEATED = "the actual side is empty", "the actual side has several rows for one key"


@dataclass(frozen=True)
class Case:
    """One comparison: two results, the columns that identify a row, and the strictness."""

    case_id: str
    golden: DataFrame
    actual: DataFrame
    key: tuple[str, ...]
    check_values: bool = False
    rel_tol: float = REL_TOL
    allow_missing: bool = False


def numeric_columns(df: DataFrame, key: Sequence[str]) -> list[str]:
    """Numbers outside the key. Booleans are not numbers."""
    return [f.name for f in df.schema.fields if f.name not in key and isinstance(f.dataType, T.NumericType)]


def is_close(a: Column, b: Column, rel_tol: float = REL_TOL, abs_tol: float = ABS_TOL) -> Column:
    # equal infinities are close; an infinity is close to nothing else
    bound = F.greatest(rel_tol * F.greatest(F.abs(a), F.abs(b)), F.lit(abs_tol))
    infinite = F.greatest(F.abs(a), F.abs(b)) == float("inf")
    return (a == b) | (~infinite & (F.abs(a - b) <= bound))


def key_differences(
    golden: DataFrame, actual: DataFrame, key: Sequence[str], check_values: bool = True, rel_tol: float = REL_TOL
) -> DataFrame:
    """One row per key of either side: copies on each side and the first golden column
    without a close number in the actual row (``mismatch``, NULL if all match).

    Of repeated keys the largest value per column is compared.
    """
    g_cols, a_cols = numeric_columns(golden, key), numeric_columns(actual, key)

    def side(df: DataFrame, mine: list[str], prefix: str, n_g: int, n_a: int) -> DataFrame:
        def number(c: str) -> Column:
            value = F.col(c).cast("double")
            return F.when(~F.isnan(value), value)

        def slot(p: str, i: int, cols: list[str]) -> Column:
            value = number(cols[i]) if p == prefix else F.lit(None).cast("double")
            return value.alias(f"{p}{i}")

        return df.select(
            *key,
            F.lit(n_g).cast("bigint").alias("golden_rows"),
            F.lit(n_a).cast("bigint").alias("actual_rows"),
            *[slot("g", i, g_cols) for i in range(len(g_cols))],
            *[slot("a", i, a_cols) for i in range(len(a_cols))],
        )

    stacked = side(golden, g_cols, "g", 1, 0).unionByName(side(actual, a_cols, "a", 0, 1))
    slots = [f"g{i}" for i in range(len(g_cols))] + [f"a{i}" for i in range(len(a_cols))]
    matched = stacked.groupBy(*key).agg(
        F.sum("golden_rows").alias("golden_rows"),
        F.sum("actual_rows").alias("actual_rows"),
        *[F.max(s).alias(s) for s in slots],
    )
    unmatched = F.lit(None).cast("string")
    if check_values:
        numbers = F.array(*[F.col(f"a{i}") for i in range(len(a_cols))]).cast("array<double>")

        def has_close(value: Column) -> Column:
            near = F.exists(numbers, lambda n: F.coalesce(is_close(value, n, rel_tol), F.lit(False)))
            return F.coalesce(near, F.lit(False))

        wrong = [
            F.when(F.col(f"g{i}").isNotNull() & ~has_close(F.col(f"g{i}")), F.lit(name))
            for i, name in enumerate(g_cols)
        ]
        both = (F.col("golden_rows") > 0) & (F.col("actual_rows") > 0)
        if wrong:
            unmatched = F.when(both, F.coalesce(*wrong))
    return matched.select(*key, "golden_rows", "actual_rows", unmatched.alias("mismatch"))


def compare_results(
    golden: DataFrame,
    actual: DataFrame,
    key: Sequence[str],
    check_values: bool = False,
    rel_tol: float = REL_TOL,
    allow_missing: bool = False,
) -> DataFrame:
    """One verdict row: ``passed``, the ``reason`` (``ok`` or the first failed check),
    ``repeated_golden``, the number of golden keys with several rows, and ``missing``, the
    number of golden keys that are not in actual (NULL if a side lacks key columns).

    Checks in order: the actual side has rows; both sides have the key columns; no
    repeated keys in actual; no unknown keys; no missing keys, unless the caller knows that
    the actual side was cut and says so with ``allow_missing``; close values if asked for.
    """
    spark = actual.sparkSession
    for name, df in (("golden", golden), ("actual", actual)):
        absent = [k for k in key if k not in df.columns]
        if absent:
            # an empty result fails for being empty first
            reason = F.when(F.lit(actual.isEmpty()), NO_ROWS).otherwise(
                f"the {name} side lacks the key columns {', '.join(absent)}"
            )
            return spark.range(1).select(
                F.lit(False).alias("passed"), reason.alias("reason"), F.lit(0).cast("bigint").alias("repeated_golden"),
                F.lit(None).cast("bigint").alias("missing"),
            )
    diff = key_differences(golden, actual, key, check_values, rel_tol)
    label = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in key])
    unknown = (F.col("actual_rows") > 0) & (F.col("golden_rows") == 0)
    missing = (F.col("actual_rows") == 0) & (F.col("golden_rows") > 0)
    wrong = F.col("mismatch").isNotNull()

    def smallest(condition: Column) -> Column:
        # bounded state: a running minimum, not a list of keys
        return F.min(F.when(condition, label))

    totals = diff.agg(
        F.coalesce(F.sum("actual_rows"), F.lit(0)).alias("actual_rows"),
        F.count_if(F.col("actual_rows") > 1).alias("repeated_actual"),
        F.count_if(F.col("golden_rows") > 1).alias("repeated_golden"),
        F.count_if(unknown).alias("unknown"),
        F.count_if(missing).alias("missing"),
        F.count_if(wrong).alias("wrong"),
        smallest(unknown).alias("unknown_key"),
        smallest(missing).alias("missing_key"),
        F.min(F.when(wrong, F.struct(label.alias("key"), F.col("mismatch").alias("column")))).alias("wrong_at"),
    )
    reason = (
        F.when(F.col("actual_rows") == 0, NO_ROWS)
        .when(F.col("repeated_actual") > 0, REPEATED)
        .when(
            F.col("unknown") > 0,
            F.concat(F.col("unknown").cast("string"), F.lit(" keys are unknown to golden, the smallest is "), F.col("unknown_key")),
        )
        .when(
            (F.col("missing") > 0) & ~F.lit(allow_missing),
            F.concat(F.col("missing").cast("string"), F.lit(" golden keys were not found, the smallest is "), F.col("missing_key")),
        )
        .when(
            F.col("wrong") > 0,
            F.concat(F.lit("no number near golden "), F.col("wrong_at.column"), F.lit(" at key "), F.col("wrong_at.key")),
        )
        .otherwise("ok")
    )
    return totals.select((reason == "ok").alias("passed"), reason.alias("reason"), "repeated_golden", "missing")


def scorecard(cases: Sequence[Case]) -> DataFrame:
    """One verdict row per case."""
    rows = None
    for case in cases:
        verdict = compare_results(
            case.golden, case.actual, case.key, case.check_values, case.rel_tol, case.allow_missing
        ).select(F.lit(case.case_id).alias("case_id"), "passed", "reason", "repeated_golden", "missing")
        rows = verdict if rows is None else rows.unionByName(verdict)
    if rows is None:
        raise ValueError("no cases to compare")
    return rows


def score_summary(cards: DataFrame) -> DataFrame:
    """Passed and total cases as one row."""
    return cards.agg(F.count_if("passed").alias("passed"), F.count(F.lit(1)).alias("total"))


def write_report(cards: DataFrame, path: str) -> None:
    """The scorecard as JSON: ``cases`` with one line per case and ``summary``."""
    cards.write.mode("overwrite").json(f"{path}/cases")
    score_summary(cards).write.mode("overwrite").json(f"{path}/summary")
