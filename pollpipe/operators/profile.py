"""Column profile: how often each field is null or cannot be cast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.casting import cast_failed
from ..session import checkpoint
from ..spec import Field
from .clean import field_kind, field_text

EXAMPLES = 3


def profile_fields(df: DataFrame, fields: Sequence[Field], examples: int = EXAMPLES) -> DataFrame:
    """One row per field: ``null_count``, ``unexpected_null_count`` (only for fields that
    must not be null), ``cast_failure_count`` and the smallest failing texts.

    One scan judges every value once. Only cells that are null or fail are unpivoted, and they
    are counted per field and text before the shuffle; the rest works on those counts.
    """
    counted = checkpoint(problem_cells(df, fields))
    null = F.col("value").isNull()
    totals = counted.groupBy("position").agg(
        F.sum(F.when(null, F.col("n"))).alias("null_count"), F.sum(F.when(~null, F.col("n"))).alias("cast_failure_count")
    )
    smallest = Window.partitionBy("position").orderBy("value")
    first = counted.where(~null).withColumn("rank", F.row_number().over(smallest)).where(F.col("rank") <= examples)
    repeated = F.array_repeat("value", F.least("n", F.lit(examples)).cast("int"))
    shown = first.groupBy("position").agg(
        F.slice(F.array_sort(F.flatten(F.collect_list(repeated))), 1, examples).alias("cast_failure_examples")
    )
    names = df.sparkSession.createDataFrame(
        [(i, f.name, f.nullable) for i, f in enumerate(fields)], "position int, field string, nullable boolean"
    )
    zero = F.lit(0).cast("bigint")
    # both sides have one row per field at most
    report = names.join(F.broadcast(totals), "position", "left").join(F.broadcast(shown), "position", "left")
    return report.orderBy("position").select(
        "field",
        F.coalesce("null_count", zero).alias("null_count"),
        F.when(F.col("nullable"), zero).otherwise(F.coalesce("null_count", zero)).alias("unexpected_null_count"),
        F.coalesce("cast_failure_count", zero).alias("cast_failure_count"),
        F.coalesce("cast_failure_examples", F.array().cast("array<string>")).alias("cast_failure_examples"),
    )


def problem_cells(df: DataFrame, fields: Sequence[Field]) -> DataFrame:
    """``position`` of the field, ``value`` and their number ``n`` for all cells that are null (a
    NULL value) or cannot be cast (their text)."""
    kind, text = field_kind(df), field_text(df)

    def cell(i: int, value: Column) -> Column:
        return F.struct(F.lit(i).alias("position"), value.cast("string").alias("value"))

    cells = F.array(*[
        F.when(kind(f.name).isNull(), cell(i, F.lit(None)))
        .when(cast_failed(text(f.name), f.type, kind(f.name)), cell(i, text(f.name)))
        for i, f in enumerate(fields)
    ])
    # The cells are a column of their own: inside a generator, or under a function with a lambda, every
    # cast would be interpreted. The outer form keeps Spark from adding a filter that judges them again.
    found = df.select(cells.alias("cells")).select(F.inline_outer("cells")).where(F.col("position").isNotNull())
    return found.groupBy("position", "value").agg(F.count(F.lit(1)).alias("n"))


def problem_fields(report: DataFrame) -> DataFrame:
    """Only fields with unexpected nulls or cast failures."""
    return report.where((F.col("unexpected_null_count") > 0) | (F.col("cast_failure_count") > 0))
