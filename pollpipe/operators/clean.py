"""Bronze text to typed rows with cast issues, derived columns and quality tags."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casting import cast_value
from ..functions.quality import Rule, quality_tags, tags_of
from ..spec import Field
from .explode import KINDS

CAST_ISSUES = "silver_cast_issues"
QUALITY_ISSUES = "silver_quality_issues"


def field_kind(df: DataFrame) -> Callable[[str], Column]:
    """JSON kind per field. Columns without a recorded kind are plain text."""
    kinds = set(df.schema[KINDS].dataType.names) if KINDS in df.columns else set()

    def kind(name: str) -> Column:
        if name in kinds:
            return F.col(KINDS)[name]
        if name in df.columns:
            return F.when(F.col(name).isNotNull(), "string")
        return F.lit(None).cast("string")

    return kind


def field_text(df: DataFrame) -> Callable[[str], Column]:
    """Text per field; an absent column reads as NULL."""
    return lambda name: F.col(name).cast("string") if name in df.columns else F.lit(None).cast("string")


def cast_fields(
    df: DataFrame, fields: Sequence[Field], keep: Mapping[str, Column] | None = None, issues: str = CAST_ISSUES
) -> DataFrame:
    """Typed ``fields``, then the ``issues`` array of failed field names, then ``keep``.

    Rows are never dropped; a failed or absent value is NULL.
    """
    kind, text = field_kind(df), field_text(df)
    # the failures look at finished columns, so that no cast is computed twice
    typed = df.select(
        *[cast_value(text(f.name), f.type, kind(f.name)).alias(f.name) for f in fields],
        F.struct(*[kind(f.name).isNotNull().alias(f.name) for f in fields]).alias("__present"),
        *[column.alias(name) for name, column in (keep or {}).items()],
    )
    failed = [F.when(F.col("__present")[f.name] & F.col(f.name).isNull(), F.lit(f.name)) for f in fields]
    return typed.select(*[f.name for f in fields], tags_of(failed).alias(issues), *(keep or {}))


def clean_records(
    bronze: DataFrame,
    fields: Sequence[Field],
    derived: Mapping[str, Column],
    rules: Sequence[Rule],
) -> DataFrame:
    """Typed rows of the next layer.

    Output: typed fields, cast issues, the two drift lists carried forward, the
    ``derived`` columns (expressions over the typed fields) and the quality tags.
    """
    carried = {}
    for source in ("schema_extra_fields", "schema_missing_fields"):
        present = source in bronze.columns
        carried[f"bronze_{source}"] = F.col(source) if present else F.lit(None).cast("array<string>")
    typed = cast_fields(bronze, fields, carried)
    return typed.select("*", *[c.alias(n) for n, c in derived.items()], quality_tags(rules).alias(QUALITY_ISSUES))


def issue_rows(df: DataFrame, key: Sequence[str], issues: Mapping[str, str]) -> DataFrame:
    """Side table of issues: key columns, ``kind`` and ``tag``, one row per issue.

    ``issues`` maps a kind, for example ``cast``, to the array column that lists its tags.
    """
    def of_kind(kind: str, column: str) -> Column:
        tags = F.coalesce(F.col(column), F.array().cast("array<string>"))
        return F.transform(tags, lambda tag: F.struct(F.lit(kind).alias("kind"), tag.alias("tag")))

    tagged = F.flatten(F.array(*[of_kind(kind, column) for kind, column in issues.items()]))
    return df.select(*key, F.explode(tagged).alias("issue")).select(*key, "issue.kind", "issue.tag")
