"""Row quality rules. A broken rule adds a tag; no row is dropped."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Rule(NamedTuple):
    """``tag`` is added where ``broken`` is true. A NULL operand leaves the rule out."""

    tag: str
    broken: Column


def tags_of(candidates: Sequence[Column]) -> Column:
    """The candidates that are not NULL, as an array in the given order.

    Each tag may occur once. Unlike ``array_compact`` this stays in generated code.
    """
    nothing = F.lit(None).cast("string")
    return F.array_except(F.array(*candidates, nothing), F.array(nothing))


def quality_tags(rules: Sequence[Rule]) -> Column:
    """Tags of all broken rules, in rule order; an empty array if there are none."""
    return tags_of([F.when(r.broken, F.lit(r.tag)) for r in rules])


def has_issues(tags: Column) -> Column:
    return F.coalesce(F.size(tags) > 0, F.lit(False))
