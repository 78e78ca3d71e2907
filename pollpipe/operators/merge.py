"""Idempotent merges of a batch into a target, by key, without a table format.

Both work on date partitions: only the dates that the batch touches are read, and the
upsert rewrites only those. A side's keys are reduced to distinct keys before the join,
so a key that occurs in very many copies costs one row per task.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import astuple, dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written
from ..sources.tables import DATE, FeedTable, from_micros

_RANK = "__rank"
ROW_HASH, COPIES = "row_hash", "copies"


def has_null_key(key: Sequence[str]) -> Column:
    return reduce(Column.__or__, [F.col(k).isNull() for k in key])


def split_null_keys(df: DataFrame, key: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with a complete key, and rows without. The latter never match in a merge and
    would be inserted again on every run, so they belong into quarantine."""
    return df.where(~has_null_key(key)), df.where(has_null_key(key))


def one_per_key(df: DataFrame, key: Sequence[str], prefer: Sequence[str] = ()) -> DataFrame:
    """One row per key: the smallest by ``prefer``, then by all other columns.

    The rank filter is applied before the shuffle too, so copies of a hot key collapse to one
    row per task.
    """
    rest = [c for c in df.columns if c not in key]
    if not rest:
        return df.distinct()
    first = [c for c in prefer if c not in key]
    order = [F.col(c) for c in [*first, *[c for c in rest if c not in first]]]
    ranked = df.withColumn(_RANK, F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
    return ranked.where(F.col(_RANK) == 1).drop(_RANK)


def new_rows(batch: DataFrame, target: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``target``; copies within the batch all stay."""
    return batch.join(target.select(*key).distinct(), list(key), "left_anti").select(*batch.columns)


def insert_only(target: DataFrame, batch: DataFrame, key: Sequence[str]) -> DataFrame:
    """``target`` plus the rows of ``batch`` with unknown keys; existing rows are untouched."""
    return target.unionByName(new_rows(batch, target, key))


def upsert(target: DataFrame, batch: DataFrame, key: Sequence[str]) -> DataFrame:
    """``batch`` plus the rows of ``target`` whose key it does not replace."""
    return new_rows(target, batch, key).unionByName(batch)


def repeated_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


def insert_into(table: FeedTable, batch: DataFrame, key: Sequence[str], keys: DataFrame | None = None) -> None:
    """Append the rows of ``batch`` with unknown keys; create the table if needed. ``keys`` may
    name the rows of the batch in a form that is cheaper to compute."""
    if not table.exists():
        table.append(batch)
        return
    known = table.read(dates=table.dates_in(batch if keys is None else keys))
    table.append(new_rows(batch, known, key))


@dataclass(frozen=True)
class Inserted:
    """What an insert added: ``rows`` with a key, of which ``copies`` repeat a key of the same
    batch, and ``unkeyed`` rows. ``dropped`` copies were left out on request."""

    rows: int = 0
    copies: int = 0
    unkeyed: int = 0
    dropped: int = 0

    def __bool__(self) -> bool:
        return self.rows + self.unkeyed > 0

    def __add__(self, other: Inserted) -> Inserted:
        return Inserted(*(a + b for a, b in zip(astuple(self), astuple(other), strict=True)))


def insert_all(
    table: FeedTable,
    unkeyed: FeedTable,
    batch: DataFrame,
    key: Sequence[str],
    since: dt.datetime | None = None,
    keep_copies: bool = True,
    dates: list[dt.date | None] | None = None,
) -> Inserted:
    """Append the rows of ``batch`` with unknown keys, and those without a complete key to
    ``unkeyed``. No row is lost, and repeating the batch adds nothing.

    ``since`` or ``dates`` bound where in the table the batch's keys can be. The rows to add are found and
    written down once; counts and both appends work on that. Copies of a new key are all
    added, for a key audit to see, or reduced to one per key and counted.
    """
    fresh = batch if not table.exists() else new_rows(batch, table.read(since=since, dates=dates), key)
    fresh = written(fresh, "fresh")
    keyed, without = split_null_keys(fresh, key)
    counts = fresh.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    known = ~has_null_key(key)
    rows, keys, lost = counts.agg(
        F.coalesce(F.sum(F.when(known, F.col("n"))), F.lit(0)), F.count_if(known),
        F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)),
    ).first()
    apart = insert_unkeyed(unkeyed, without) if lost else 0
    if rows:
        table.append(keyed if keep_copies or rows == keys else one_per_key(keyed, key))
    return Inserted(rows, rows - keys, apart) if keep_copies else Inserted(keys, 0, apart, rows - keys)


def insert_unkeyed(table: FeedTable, rows: DataFrame) -> int:
    """Append rows that no key can match, each once: rows that are alike in every column become one
    row with their number (``copies``), found again by a hash of all columns (``row_hash``).
    Returns how many rows were added."""
    names = rows.columns
    content = F.to_json(F.struct(*names), {"ignoreNullFields": "false"})
    one = rows.withColumn(ROW_HASH, F.sha2(content, 256)).groupBy(ROW_HASH).agg(
        F.first(F.struct(*names)).alias("row"), F.count(F.lit(1)).alias(COPIES)
    ).select("row.*", ROW_HASH, COPIES)
    one = written(one, "unkeyed")
    if table.exists():
        one = written(new_rows(one, table.read(dates=table.dates_in(one)), [ROW_HASH]), "unkeyed")
    added = one.count()
    if added:
        table.append(one)
    return added


@dataclass(frozen=True)
class KeyFacts:
    """What one aggregate over keys says: rows, rows beyond the first of a key, dates, earliest time."""

    rows: int
    copies: int
    dates: tuple[dt.date | None, ...]
    first: dt.datetime | None


def key_facts(table: FeedTable, keys: DataFrame, key: Sequence[str]) -> KeyFacts:
    """Facts of a batch's keys in one pass; dates are at most one per calendar day."""
    counted = table.with_date(keys.select(*key)).groupBy(*key, DATE).agg(F.count(F.lit(1)).alias("n"))
    rows, distinct, dates, untimed, first = counted.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1)), F.collect_set(DATE), F.count_if(F.col(DATE).isNull()),
        F.min(F.unix_micros(F.col(table.time).try_cast("timestamp"))),
    ).first()
    return KeyFacts(rows, rows - distinct, (*sorted(dates), *([None] if untimed else [])), from_micros(first))


def upsert_into(
    table: FeedTable, batch: DataFrame, key: Sequence[str], keys: DataFrame | None = None, facts: KeyFacts | None = None
) -> None:
    """Replace matched rows and insert the others; rewrites only the touched dates.

    A batch with two rows for one key is refused: either could win. ``keys`` may name
    the rows of the batch in a form that is cheaper to compute, ``facts`` what is known of
    them already.
    """
    named = batch if keys is None else keys
    facts = facts or key_facts(table, named, key)
    if facts.copies:
        raise ValueError(f"batch has more than one row per key {tuple(key)}")
    if not table.exists():
        table.append(batch)
        return
    kept = table.read(dates=list(facts.dates))
    replaced = kept.join(named.select(*key), list(key), "left_anti").select(*kept.columns)
    table.replace_dates(replaced.unionByName(batch))
