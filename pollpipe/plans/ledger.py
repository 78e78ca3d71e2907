"""Uniqueness of keys by date, counted again only where a date's files have changed.

A key holds its poll time, so copies of a key share a date and dates can be counted apart. The
ledger keeps rows and distinct keys per date together with a signature of the files they were
counted on. A gate after a load then shuffles the keys of the dates that the load touched.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.audit import GateResult, run_gate
from ..operators.digests import differing_keys
from ..operators.merge import has_null_key
from ..sources.tables import DATE, FeedTable

_SCHEMA = "day date, signature string, rows long, unique_keys long, unkeyed_rows long, refresh long"


@dataclass(frozen=True)
class KeyLedger:
    """Counts per date of ``table``, in ``folder``; one small file per refresh."""

    table: FeedTable
    folder: str
    key: tuple[str, ...]

    def __post_init__(self):
        if self.table.time not in self.key:
            raise ValueError("copies of a key must share a date: the key needs the table's time")

    def _entries(self) -> DataFrame | None:
        try:
            stored = self.table.spark.read.schema(_SCHEMA).parquet(self.folder)
            return stored if stored.inputFiles() else None
        except AnalysisException as problem:
            if problem.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def counts(self) -> DataFrame:
        """``day``, ``signature``, ``rows``, ``unique_keys``, ``unkeyed_rows`` as counted last, of dates that still exist."""
        entries = self._entries()
        if entries is None:
            return self.table.spark.createDataFrame([], _SCHEMA.rsplit(",", 1)[0])
        last = entries.groupBy("day").agg(F.max_by(F.struct("signature", "rows", "unique_keys", "unkeyed_rows"), "refresh").alias("e"))
        there = self.table.signatures().select(F.col("day").alias("here"))
        return last.join(there, F.col("day").eqNullSafe(F.col("here")), "left_semi").select("day", "e.*")

    def refresh(self) -> list[dt.date | None]:
        """Count the dates whose files have changed since they were counted; returns those dates."""
        if not self.table.exists():
            return []
        now, known = self.table.signatures(), self.counts().select(F.col("day").alias("d"), F.col("signature").alias("s"))
        same = F.col("day").eqNullSafe(F.col("d")) & (F.col("signature") == F.col("s"))
        changed = now.join(known, same, "left_anti").collect()  # at most one row per calendar day
        if not changed:
            return []
        days = [r["day"] for r in changed]
        rows = self.table.with_date(self.table.read(dates=days))
        per_key = rows.groupBy(F.col(DATE).alias("day"), *self.key).agg(F.count(F.lit(1)).alias("n"))
        unkeyed = has_null_key(self.key)
        counted = per_key.groupBy("day").agg(
            F.sum("n").alias("rows"), F.count_if(~unkeyed).alias("unique_keys"),
            F.coalesce(F.sum(F.when(unkeyed, F.col("n"))), F.lit(0)).alias("unkeyed_rows"),
        )
        signed = self.table.spark.createDataFrame([(r["day"], r["signature"]) for r in changed], "here date, signature string")
        entries = self._entries()
        number = 1 if entries is None else entries.agg(F.max("refresh")).first()[0] + 1
        named = counted.join(F.broadcast(signed), F.col("day").eqNullSafe(F.col("here")))
        named = named.select("day", "signature", "rows", "unique_keys", "unkeyed_rows", F.lit(number).cast("long").alias("refresh"))
        named.coalesce(1).write.mode("append").parquet(self.folder)  # one file: visible whole or not
        return days

    def metrics(self) -> DataFrame:
        """One row: ``rows``, ``unique_keys`` and ``unkeyed_rows`` of the whole table, from the ledger alone."""
        zero = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
        return self.counts().agg(zero("rows"), zero("unique_keys"), zero("unkeyed_rows"))

    def gate(self, strict: bool = False) -> GateResult:
        """Unique keys, after counting what has changed. The breach names the dates that hold copies."""
        self.refresh()
        wrong = F.col("rows") - F.col("unkeyed_rows") != F.col("unique_keys")
        days = [r["day"] for r in self.counts().where(wrong).select("day").orderBy("day").collect()]
        said = f"duplicate keys on {', '.join(map(str, days))}" if days else None
        return run_gate(self.metrics(), [lambda _: said], strict)


def rows_gate(
    left: DataFrame, right: DataFrame, entity: Sequence[str], time: str, compared: Sequence[str] = (), strict: bool = False, named: int = 5
) -> GateResult:
    """The same rows in both layers, not just as many. A breach names the first ``named`` differing keys;
    :func:`~pollpipe.operators.digests.differing_keys` gives all."""
    wrong = differing_keys(left, right, entity, time, compared)
    kinds = ("missing", "unexpected", "copies", "changed")
    metrics = wrong.agg(*[F.count_if(F.col("kind") == k).alias(k) for k in kinds])

    def same(values) -> str | None:
        if not any(values[k] for k in kinds):
            return None
        order = [*entity, time]
        first = wrong.orderBy(*order).limit(named).collect()
        keys = "; ".join("/".join(str(r[c]) for c in order) + f" {r['kind']}" for r in first)
        return f"rows differ: {', '.join(f'{values[k]} {k}' for k in kinds if values[k])} ({keys})"

    return run_gate(metrics, [same], strict)
