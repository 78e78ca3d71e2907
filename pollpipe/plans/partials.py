"""Daily partial aggregates of a feature table, kept up to date, from which window questions are answered.

A state is one row per day and series: sums, counts, largest values, last times and co-moments, all of which
merge. A question about the last 30 days then reads 30 small files instead of 30 days of rows.
Days are marked dirty by the signature of their files, so appends and late repairs are seen alike, and a
refresh computes dirty days only. Beside the states each day has a sketch of its series and of its values.

Every refresh writes its days into folders of its own, and then one small file that names the folder of
every day. That file is the commit: until it is there readers see the states before.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.quantile import Percentile, merged_summary, percentile, value_summary
from ..operators.topk import top_k
from ..sources.tables import DATE, FeedTable

_LOG_SCHEMA = "day date, signature string, refresh long"
#: Nominal entries of a day's sketch of series, as a power of two: exact below, about 1.6 % off at two deviations above.
SERIES_LG = 14
#: Columns of the state of a pair: values known on both sides, means, sums of squares and of products around them, ranges.
_PAIR = ("n", "a", "b", "aa", "bb", "ab", "a_low", "a_high", "b_low", "b_high")


@dataclass(frozen=True)
class PartialSpec:
    """What the states hold: sums and extremes of ``measures``, rows and last time of ``flags``, co-moments of
    ``pairs``, and sketches of the absolute values of ``calibrated`` columns."""

    measures: tuple[str, ...] = ()
    flags: tuple[str, ...] = ()
    pairs: tuple[tuple[str, str], ...] = ()
    calibrated: tuple[str, ...] = ()

    def columns(self) -> list[str]:
        named = [*self.measures, *self.flags, *[c for p in self.pairs for c in p], *self.calibrated]
        return list(dict.fromkeys(named))


def _pair_state(a: str, b: str) -> Column:
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    x, y = F.when(both, F.col(a).cast("double")), F.when(both, F.col(b).cast("double"))
    n = F.count(x)
    moments = (n, F.avg(x), F.avg(y), F.var_pop(x) * n, F.var_pop(y) * n, F.covar_pop(x, y) * n, F.min(x), F.max(x), F.min(y), F.max(y))
    return F.struct(*[m.alias(name) for m, name in zip(moments, _PAIR, strict=True)])


def pair_name(a: str, b: str) -> str:
    return f"{a}__with__{b}"


@dataclass(frozen=True)
class DayPartials:
    """States of ``table`` per day and series ``entity``, in ``folder``. One writer at a time.

    Rows without a time belong to no window and have no state. A window is open at its end, as in
    :mod:`~pollpipe.plans.analytics`: it holds what the table held at the last refresh, from an instant on.
    """

    table: FeedTable
    folder: str
    entity: tuple[str, ...]
    spec: PartialSpec

    # ------------------------------------------------------------ which days are kept where

    def _last(self) -> int:
        try:
            names = self.table.spark.read.schema(_LOG_SCHEMA).parquet(f"{self.folder}/log").inputFiles()
        except AnalysisException as problem:
            if problem.getCondition() == "PATH_NOT_FOUND":
                return 0
            raise
        return max((int(m[1]) for n in names if (m := re.search(r"/number=(\d+)/", n))), default=0)

    def kept(self) -> dict[dt.date, tuple[str, int]]:
        """Signature and refresh of every day that has a state: one entry per calendar day."""
        last = self._last()
        if not last:
            return {}
        log = self.table.spark.read.schema(_LOG_SCHEMA).parquet(f"{self.folder}/log/number={last}")
        return {r["day"]: (r["signature"], r["refresh"]) for r in log.collect()}

    def dirty(self) -> list[dt.date]:
        """Days whose files are not those that their state was computed from."""
        known = self.kept()
        return sorted(d for d, s in self._now().items() if known.get(d, (None,))[0] != s)

    def _now(self) -> dict[dt.date, str]:
        if not self.table.exists():
            return {}
        found = self.table.signatures().where("day is not null")
        return {r["day"]: r["signature"] for r in found.collect()}

    def refresh(self) -> list[dt.date]:
        """Compute the dirty days again and forget days that have left the table; returns the dirty days.

        Signatures are taken before the rows are read, so a day that changes meanwhile stays dirty.
        A refresh that dies is repeated by the next one.
        """
        known, now = self.kept(), self._now()
        days = sorted(d for d, s in now.items() if known.get(d, (None,))[0] != s)
        if not days and known.keys() == now.keys():
            return []
        number = self._last() + 1
        if days:
            rows = self.table.read(dates=days)
            states = self._states(rows).hint("rebalance", F.col("day")).sortWithinPartitions("day", *self.entity)
            states.write.mode("overwrite").partitionBy("day").parquet(f"{self.folder}/states/number={number}")
            sketches = self._sketches(rows).hint("rebalance", F.col("day"))
            sketches.write.mode("overwrite").partitionBy("day").parquet(f"{self.folder}/sketches/number={number}")
        entries = [(d, s, number if d in days else known[d][1]) for d, s in now.items()]
        log = self.table.spark.createDataFrame(entries, _LOG_SCHEMA).coalesce(1)
        log.write.mode("overwrite").parquet(f"{self.folder}/log/number={number}")  # one file: all of the refresh or none
        return days

    # ------------------------------------------------------------ states

    def _states(self, rows: DataFrame) -> DataFrame:
        time = F.col(self.table.time)
        aggregates = [F.count(F.lit(1)).alias("rows"), F.max(time).alias("last_seen_at")]
        for m in self.spec.measures:
            aggregates += [F.count(m).alias(f"{m}__n"), F.sum(m).alias(f"{m}__sum"), F.max(m).alias(f"{m}__max"), F.max(F.abs(m)).alias(f"{m}__abs")]
        for f in self.spec.flags:
            aggregates += [F.count_if(F.col(f)).alias(f"{f}__n"), F.max(F.when(F.col(f), time)).alias(f"{f}__last")]
        aggregates += [_pair_state(a, b).alias(pair_name(a, b)) for a, b in self.spec.pairs]
        return self._with_day(rows).groupBy("day", *self.entity).agg(*aggregates)

    def _sketches(self, rows: DataFrame) -> DataFrame:
        series = F.theta_sketch_agg(F.xxhash64(*self.entity), SERIES_LG).alias("series")
        values = [value_summary(f"__abs_{c}").alias(c) for c in self.spec.calibrated]
        dated = self._with_day(rows).withColumns({f"__abs_{c}": F.abs(c) for c in self.spec.calibrated})
        return dated.groupBy("day").agg(series, *values)

    def _with_day(self, rows: DataFrame) -> DataFrame:
        needed = rows.select(*dict.fromkeys([*self.entity, self.table.time, *self.spec.columns()]))
        return self.table.with_date(needed).withColumnRenamed(DATE, "day").where("day is not null")

    def _window(self, kind: str, compute, since: dt.datetime | None, until: dt.date | None) -> DataFrame:
        """Kept days of ``kind`` from ``since`` on; a first day that is cut is computed from its rows."""
        chosen = {d: r for d, (_, r) in self.kept().items() if (since is None or d >= since.date()) and (until is None or d <= until)}
        edge = None
        if since is not None and since.time() != dt.time() and chosen.pop(since.date(), None) is not None:
            end = dt.datetime.combine(since.date(), dt.time.max)
            edge = compute(self.table.read(since=since, until=end))
        empty = compute(self.table.read().where(F.lit(False)))
        parts = [empty if edge is None else edge]
        if chosen:
            base = f"{self.folder}/{kind}"
            paths = [f"{base}/number={r}/day={d}" for d, r in sorted(chosen.items())]
            kept = self.table.spark.read.schema(empty.schema).option("basePath", base).parquet(*paths)
            parts.append(kept.select(*empty.columns))
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def states(self, since: dt.datetime | None = None, until: dt.date | None = None) -> DataFrame:
        """States of all rows from ``since`` (UTC) to the end of day ``until``: input of the questions below."""
        return self._window("states", self._states, since, until)

    def sketches(self, since: dt.datetime | None = None, until: dt.date | None = None) -> DataFrame:
        """Sketches of the same rows, one row per day."""
        return self._window("sketches", self._sketches, since, until)

    def threshold(self, column: str, fraction: float, since: dt.datetime | None = None) -> Percentile:
        """Exact percentile of the absolute values of a calibrated column over a window.

        The kept sketches bracket it, so the table is read once. The states must be fresh: on dirty days
        in the window this is refused.
        """
        stale = [d for d in self.dirty() if since is None or d >= since.date()]
        if stale:
            raise ValueError(f"refresh first: {len(stale)} days have changed, the first of them {stale[0]}")
        summary = self.sketches(since).agg(merged_summary(column).alias("s"))
        rows = self.table.read(since=since).where(F.col(self.table.time).isNotNull())
        return percentile(rows.select(F.abs(column).alias("v")), "v", fraction, summary)


# ---------------------------------------------------------------- questions over states


def average_of_states(states: DataFrame, group: Sequence[str], measure: str, k: int | None = None, name: str = "average_rate") -> DataFrame:
    """Average of a measure per group, largest first."""
    means = states.groupBy(*group).agg(F.try_divide(F.sum(f"{measure}__sum"), F.sum(f"{measure}__n")).alias(name))
    return top_k(means, name, group, k)


def largest_of_states(states: DataFrame, group: Sequence[str], change: str, k: int | None = None, name: str = "largest_move") -> DataFrame:
    """Largest absolute value of a measure per group, largest first."""
    return top_k(states.groupBy(*group).agg(F.max(f"{change}__abs").alias(name)), name, group, k)


def flagged_of_states(
    states: DataFrame, entity: Sequence[str], flag: str, k: int | None = None, count: str = "large_move_count", last: str = "last_large_move_at"
) -> DataFrame:
    """Series with flagged rows: how many, and the last one; most first."""
    found = states.where(F.col(f"{flag}__n") > 0).groupBy(*entity).agg(F.sum(f"{flag}__n").alias(count), F.max(f"{flag}__last").alias(last))
    return top_k(found, count, entity, k)


def rows_of_states(states: DataFrame, group: Sequence[str], k: int | None = None, name: str = "n") -> DataFrame:
    """Rows per group and when it was seen last, largest first."""
    found = states.groupBy(*group).agg(F.sum("rows").alias(name), F.max("last_seen_at").alias("last_seen_at"))
    return top_k(found, name, group, k)


def groups_of_states_above(states: DataFrame, group: Sequence[str], measure: str, limit: float, name: str = "m") -> DataFrame:
    """Groups whose largest value exceeds ``limit``."""
    return states.groupBy(*group).agg(F.max(f"{measure}__max").alias(name)).where(F.col(name) > limit)


def correlation_of_states(states: DataFrame, entity: Sequence[str], a: str, b: str) -> DataFrame:
    """Correlation of a pair per series, with the number of pairs; NULL if one side is constant.

    Moments are moved to the mean of the whole series before they are added, in a second aggregate, so
    nothing is lost where values are large against their spread.
    """
    parts = states.select(*entity, f"{pair_name(a, b)}.*")
    n = F.sum("n")
    centre = parts.groupBy(*entity).agg(
        n.alias("pairs"), F.try_divide(F.sum(F.col("n") * F.col("a")), n).alias("ca"), F.try_divide(F.sum(F.col("n") * F.col("b")), n).alias("cb"),
        ((F.min("a_low") < F.max("a_high")) & (F.min("b_low") < F.max("b_high"))).alias("varies"),
    )
    renamed = centre.select(*[F.col(c).alias(f"__{c}") for c in entity], "pairs", "ca", "cb", "varies")
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in entity]
    moved = parts.where("n > 0").join(renamed, same)
    da, db = F.col("a") - F.col("ca"), F.col("b") - F.col("cb")
    sums = moved.groupBy(*entity).agg(
        F.max("varies").alias("varies"),
        F.sum(F.col("aa") + F.col("n") * da * da).alias("aa"), F.sum(F.col("bb") + F.col("n") * db * db).alias("bb"),
        F.sum(F.col("ab") + F.col("n") * da * db).alias("ab"), n.alias("pairs"),
    )
    value = F.when(F.col("varies"), F.try_divide(F.col("ab"), F.sqrt("aa") * F.sqrt("bb")))
    return sums.select(*entity, value.alias("correlation"), "pairs")


def series_seen(sketches: DataFrame) -> DataFrame:
    """One row: ``series``, the estimated number of different series in the days of ``sketches``."""
    union = F.theta_sketch_estimate(F.theta_union_agg("series", SERIES_LG))
    return sketches.agg(F.coalesce(F.when(F.count("series") > 0, union), F.lit(0)).cast("long").alias("series"))


def series_in_both(first: DataFrame, second: DataFrame) -> DataFrame:
    """One row: how many series either window has (``first``, ``second``), either (``either``) and both (``shared``), estimated."""
    both = first.select("series", F.lit(1).alias("side")).unionByName(second.select("series", F.lit(2).alias("side")))
    united = [F.theta_union_agg(F.when(F.col("side") == n, F.col("series")), SERIES_LG).alias(name) for n, name in ((1, "a"), (2, "b"))]
    sides = both.agg(*united)
    estimate = lambda sketch: F.coalesce(F.theta_sketch_estimate(sketch), F.lit(0)).cast("long")
    return sides.select(
        estimate(F.col("a")).alias("first"), estimate(F.col("b")).alias("second"),
        estimate(F.theta_union("a", "b", SERIES_LG)).alias("either"), estimate(F.theta_intersection("a", "b")).alias("shared"),
    )
