"""Incremental features from carried state: the newest rows of every series instead of a lookback scan.

The state is a small table of the newest ``lookback`` feature rows per series. A load reads the
files that arrived in the source, the state, and nothing of the history, so a series may
have been silent for any time. Rows that come late are the exception: around them the source is
read, just as far as it takes to find their neighbours.

The state of batch ``n`` lies in slot ``n % 2`` and counts once the log holds batch ``n``; until then
the other slot, with the state before, is the valid one. One commit thus switches both.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.derive import micros
from ..operators.features import ChangeSpec, change_features
from ..operators.lags import Cut, choose_cut, latest_rows
from ..operators.merge import insert_into, new_rows, one_per_key, upsert_into
from ..session import written
from ..sources.arrivals import FILES_PER_BATCH, Arrivals, Batch
from ..sources.tables import FeedTable, from_micros
from .features_load import _of_domain, affected_by_late_rows

_LATE, _NEW, _NEWEST = "__late", "__new", "__newest"


@dataclass(frozen=True)
class SeriesState:
    """The newest feature rows per series, in ``folder``, together with the log of files taken."""

    spark: SparkSession
    folder: str
    entity: tuple[str, ...]
    time: str

    @property
    def log(self) -> str:
        return f"{self.folder}/log"

    def version(self, number: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/slot={number % 2}/rows")

    def put(self, number: int, rows: DataFrame) -> None:
        """Write the state of batch ``number``; it counts as soon as that batch is committed."""
        spread = rows.hint("rebalance", *[F.col(c) for c in self.entity]).sortWithinPartitions(*self.entity, self.time)
        spread.write.mode("overwrite").parquet(f"{self.folder}/slot={number % 2}/rows")

    def rows(self, source: FeedTable) -> DataFrame:
        """The state as last committed: input for any question about newest rows."""
        last = Arrivals(source, self.log).last()
        if not last:
            raise ValueError("no batch has been loaded yet")
        return self.version(last)


@dataclass(frozen=True)
class Carried:
    """What a load did: files taken, rows on time, late rows, and rows recomputed because of them."""

    files: int = 0
    on_time: int = 0
    late: int = 0
    recomputed: int = 0

    def __add__(self, other: Carried) -> Carried:
        return Carried(self.files + other.files, self.on_time + other.on_time, self.late + other.late, self.recomputed + other.recomputed)


def load_gold_carried(
    source: FeedTable,
    target: FeedTable,
    spec: ChangeSpec,
    columns: Sequence[str],
    state: SeriesState,
    domain: tuple[str, str] | None = None,
    files_per_batch: int = FILES_PER_BATCH,
    slicing: Cut | int | str | None = "auto",
) -> Carried:
    """Features of all source rows that arrived since the last load; equals a full computation.

    A row newer than the state of its series is on time and computed from that state. Any other
    row is late: it is added, and it and the rows after it that see it among their predecessors are
    computed again from the source. Copies of a key are reduced to one. Every step can be
    repeated, so a load that died is repeated by the next one. A target that was filled
    without state gives the first state.
    """
    base = [c for c in columns if c not in spec.feature_names]
    needed = [*spec.entity, spec.time, *spec.depth, *spec.tiebreak]
    if absent := [c for c in needed if c not in base]:
        raise ValueError(f"the state needs these columns as well: {absent}")
    arrivals, done = Arrivals(source, state.log), Carried()
    while batch := arrivals.next_batch(files_per_batch):
        done += _load(batch, source, target, spec, list(columns), base, state, domain, slicing)
        arrivals.commit(batch)
    return done


def _load(
    batch: Batch, source: FeedTable, target: FeedTable, spec: ChangeSpec, columns: list[str], base: list[str],
    state: SeriesState, domain: tuple[str, str] | None, slicing: Cut | int | str | None,
) -> Carried:
    entity, key = list(spec.entity), [*spec.entity, spec.time]
    new = one_per_key(_of_domain(batch.read(), domain).select(*base), key, spec.tiebreak)
    old = None
    if batch.number > 1:
        old = state.version(batch.number - 1)
    elif target.exists():
        old = written(latest_rows(target.read().select(*columns), entity, spec.time, spec.lookback, spec.tiebreak), "state")
    if old is None:
        new = new.withColumn(_LATE, F.lit(False))
    else:
        newest = old.groupBy(*entity).agg(F.max(spec.time).alias(_NEWEST))
        late = F.coalesce(F.col(spec.time) <= F.col(_NEWEST), F.lit(False))
        new = new.join(newest, entity, "left").withColumn(_LATE, late).drop(_NEWEST)
    new = written(new, "arrived")
    on_time, late_rows, first, last = new.agg(
        F.count_if(~F.col(_LATE)), F.count_if(_LATE),
        F.min(F.when(F.col(_LATE), micros(F.col(spec.time)))), F.max(F.when(F.col(_LATE), micros(F.col(spec.time)))),
    ).first()

    changed = []
    if on_time:
        featured = written(_on_time(new.where(~F.col(_LATE)).drop(_LATE), old, spec, base, columns, slicing, on_time), "featured")
        insert_into(target, featured, key)
        changed.append(featured)
    recomputed = 0
    if late_rows:
        late = new.where(_LATE).select(*key)
        since, until = reach(source, late, spec, from_micros(first), from_micros(last), domain)
        around = _of_domain(source.read(since=since, until=until), domain).select(*base)
        around = one_per_key(around.join(late.select(*entity).distinct(), entity, "left_semi"), key, spec.tiebreak)
        fixed = written(affected_by_late_rows(around, late, spec, slicing).select(*columns), "recomputed")
        recomputed = fixed.count()
        upsert_into(target, fixed, key)
        changed.insert(0, fixed)

    rows = None
    for part in [*changed, *([old] if old is not None else [])]:  # what was computed last counts
        rows = part.select(*columns) if rows is None else rows.unionByName(new_rows(part.select(*columns), rows, key))
    if rows is None:
        rows = new.drop(_LATE).withColumns({c: F.lit(None) for c in columns if c not in base}).select(*columns)
    state.put(batch.number, latest_rows(rows, entity, spec.time, spec.lookback, spec.tiebreak))
    return Carried(len(batch.paths), on_time, late_rows, recomputed)


def _on_time(
    new: DataFrame, old: DataFrame | None, spec: ChangeSpec, base: list[str], columns: list[str],
    slicing: Cut | int | str | None, rows: int,
) -> DataFrame:
    if slicing == "auto":
        slicing = choose_cut(new, spec.entity, spec.time, spec.lookback, rows=rows)
    both = new.withColumn(_NEW, F.lit(True))
    if old is not None:
        known = old.select(*base).join(new.select(*spec.entity).distinct(), list(spec.entity), "left_semi")
        both = both.unionByName(known.withColumn(_NEW, F.lit(False)))
    return change_features(both, spec, slicing).where(_NEW).select(*columns)


def reach(
    source: FeedTable, late: DataFrame, spec: ChangeSpec, first: dt.datetime, last: dt.datetime,
    domain: tuple[str, str] | None = None,
) -> tuple[dt.datetime, dt.datetime]:
    """Times between which every late row has its ``lookback`` predecessors and successors, or all there are.

    Looks one day beyond the late rows, then four times as far, and so on, at keys of the series
    concerned only. Stops where every such series has enough rows on that side, or the
    source ends.
    """
    entity = list(spec.entity)
    ends = written(late.groupBy(*entity).agg(F.min(spec.time).alias("__first"), F.max(spec.time).alias("__last")), "late-series")
    dates = source.dates()
    begin = dt.datetime.combine(dates[0], dt.time())
    end = dt.datetime.combine(dates[-1], dt.time()) + dt.timedelta(days=1)
    since, until, days = first, last, 1
    back, ahead = True, True
    while back or ahead:
        since = max(begin, first - dt.timedelta(days=days)) if back else since
        until = min(end, last + dt.timedelta(days=days)) if ahead else until
        seen = _of_domain(source.read(since=since, until=until), domain).select(*entity, spec.time).distinct()
        seen = ends.join(seen, entity, "left")
        counts = seen.groupBy(*entity).agg(
            F.count_if(F.col(spec.time) < F.col("__first")).alias("before"), F.count_if(F.col(spec.time) > F.col("__last")).alias("after")
        )
        before, after = counts.agg(F.count_if(F.col("before") < spec.lookback), F.count_if(F.col("after") < spec.lookback)).first()
        back, ahead = back and before > 0 and since > begin, ahead and after > 0 and until < end
        days *= 4
    return since, until
