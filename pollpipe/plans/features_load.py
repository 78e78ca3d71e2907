"""Incremental feature builds: watermark, bounded lookback, late rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.derive import micros
from ..operators.features import ChangeSpec, add_features, change_features
from ..operators.lags import Cut, choose_cut, latest_times, with_previous
from ..operators.merge import key_facts, new_rows, one_per_key, upsert_into
from ..session import written
from ..sources.tables import FeedTable, from_micros, to_micros

_NEW, _LATE = "__new", "__late"


def earliest(df: DataFrame, time: str) -> dt.datetime | None:
    """Earliest time of ``df`` in UTC; None if it has no rows."""
    return from_micros(df.agg(F.min(micros(F.col(time)))).first()[0])


def features_of_new_rows(
    history: DataFrame,
    new: DataFrame,
    spec: ChangeSpec,
    slicing: Cut | int | str | None = "auto",
    rows: int | None = None,
) -> DataFrame:
    """Features of the rows of ``new`` (``rows`` of them, if known), given the rows of ``history``
    before them.

    Only the newest ``lookback`` times per series of ``history`` take part, one row each.
    ``history`` must hold no row at or after the earliest of ``new``.
    """
    context = latest_times(history, spec.entity, spec.time, spec.lookback)
    context = one_per_key(context, (*spec.entity, spec.time), spec.tiebreak)
    if slicing == "auto":
        # the context adds only a few rows per series
        slicing = choose_cut(new, spec.entity, spec.time, spec.lookback, rows=rows)
    both = context.withColumn(_NEW, F.lit(False)).unionByName(new.withColumn(_NEW, F.lit(True)))
    featured = change_features(both, spec, slicing)
    return featured.where(F.col(_NEW)).drop(_NEW)


def build_features(
    source: FeedTable,
    target: FeedTable,
    spec: ChangeSpec,
    columns: Sequence[str],
    lookback: dt.timedelta | None,
    domain: tuple[str, str] | None = None,
    slicing: Cut | int | str | None = "auto",
) -> bool:
    """Compute the features of source rows newer than the target and upsert them.

    The lookback bounds how far before the earliest new row predecessors are searched;
    ``None`` searches all of the source. Results equal a full recomputation if every
    series has its predecessors inside the bound; otherwise they are NULL. Copies of a key are
    reduced to one, by the tie-break and then all columns. One aggregate over the keys of the
    new rows gives all that is to be known of them. Returns whether there was anything new.
    """
    watermark = target.max_time()
    key = (*spec.entity, spec.time)
    new = _of_domain(source.read(after=watermark), domain)
    facts = key_facts(target, new, key)
    if facts.first is None:
        return False
    if facts.copies:
        new = written(one_per_key(new, key, spec.tiebreak), "new")
        facts = replace(facts, rows=facts.rows - facts.copies, copies=0)
    since = None if lookback is None else facts.first - lookback
    history = _of_domain(source.read(since=since, before=facts.first), domain)
    featured = features_of_new_rows(history, new, spec, slicing, facts.rows).select(*columns)
    upsert_into(target, featured, key, facts=facts)
    return True


def affected_by_late_rows(
    rows: DataFrame, late: DataFrame, spec: ChangeSpec, slicing: Cut | int | str | None = "auto"
) -> DataFrame:
    """Features of every late row and of the rows whose predecessors now include one.

    ``rows`` holds the late rows too, and ``late`` names them by key. A row is affected
    if it is late or one of its ``lookback`` predecessors is.
    """
    key = [*spec.entity, spec.time]
    if slicing == "auto":
        slicing = choose_cut(rows, spec.entity, spec.time, spec.lookback)
    # one row per late key: the mark cannot multiply rows
    marks = late.select(*key).distinct().withColumn(_LATE, F.lit(True))
    of_series = rows.join(late.select(*spec.entity).distinct(), list(spec.entity), "left_semi")
    marked = of_series.join(marks, key, "left").withColumn(_LATE, F.coalesce(_LATE, F.lit(False)))
    depth = {**spec.depth, _LATE: spec.lookback}
    lagged = with_previous(marked, spec.entity, spec.time, depth, spec.tiebreak, slicing)
    hit = F.col(_LATE)
    for i in range(1, spec.lookback + 1):
        hit = hit | F.coalesce(F.col(f"prev_{_LATE}_{i}"), F.lit(False))
    return add_features(lagged.where(hit), spec).select(*rows.columns, *spec.feature_names)


def repair_late_rows(
    source: FeedTable,
    target: FeedTable,
    spec: ChangeSpec,
    columns: Sequence[str],
    lookback: dt.timedelta | None,
    arrived: DataFrame | None = None,
    domain: tuple[str, str] | None = None,
    slicing: Cut | int | str | None = "auto",
) -> bool:
    """Add source rows that the watermark skipped, and recompute the rows after them.

    Such rows are at or before the newest target time, and missing in the target. If the
    newly ``arrived`` source rows are known, only those are looked at; otherwise all of
    the source is compared with all of the target. ``lookback`` bounds how far around late
    rows predecessors and successors are read. Returns whether there were any.
    """
    watermark = target.max_time()
    if watermark is None:
        return False
    key = (*spec.entity, spec.time)
    # small, and used several times: found once
    late = written(late_keys(source, target, key, arrived, domain), "late")
    bounds = late.agg(F.min(micros(F.col(spec.time))), F.max(micros(F.col(spec.time)))).first()
    first, last = (from_micros(b) for b in bounds)
    if first is None:
        return False
    since = None if lookback is None else first - lookback
    until = watermark if lookback is None else min(watermark, last + lookback)
    around = one_per_key(_of_domain(source.read(since=since, until=until), domain), key, spec.tiebreak)
    fixed = written(affected_by_late_rows(around, late, spec, slicing).select(*columns), "fixed")
    upsert_into(target, fixed, key)
    return True


def late_keys(
    source: FeedTable,
    target: FeedTable,
    key: Sequence[str],
    arrived: DataFrame | None = None,
    domain: tuple[str, str] | None = None,
) -> DataFrame:
    """Keys of source rows that a watermark-driven load skipped for good.

    Counting them is the whole of a policy that drops late rows. With ``arrived``, only
    those rows are looked at, and of the target only the dates from the earliest on.
    """
    watermark = target.max_time()
    if watermark is None:
        raise ValueError("the target has no rows, so nothing can be late")
    if arrived is None:
        since, rows = None, source.read(until=watermark)
    else:
        since = earliest(arrived, target.time) or watermark
        rows = arrived.where(micros(F.col(target.time)) <= to_micros(watermark))
    keys = _of_domain(rows, domain).select(*key).distinct()
    return new_rows(keys, target.read(since=since, until=watermark), key)


def _of_domain(df: DataFrame, domain: tuple[str, str] | None) -> DataFrame:
    return df if domain is None else df.where(F.col(domain[0]) == F.lit(domain[1]))
