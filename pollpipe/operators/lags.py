"""Previous values within a series, for series of any length.

``lag`` over a window partitioned by series puts each series into one task. A series that
is too long for a task is *heavy* and computed in two steps with the same result:

1. Cut it into slices that are contiguous in time and compute the lags inside each
   slice. Only the first ``k`` rows of a slice can lack predecessors.
2. Take the first and last ``k`` rows of every slice, the *edges*, and compute their lags
   over the whole series. All ``k`` predecessors of a first row are edges themselves, so
   this is exact; it moves ``2k`` rows per slice instead of the whole series.

All other series stay in one slice each and are finished after step 1. Both steps read one
shuffle of the input (the exchange is reused). The slice is a time bucket whose width
follows from the measured row counts. If no width bounds the slices (very many rows of one
series at one instant), heavy rows are range-partitioned by series, time and tie-break,
and the range partition is the slice.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.derive import micros
from ..session import checkpoint

ROWS_PER_TASK = 2_000_000
SECOND = 1_000_000
# Slice widths to choose from, widest first, in microseconds.
WIDTHS = tuple(n * SECOND for n in (30 * 86_400, 86_400, 3_600, 60, 1))

RANGE = "range"
SAMPLED = 400
# Beyond this many heavy series, all series count as heavy; bounds what is broadcast.
MAX_HEAVY = 100_000

_SLICE, _CUT, _HEAD, _TAIL, _ROW, _HEAVY = "__slice", "__cut", "__head", "__tail", "__row", "__heavy"


@dataclass(frozen=True)
class Cut:
    """How to cut heavy series: slice ``width`` in microseconds or ``"range"``, and the
    ``heavy`` series themselves (``None``: every series)."""

    width: int | str
    heavy: tuple[tuple, ...] | None = None


def time_slice(time: str, width_micros: int) -> Column:
    return F.floor(micros(F.col(time)) / F.lit(width_micros))


def choose_cut(
    df: DataFrame, entity: Sequence[str], time: str, depth: int = 1, rows_per_task: int = ROWS_PER_TASK,
    rows: int | None = None,
) -> Cut | None:
    """How to cut ``df`` so that no task gets many more than ``rows_per_task`` rows of a series.

    ``None`` if no series is longer than that. The row count settles small inputs. For
    others, series are counted on a sample in which a series of ``rows_per_task`` rows has
    about ``SAMPLED`` rows. The choice steers the balance only, never the result. Bounds are
    checked over all heavy series; the driver sees maxima, and the heavy series themselves if
    they are at most ``MAX_HEAVY``. ``rows`` is the row count, if known.
    """
    if (df.count() if rows is None else rows) <= rows_per_task:
        return None
    fraction = min(1.0, SAMPLED / rows_per_task)
    limit = rows_per_task * fraction
    # four standard deviations of the sampled counts, on either side
    noise = 4 * limit**0.5 if fraction < 1 else 0.0
    seen = df.select(*entity, time)
    if fraction < 1:
        seen = seen.sample(fraction, seed=1)
    counted, instant = F.count(F.lit(1)), micros(F.col(time))
    found = seen.groupBy(*entity).agg(counted.alias("n"), (F.max(instant) - F.min(instant)).alias("span"))
    heavy = checkpoint(found.where(F.col("n") > limit - noise))
    slices = {w: F.floor(F.coalesce("span", F.lit(0)) / w) + 1 for w in WIDTHS}
    # all edges of a series meet in one task of the second step
    facts = heavy.agg(
        F.count(F.lit(1)).alias("series"),
        *[F.max(F.col("n") / s).alias(f"mean_{w}") for w, s in slices.items()],
        *[F.max(F.least(F.col("n") / fraction, 2 * depth * s)).alias(f"edges_{w}") for w, s in slices.items()],
    ).first()
    if not facts["series"]:
        return None
    listed = None
    if facts["series"] <= MAX_HEAVY:
        listed = tuple(tuple(r) for r in heavy.select(*entity).collect())
        seen = seen.join(*_matching(df, entity, listed), "left_semi")
    for width in WIDTHS:
        if facts[f"mean_{width}"] > limit or facts[f"edges_{width}"] > rows_per_task:
            continue
        sizes = seen.groupBy(*entity, time_slice(time, width).alias(_SLICE)).agg(counted.alias("n"))
        if sizes.agg(F.max("n")).first()[0] <= limit + noise:
            return Cut(width, listed)
    return Cut(RANGE, listed)


def _matching(df: DataFrame, entity: Sequence[str], heavy: Sequence[tuple]) -> tuple[DataFrame, Column]:
    """The heavy series as a broadcast frame, and the join condition; NULL matches NULL."""
    names = [f"__heavy_{i}" for i in range(len(entity))]
    keys = df.sparkSession.createDataFrame(list(heavy), df.select(*entity).schema).toDF(*names)
    condition = reduce(Column.__and__, [F.col(e).eqNullSafe(F.col(n)) for e, n in zip(entity, names)])
    return F.broadcast(keys), condition


def with_previous(
    df: DataFrame,
    entity: Sequence[str],
    time: str,
    previous: Mapping[str, int],
    tiebreak: Sequence[str] = (),
    slicing: Cut | int | str | None = "auto",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Adds ``prev_<column>_1 .. prev_<column>_n`` for every ``column: n`` of ``previous``.

    Predecessors are counted in rows of the same series, rows with a NULL value included.
    ``tiebreak`` orders rows of one series at the same time. ``slicing`` is ``"auto"``
    (measure, then decide), ``None`` (one window per series), a :class:`Cut`, or to cut
    every series a slice width in microseconds or ``"range"``.
    """
    if not previous or min(previous.values()) < 1:
        raise ValueError("ask for at least one predecessor of at least one column")
    order = [time, *tiebreak]
    if slicing == "auto":
        slicing = choose_cut(df, entity, time, max(previous.values()), rows_per_task)
    if slicing is None:
        return _whole(df, entity, order, previous)
    cut = slicing if isinstance(slicing, Cut) else Cut(slicing)
    if cut.width == RANGE:
        return _by_range(df, entity, order, previous, cut, rows_per_task)
    bucket = time_slice(time, cut.width)
    if cut.heavy is None:
        sliced = df.withColumn(_SLICE, bucket)
    else:
        keys, condition = _matching(df, entity, cut.heavy)
        marked = df.join(keys.withColumn(_HEAVY, F.lit(True)), condition, "left")
        sliced = marked.withColumn(_SLICE, F.when(F.col(_HEAVY), bucket)).select(*df.columns, _SLICE)
    return _two_step(sliced, df.columns, entity, order, previous)


def _lag_columns(previous: Mapping[str, int], window) -> dict[str, Column]:
    return {
        f"prev_{name}_{i}": F.lag(name, i).over(window)
        for name, depth in previous.items()
        for i in range(1, depth + 1)
    }


def _whole(df: DataFrame, entity: Sequence[str], order: list[str], previous: Mapping[str, int]) -> DataFrame:
    return df.withColumns(_lag_columns(previous, Window.partitionBy(*entity).orderBy(*order)))


def _by_range(
    df: DataFrame, entity: Sequence[str], order: list[str], previous: Mapping[str, int], cut: Cut, rows_per_task: int
) -> DataFrame:
    long, rest = df, None
    if cut.heavy is not None:
        long = df.join(*_matching(df, entity, cut.heavy), "left_semi")
        rest = df.join(*_matching(df, entity, cut.heavy), "left_anti")
    # The row number splits even groups of identical copies. It depends on the input split
    # and the range bounds are sampled, so both are written down before they are relied on:
    # a task that is run again must not see other numbers or bounds.
    numbered = checkpoint(long.withColumn(_ROW, F.monotonically_increasing_id()))
    parts = max(2, -(-numbered.count() // rows_per_task))
    ranged = checkpoint(
        numbered.repartitionByRange(parts, *entity, *order, _ROW).withColumn(
            _SLICE, F.spark_partition_id().cast("bigint")
        )
    )
    result = _two_step(ranged, df.columns, entity, [*order, _ROW], previous)
    return result if rest is None else result.unionByName(_whole(rest, entity, order, previous))


def _two_step(
    sliced: DataFrame, columns: Sequence[str], entity: Sequence[str], order: list[str], previous: Mapping[str, int]
) -> DataFrame:
    """Lags of rows with a slice column; a NULL slice means the series is not cut."""
    depth = max(previous.values())
    inside = Window.partitionBy(*entity, _SLICE).orderBy(*order)
    across = Window.partitionBy(*entity).orderBy(*order)
    # The flag is a column of its own: a condition on the slice would be pushed below the
    # window into one of the two branches, which then could not share the shuffle.
    lagged = sliced.withColumn(_CUT, F.col(_SLICE).isNotNull()).withColumns(
        {
            **_lag_columns(previous, inside),
            _HEAD: F.col(_CUT) & F.lag(F.lit(True), depth).over(inside).isNull(),
            _TAIL: F.col(_CUT) & F.lead(F.lit(True), depth).over(inside).isNull(),
        }
    )
    result = [*columns, *_lag_columns(previous, across)]
    inputs = [*columns, *[c for c in order if c not in columns]]
    interior = lagged.where(~F.col(_HEAD)).select(*result)
    edges = lagged.where(F.col(_HEAD) | F.col(_TAIL)).select(*inputs, _HEAD)
    heads = edges.withColumns(_lag_columns(previous, across)).where(F.col(_HEAD)).select(*result)
    return interior.unionByName(heads)


def latest_rows(
    df: DataFrame, entity: Sequence[str], time: str, n: int = 1, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """The ``n`` newest rows of every series.

    The rank filter is applied before the shuffle too, so each task sends at most ``n``
    rows per series, however long the series is.
    """
    order = [F.col(c).desc() for c in (time, *tiebreak)]
    ranked = df.withColumn(_ROW, F.row_number().over(Window.partitionBy(*entity).orderBy(*order)))
    return ranked.where(F.col(_ROW) <= n).drop(_ROW)


def latest_times(df: DataFrame, entity: Sequence[str], time: str, n: int) -> DataFrame:
    """All rows at the ``n`` newest times of every series; filtered before the shuffle as well."""
    newest = F.dense_rank().over(Window.partitionBy(*entity).orderBy(F.col(time).desc()))
    return df.withColumn(_ROW, newest).where(F.col(_ROW) <= n).drop(_ROW)
