"""Change features of a typed table: every row against its predecessors."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.changes import change, is_frozen, is_large_move
from .lags import ROWS_PER_TASK, Cut, with_previous


@dataclass(frozen=True)
class ChangeSpec:
    """Which features to compute.

    ``measure``    column watched for change, large moves and freezing
    ``change_as``  name of its change column
    ``changes``    further ``(column, name of its change column)`` pairs
    ``threshold``  absolute change that counts as a large move, inclusive
    ``lookback``   number of equal predecessors that make a value frozen
    """

    entity: tuple[str, ...]
    time: str
    measure: str
    change_as: str
    threshold: float
    changes: tuple[tuple[str, str], ...] = ()
    lookback: int = 5
    tiebreak: tuple[str, ...] = ()

    def __post_init__(self):
        if self.lookback < 1:
            raise ValueError("lookback must be at least 1")

    @property
    def depth(self) -> dict[str, int]:
        return {self.measure: self.lookback, **{c: 1 for c, _ in self.changes if c != self.measure}}

    @property
    def feature_names(self) -> tuple[str, ...]:
        return (self.change_as, "is_large_move", "is_frozen", *[name for _, name in self.changes])


def change_features(
    df: DataFrame,
    spec: ChangeSpec,
    slicing: Cut | int | str | None = "auto",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """All columns of ``df`` plus the features; NULL where a needed predecessor is missing."""
    lagged = with_previous(df, spec.entity, spec.time, spec.depth, spec.tiebreak, slicing, rows_per_task)
    return add_features(lagged, spec).select(*df.columns, *spec.feature_names)


def add_features(lagged: DataFrame, spec: ChangeSpec) -> DataFrame:
    """The features, given the ``prev_*`` columns of :func:`with_previous`."""
    now = F.col(spec.measure)
    before = [F.col(f"prev_{spec.measure}_{i}") for i in range(1, spec.lookback + 1)]
    delta = change(now, before[0])
    return lagged.withColumns(
        {
            spec.change_as: delta,
            "is_large_move": is_large_move(delta, spec.threshold),
            "is_frozen": is_frozen(now, before),
            **{name: change(F.col(c), F.col(f"prev_{c}_1")) for c, name in spec.changes},
        }
    )
