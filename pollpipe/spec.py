"""Declarations that drive every layer: typed fields, feeds and table contracts.

A feed is described once (which fields, of which type, nullable or not, which
columns identify a series and which one orders it); the operators generate their
Spark expressions from that description.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

SPARK_TYPES = {
    "str": T.StringType(),
    "float": T.DoubleType(),
    "int": T.LongType(),
    "bool": T.BooleanType(),
    "datetime": T.TimestampType(),
}


@dataclass(frozen=True)
class Field:
    """One typed column. An unknown type is refused here, before any job runs."""

    name: str
    type: str
    nullable: bool = False

    def __post_init__(self):
        if self.type not in SPARK_TYPES:
            raise ValueError(f"field {self.name!r}: unknown type {self.type!r}, use one of {sorted(SPARK_TYPES)}")

    @property
    def spark_type(self) -> T.DataType:
        return SPARK_TYPES[self.type]


@dataclass(frozen=True)
class FeedSpec:
    """A polled feed.

    ``fields``  every typed column, poll time included, in output order
    ``entity``  columns that identify one series
    ``time``    poll time; ``entity + time`` is the row key
    ``domain``  optional ``(column, value)`` that selects the rows of interest
    """

    fields: tuple[Field, ...]
    entity: tuple[str, ...]
    time: str
    domain: tuple[str, str] | None = None

    def __post_init__(self):
        names = [f.name for f in self.fields]
        if len(set(names)) != len(names):
            raise ValueError("duplicate field names in the feed")
        absent = [c for c in (*self.entity, self.time) if c not in names]
        if absent:
            raise ValueError(f"key columns are not declared as fields: {absent}")

    @property
    def key(self) -> tuple[str, ...]:
        return (*self.entity, self.time)

    @property
    def vendor_fields(self) -> tuple[str, ...]:
        """Fields expected inside each payload record: all but the poll time."""
        return tuple(f.name for f in self.fields if f.name != self.time)

    def typed_schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.spark_type, True) for f in self.fields])


@dataclass(frozen=True)
class ContractColumn:
    name: str
    type: str
    nullable: bool = False
    values: tuple[str, ...] = ()


@dataclass(frozen=True)
class Contract:
    """What a published table promises: columns, row grain, freshness, result caps."""

    columns: tuple[ContractColumn, ...]
    grain: tuple[str, ...]
    time: str | None = None
    max_lag_minutes: float | None = None
    max_rows: int = 10_000
    default_window_days: int = 30
    names: tuple[str, ...] = field(init=False)

    def __post_init__(self):
        object.__setattr__(self, "names", tuple(c.name for c in self.columns))
