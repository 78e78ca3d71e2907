"""Change features from keyed streaming state: the last values of every series, kept by the stream itself.

Nothing is read back from any table. Each series keeps its ``lookback`` newest rows in the state
store, however long ago they came, so a series may be silent for any time. The operator only
looks predecessors up; the features are the same column expressions as in a batch.

Rows meet the operator column by column: series are dealt into ``PARTS`` parts by hash, and the rows
of a part travel as Arrow values and are worked on together, as are the states of its series. With a
clock of silence every series has a timer, and state, of its own.
"""

from __future__ import annotations

import datetime as dt
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from dataclasses import replace
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..functions.derive import micros
from ..operators.features import ChangeSpec, add_features
from ..operators.merge import insert_into, one_per_key, split_null_keys
from ..session import setting, written
from ..sources.tables import FeedTable

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"

ON_TIME, LATE, SILENT = "on_time", "late", "silent"
# names without a leading underscore: the state API would rename those
_AT, _KIND, _ARRIVED, _ARRIVED_MS = "at_micros", "row_kind", "arrived_at", "arrived_ms"
_PART, _ROWS, _COPIES = "series_part", "packed_rows", "copies_of"

#: Parts that series are dealt into. A batch writes the state of each part anew that it adds rows to. A stream
#: keeps its number of parts: the state store knows series by their part.
PARTS = 1024
#: Rows that a task gathers before it deals them out, and the most rows of one packed value.
ROWS_GATHERED, ROWS_PACKED = 262_144, 4_096
#: Values of up to ``ROWS_PACKED`` rows that go to Python at once.
BATCH, VALUES_AT_ONCE = "spark.sql.execution.arrow.maxRecordsPerBatch", "256"


class Predecessors(StatefulProcessor):
    """Adds predecessors to rows newer than the state; rows that are not newer are marked late.

    ``depth`` names the columns and how many predecessors of each are wanted; ``kept`` is the schema
    of what the state holds of a row: its time and those columns.
    """

    def __init__(self, spec: ChangeSpec, base: Sequence[str], kept: str, silent_ms: int | None):
        self.spec, self.base, self.kept, self.silent_ms = spec, list(base), kept, silent_ms
        self.depth = [(n, i, d) for i, (n, d) in enumerate(spec.depth.items(), start=1)]
        self.names = [*self.base, _AT, *[f"prev_{n}_{i}" for n, d in spec.depth.items() for i in range(1, d + 1)], _KIND]
        self.order = [*spec.tiebreak, *[c for c in self.base if c not in spec.tiebreak]]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.recent = handle.getListState("recent", self.kept)
        self.timer = handle.getValueState("timer", "at long")
        self.row = Row(*self.names)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        new = sorted(rows, key=itemgetter(_AT))
        arrived = max(r[_ARRIVED_MS] for r in new) if self.silent_ms is not None else None
        new = self.one_per_time(new)
        recent = [tuple(r) for r in self.recent.get()]
        since = recent[-1][0] if recent else None
        series = recent[-self.spec.lookback :]
        for row in new:
            at, own = row[_AT], [row[c] for c in self.base]
            if since is not None and at <= since:
                yield self.row(*own, at, *[None] * sum(d for *_, d in self.depth), LATE)
                continue
            previous = [series[-i][place] if i <= len(series) else None for _, place, d in self.depth for i in range(1, d + 1)]
            series = [*series, (at, *[row[n] for n, *_ in self.depth])][-self.spec.lookback :]
            yield self.row(*own, at, *previous, ON_TIME)
        if series and series[-1][0] != since:
            self.recent.put(series)
        if arrived is not None:
            self.wait(arrived + self.silent_ms)

    def one_per_time(self, rows: list[Row]) -> list[Row]:
        """Of copies of a key the smallest row, by the tie-break and then all columns."""
        if len({r[_AT] for r in rows}) == len(rows):
            return rows
        found = []
        for _, copies in groupby(rows, itemgetter(_AT)):
            found.append(min(copies, key=lambda r: [(r[c] is not None, r[c]) for c in self.order]))
        return found

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        """Tell once that the series has fallen silent; its state stays, so nothing is lost when it returns."""
        self.timer.clear()
        recent = [tuple(r) for r in self.recent.get()]
        known = dict(zip(self.spec.entity, key, strict=True)) | {_AT: recent[-1][0] if recent else None, _KIND: SILENT}
        yield self.row(*[known.get(n) for n in self.names])

    def wait(self, at: int) -> None:
        if self.timer.exists():
            self.handle.deleteTimer(self.timer.get()[0])
        self.handle.registerTimer(at)
        self.timer.update((at,))

    def close(self) -> None:
        pass


class PredecessorsByPart(Predecessors):
    """The same for all series of a part at once, without a clock of silence. Rows come and go packed; the
    state holds the newest rows of the part's series, packed into one value."""

    def __init__(self, spec: ChangeSpec, base: Sequence[str]):
        super().__init__(spec, base, "", None)
        self.held = list(dict.fromkeys([*spec.entity, _AT, *spec.depth]))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.recent = handle.getValueState("recent", f"{_ROWS} binary")
        self.row = Row(_ROWS)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        new = unpack([r[_ROWS] for r in rows])
        known = self.recent.get()
        found, kept = self.found(new, new.select(self.held).slice(0, 0) if known is None else unpack([known[0]]))
        if kept is not None:
            self.recent.update((pack(kept),))
        for start in range(0, found.num_rows, ROWS_PACKED):
            yield self.row(pack(found.slice(start, ROWS_PACKED)))

    def found(self, new: pa.Table, kept: pa.Table) -> tuple[pa.Table, pa.Table | None]:
        """The new rows with their predecessors, and what to keep from now on, ``None`` if nothing changes."""
        series = numbered(joined([kept.select(self.spec.entity), new.select(self.spec.entity)]))
        before, own = series[: kept.num_rows], series[kept.num_rows :]
        new, own = self.first_of_copies(new, own)
        at = new[_AT].to_numpy()
        since = np.full(series.max() + 1, np.iinfo(np.int64).min)
        np.maximum.at(since, before, kept[_AT].to_numpy())
        late = np.isin(own, before) & (at <= since[own])
        on_time = np.flatnonzero(~late)

        # kept rows and rows on time, series by series; the latter stand in the order they have in new
        held = joined([kept.select(self.held), new.select(self.held).take(on_time)])
        series = np.concatenate([before, own[on_time]])
        order = np.lexsort((held[_AT].to_numpy(), series))
        held, series = held.take(order).combine_chunks(), series[order]
        starts = np.flatnonzero(changes(series))
        sizes = np.diff([*starts, len(series)])
        place = np.arange(len(series))
        since_start = place - np.repeat(starts, sizes)
        places = np.flatnonzero(order >= kept.num_rows)

        out = {c: new[c] for c in [*self.base, _AT]}
        for name, _, depth in self.depth:
            for i in range(1, depth + 1):
                source, none = np.zeros(len(own), np.int64), np.ones(len(own), bool)
                source[on_time], none[on_time] = places - i, since_start[places] < i
                out[f"prev_{name}_{i}"] = held[name].take(pa.array(source, mask=none))
        out[_KIND] = pa.array(np.where(late, LATE, ON_TIME), pa.string())
        keep = np.repeat(starts + sizes, sizes) - place <= self.spec.lookback
        return pa.table(out).select(self.names), held.filter(pa.array(keep)) if len(on_time) else None

    def first_of_copies(self, rows: pa.Table, series: np.ndarray) -> tuple[pa.Table, np.ndarray]:
        """Rows by series and time; of copies of a key the smallest row, by the tie-break and then all columns."""
        at = rows[_AT].to_numpy()
        order = np.lexsort((at, series))
        rows, series, at = rows.take(order), series[order], at[order]
        key = np.cumsum(changes(series) | changes(at))
        copied = np.flatnonzero(np.bincount(key)[key] > 1)
        if not len(copied):
            return rows, series
        by = [c for c in self.order if c not in self.spec.entity]
        copies = pa.table({_COPIES: key[copied], **{c: ordered(rows[c].take(copied)) for c in by}})
        sorted_ = pc.sort_indices(copies, [(c, "ascending") for c in copies.column_names], null_placement="at_start").to_numpy()
        first = copied[sorted_[changes(key[copied[sorted_]])]]
        kept = np.sort(np.concatenate([np.delete(np.arange(len(key)), copied), first]))
        return rows.take(kept), series[kept]


def changes(values: np.ndarray) -> np.ndarray:
    """Where a value differs from the one before it; the first one does."""
    return np.concatenate([np.ones(min(len(values), 1), bool), values[1:] != values[:-1]])


def numbered(keys: pa.Table) -> np.ndarray:
    """Every row's key as a number, from 0."""
    number = np.zeros(keys.num_rows, np.int64)
    for column in keys.columns:
        values = pc.add(column, 0.0) if pa.types.is_floating(column.type) else column  # -0.0 is 0.0
        own = values.dictionary_encode("encode").combine_chunks()
        codes = own.indices.to_numpy().astype(np.int64)
        number = np.unique(number * len(own.dictionary) + codes, return_inverse=True)[1]
    return number


def ordered(column: pa.ChunkedArray) -> pa.ChunkedArray | pa.Array:
    """A column that can be sorted; nested values become their ranks."""
    if not pa.types.is_nested(column.type):
        return column
    values = column.to_pylist()
    try:
        known = sorted(v for v in values if v is not None)
    except TypeError:  # no order of their own
        values = [None if v is None else repr(v) for v in values]
        known = sorted(v for v in values if v is not None)
    return pa.array([None if v is None else bisect_left(known, v) for v in values], pa.int64())


def pack(rows: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as out:
        out.write_table(rows)
    return sink.getvalue().to_pybytes()


def unpack(values: Sequence[bytes]) -> pa.Table:
    return joined([pa.ipc.open_stream(v).read_all() for v in values]).combine_chunks()


def joined(tables: Sequence[pa.Table]) -> pa.Table:
    return pa.concat_tables(tables, promote_options="default")  # a column may be nullable in some only


def packed_by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of every part as packed values of a few thousand rows at most."""
    waiting, rows = [], 0
    for batch in batches:
        waiting.append(batch)
        rows += batch.num_rows
        if rows >= ROWS_GATHERED:
            yield dealt(pa.Table.from_batches(waiting))
            waiting, rows = [], 0
    if rows:
        yield dealt(pa.Table.from_batches(waiting))


def dealt(rows: pa.Table) -> pa.RecordBatch:
    part = rows[_PART].to_numpy()
    order = np.argsort(part, kind="stable")
    rows, part = rows.drop_columns(_PART).take(order).combine_chunks(), part[order]
    starts = np.flatnonzero(changes(part))
    cuts = [
        (start, min(start + ROWS_PACKED, end))
        for first, end in zip(starts, [*starts[1:], len(part)], strict=True) for start in range(first, end, ROWS_PACKED)
    ]
    values = pa.array([pack(rows.slice(start, end - start)) for start, end in cuts], pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(part[[start for start, _ in cuts]], pa.int32()), values], [_PART, _ROWS])


def rows_of_packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for value in batch.column(0):
            yield from pa.ipc.open_stream(value.as_buffer())


def with_predecessors(rows: DataFrame, spec: ChangeSpec, base: Sequence[str], silent_after: dt.timedelta | None = None) -> DataFrame:
    """Streaming rows with the ``prev_*`` columns of their predecessors, the kind of row in ``row_kind`` and
    its time in microseconds in ``at_micros``."""
    types = {f.name: f.dataType for f in rows.schema}
    # the state holds whole numbers as text
    passed = {c: T.StringType() if isinstance(types[c], T.IntegralType) else types[c] for c in base}
    # the time travels as a number, which Python reads many times faster than a timestamp
    as_number = isinstance(types[spec.time], (T.TimestampType, T.TimestampNTZType))
    carried = [c for c in base if not (as_number and c == spec.time)]

    def known(name: str) -> Column:
        column = F.col(name).cast(passed[name])
        return F.when(~F.isnan(name), column) if isinstance(types[name], (T.DoubleType, T.FloatType)) else column

    at = micros(F.col(spec.time))
    rows = rows.select(*[known(c).alias(c) for c in carried], at.alias(_AT))
    previous = {f"prev_{n}_{i}": n for n, depth in spec.depth.items() for i in range(1, depth + 1)}
    output = T.StructType(
        [T.StructField(c, passed[c]) for c in carried] + [T.StructField(_AT, T.LongType())]
        + [T.StructField(p, passed[n]) for p, n in previous.items()] + [T.StructField(_KIND, T.StringType())]
    )
    if silent_after is None:
        part = F.pmod(F.xxhash64(*spec.entity), F.lit(PARTS)).cast("int")
        packed = rows.withColumn(_PART, part).mapInArrow(packed_by_part, f"{_PART} int, {_ROWS} binary")
        found = packed.groupBy(_PART).transformWithState(
            PredecessorsByPart(spec, carried), f"{_ROWS} binary", "Append", "None"
        ).mapInArrow(rows_of_packed, output)
    else:
        kept = ", ".join([f"{_AT} long", *(f"`{c}` {passed[c].simpleString()}" for c in spec.depth)])
        silent = int(silent_after.total_seconds() * 1000)
        # The clock of silence is arrival. A watermark over poll times would drop late rows.
        rows = rows.withColumn(_ARRIVED, F.current_timestamp()).withWatermark(_ARRIVED, "0 seconds")
        rows = rows.withColumn(_ARRIVED_MS, F.unix_millis(_ARRIVED))
        found = rows.groupBy(*spec.entity).transformWithState(
            Predecessors(spec, carried, kept, silent), output, "Append", "EventTime"
        )
    own = {**{c: c for c in carried}, **previous}
    typed = found.withColumns({c: F.col(c).cast(types[n]) for c, n in own.items() if passed[n] != types[n]})
    return typed.withColumn(spec.time, F.timestamp_micros(_AT).cast(types[spec.time])) if as_number else typed


def stream_features_stateful(
    arrivals: DataFrame,
    target: FeedTable,
    late: FeedTable,
    spec: ChangeSpec,
    columns: Sequence[str],
    checkpoint: str,
    domain: tuple[str, str] | None = None,
    silent: FeedTable | None = None,
    silent_after: dt.timedelta | None = None,
) -> StreamingQuery:
    """Features of all that has arrived, into ``target``, then stop; a restart goes on where it stopped.

    Rows that are not newer than their series' state are set aside in ``late``, once per key and
    without features, for :func:`~pollpipe.plans.repair_late_rows` or to be counted. With
    ``silent_after``, a series of which nothing arrives for that long, while others do, gets one row
    in ``silent`` (its key and its last time). Copies of a key are reduced to one. Rows without a complete key are left to the silver load.
    All rows of one part of the series in one batch are sorted in one task: bound a batch by
    ``maxFilesPerTrigger`` on the source.
    """
    if (silent is None) != (silent_after is None):
        raise ValueError("silent and silent_after belong together")
    key = [*spec.entity, spec.time]
    base = [c for c in columns if c not in spec.feature_names]
    if domain is not None:
        arrivals = arrivals.where(F.col(domain[0]) == F.lit(domain[1]))
    arrivals, _ = split_null_keys(arrivals, key)
    kinds = with_predecessors(arrivals, spec, base, silent_after)

    def store(batch: DataFrame, _batch_id: int) -> None:
        here = lambda table: replace(table, spark=batch.sparkSession)
        rows = written(batch, "stateful")  # the stateful operator must run once per batch
        counts = {r[0]: r[1] for r in rows.groupBy(_KIND).count().collect()}
        if counts.get(ON_TIME):
            featured = add_features(rows.where(F.col(_KIND) == ON_TIME), spec).select(*columns)
            insert_into(here(target), one_per_key(featured, key, spec.tiebreak), key)
        if counts.get(LATE):
            aside = one_per_key(rows.where(F.col(_KIND) == LATE).select(*base), key, spec.tiebreak)
            insert_into(here(late), aside, key)
        if counts.get(SILENT):
            last = F.timestamp_micros(_AT).alias(spec.time)
            insert_into(here(silent), rows.where(F.col(_KIND) == SILENT).select(*spec.entity, last), key)

    session = arrivals.sparkSession
    at_once = VALUES_AT_ONCE if silent_after is None else session.conf.get(BATCH)
    with setting(session, PROVIDER, ROCKSDB), setting(session, BATCH, at_once):
        return (
            kinds.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
