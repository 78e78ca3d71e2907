"""Features from keyed streaming state."""

import datetime as dt
import random

import pyarrow as pa
import pytest
from pyspark.sql import Row

from pollpipe.operators import ChangeSpec, change_features
from pollpipe.sources import FeedTable
from pollpipe.streaming import stream_features_stateful
from pollpipe.streaming.stateful import PARTS, Predecessors, PredecessorsByPart, pack, unpack

START = dt.datetime(2024, 1, 1)
SCHEMA = "s string, t timestamp, v double, w bigint, note string"
SPEC = ChangeSpec(("s",), "t", "v", "v_change", 0.5, changes=(("w", "w_change"),), lookback=3)
COLUMNS = ("s", "t", "v", "w", "v_change", "is_large_move", "is_frozen", "w_change")


def frame(spark, rows):
    return spark.createDataFrame([(s, START + dt.timedelta(hours=h), v, w, "x") for s, h, v, w in rows], SCHEMA)


class Run:
    def __init__(self, spark, tmp_path, **options):
        self.spark, self.root, self.options = spark, str(tmp_path), options
        self.gold, self.late, self.silent = (FeedTable(spark, f"{self.root}/{n}", "t") for n in ("gold", "late", "silent"))

    def load(self, rows, **options):
        frame(self.spark, rows).coalesce(2).write.mode("append").parquet(f"{self.root}/in")
        source = self.spark.readStream.schema(frame(self.spark, []).schema).parquet(f"{self.root}/in")
        stream_features_stateful(
            source, self.gold, self.late, SPEC, COLUMNS, f"{self.root}/progress", **self.options
        ).awaitTermination()

    def found(self):
        return sorted(map(str, self.gold.read().select(*COLUMNS).collect()))


def full(spark, rows):
    return sorted(map(str, change_features(frame(spark, rows), SPEC, None).select(*COLUMNS).collect()))


def test_three_batches_and_restarts_equal_a_full_computation(spark, tmp_path):
    rng = random.Random(3)
    keys = sorted({(rng.choice("abcd"), rng.choice([0, 1000, 2000]) + rng.randrange(40)) for _ in range(160)})
    rows = [(s, h, rng.choice([None, 1.0, 1.0, 1.0, 2.5]), rng.choice([None, 1, 7])) for s, h in keys]
    run = Run(spark, tmp_path)
    for start in (0, 1000, 2000):
        part = [r for r in rows if start <= r[1] < start + 1000]
        run.load(part + part[:3])  # some copies
    assert run.found() == full(spark, rows)
    assert not run.late.exists()


def test_late_rows_are_set_aside_once(spark, tmp_path):
    run = Run(spark, tmp_path)
    run.load([("a", 5, 1.0, 1), ("a", 6, 2.0, 2)])
    run.load([("a", 4, 9.0, 9), ("a", 7, 2.0, 3), ("b", 1, 1.0, 1), ("a", 4, 9.0, 9), (None, 9, 1.0, 1)])
    assert run.found() == full(spark, [("a", 5, 1.0, 1), ("a", 6, 2.0, 2), ("a", 7, 2.0, 3), ("b", 1, 1.0, 1)])
    assert [(r.s, r.v) for r in run.late.read().collect()] == [("a", 9.0)]


def test_silent_series_are_told_and_keep_their_state(spark, tmp_path):
    run = Run(spark, tmp_path, silent_after=dt.timedelta(milliseconds=1))
    run.options["silent"] = run.silent
    run.load([("a", 1, 1.0, 1), ("a", 2, 1.0, 1), ("a", 3, 1.0, 1)])
    run.load([("b", 9, 1.0, 1)])
    run.load([("a", 5000, 1.0, 1)])
    told = {(r.s, r.t) for r in run.silent.read().collect()}
    assert ("a", START + dt.timedelta(hours=3)) in told
    assert run.found() == full(spark, [("a", 1, 1.0, 1), ("a", 2, 1.0, 1), ("a", 3, 1.0, 1), ("a", 5000, 1.0, 1), ("b", 9, 1.0, 1)])


def test_silence_needs_a_table_for_it(spark, tmp_path):
    run = Run(spark, tmp_path, silent_after=dt.timedelta(hours=1))
    with pytest.raises(ValueError):
        run.load([("a", 1, 1.0, 1)])


class Kept:
    """A state variable without a stream."""

    def __init__(self, rows):
        self.rows, self.puts = rows, 0

    def get(self):
        return iter(self.rows)

    def put(self, rows):
        self.rows, self.puts = rows, self.puts + 1

    def getListState(self, name, schema):
        return self

    def getValueState(self, name, schema):
        return None


def test_a_series_is_worked_on_row_by_row():
    state = Kept([(1, 1.0, None), (2, 2.0, "7")])
    processor = Predecessors(SPEC, ["s", "v", "w"], "", None)
    processor.init(state)
    new = [Row(s="a", v=v, w=w, at_micros=at) for at, v, w in [(5, 4.0, "2"), (2, 9.0, "1"), (4, 3.0, "5"), (4, 3.0, "3")]]
    found = [r.asDict() for r in processor.handleInputRows(("a",), iter(new), None)]
    assert [(r["at_micros"], r["row_kind"], r["w"]) for r in found] == [(2, "late", "1"), (4, "on_time", "3"), (5, "on_time", "2")]
    assert [tuple(r[f"prev_v_{i}"] for i in (1, 2, 3)) for r in found] == [(None, None, None), (2.0, 1.0, None), (3.0, 2.0, 1.0)]
    assert [r["prev_w_1"] for r in found] == [None, "7", "3"]
    assert state.rows == [(2, 2.0, "7"), (4, 3.0, "3"), (5, 4.0, "2")] and state.puts == 1
    assert [r["row_kind"] for r in processor.handleInputRows(("a",), iter(new[1:2]), None)] == ["late"] and state.puts == 1


KEYS = ChangeSpec(("s", "u"), "t", "v", "v_change", 0.5, changes=(("w", "w_change"),), lookback=3, tiebreak=("n",))
LAYOUT = pa.schema([
    ("s", pa.string()), ("u", pa.float64()), ("n", pa.string()), ("v", pa.float64()), ("w", pa.string()),
    ("b", pa.bool_()), ("l", pa.list_(pa.int64())), ("at_micros", pa.int64()),
])


def test_all_series_of_a_part_at_once_equal_them_row_by_row():
    rng = random.Random(11)
    base = LAYOUT.names[:-1]
    together, part, alone = PredecessorsByPart(KEYS, base), None, {}
    kinds = set()
    for number in range(12):
        span = rng.choice([4, 40, 4000])
        rows = [
            (rng.choice("abc"), rng.choice([1.0, 2.5]), rng.choice([None, "", "x", "y", "\u00e9"]), rng.choice([None, 1.0, -2.0, 3.5]),
             rng.choice([None, "7", "10"]), rng.choice([None, True, False]), rng.choice([None, [], [1, 2], [2]]),
             rng.choice([number * 20, 0]) + rng.randrange(span))
            for _ in range(rng.choice([1, 5, 120]))
        ]
        table = pa.Table.from_pylist([dict(zip(LAYOUT.names, r, strict=True)) for r in rows], LAYOUT)
        new = unpack([pack(table.slice(0, 3)), pack(table.slice(3))])
        found, kept = together.found(new, new.select(together.held).slice(0, 0) if part is None else unpack([part]))
        before, part = part, part if kept is None else pack(kept)
        expected = []
        for key in sorted({r[:2] for r in rows}):
            state = alone.setdefault(key, Kept([]))
            processor = Predecessors(KEYS, base, "", None)
            processor.init(state)
            own = [Row(*LAYOUT.names)(*r) for r in rows if r[:2] == key]
            expected += [r.asDict() for r in processor.handleInputRows(key, iter(own), None)]
        assert sorted(map(str, found.to_pylist())) == sorted(map(str, expected))
        held = sorted((r["s"], r["u"], r["at_micros"], r["v"], r["w"]) for r in unpack([part]).to_pylist())
        assert str(held) == str(sorted((*key, *row) for key, state in alone.items() for row in state.rows))
        assert (kept is None) == all(r["row_kind"] == "late" for r in expected) and (kept is not None or part == before)
        kinds |= {r["row_kind"] for r in expected}
    assert kinds == {"late", "on_time"}


def test_many_series_share_a_state_of_the_store(spark, tmp_path):
    run, series = Run(spark, tmp_path), 3 * PARTS
    run.load([(f"s{i}", h, float(i), i) for i in range(series) for h in (1, 2)])
    run.load([(f"s{i}", 3, i + 1.0, i) for i in range(series)] + [("s7", 2, 5.0, 5)])
    states = spark.read.format("statestore").option("stateVarName", "recent").load(f"{run.root}/progress").count()
    assert PARTS / 2 < states <= PARTS
    last = run.gold.read().where("v_change = 1 AND w_change = 0 AND is_large_move").count()
    assert (last, run.gold.read().count(), run.late.read().count()) == (series, 3 * series, 1)
