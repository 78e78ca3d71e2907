"""Loads by arrival and carried state."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from pollpipe.operators import ChangeSpec, change_features
from pollpipe.plans import SeriesState, SilverPlan, load_bronze, load_gold_carried, load_silver_arrived, reach
from pollpipe.plans.analytics import latest_values
from pollpipe.presets import perpetuals as preset
from pollpipe.sources import Arrivals, FeedTable
from pollpipe.sources import arrivals as arrivals_module

from test_polls import body, record

START = dt.datetime(2024, 1, 1)
SCHEMA = "s string, t timestamp, v double"
SPEC = ChangeSpec(("s",), "t", "v", "v_change", 0.5, lookback=2)
COLUMNS = ("s", "t", "v", "v_change", "is_large_move", "is_frozen")
PLAN = SilverPlan(preset.FEED, preset.derived_columns, preset.quality_rules)


def frame(spark, rows):
    return spark.createDataFrame([(s, START + dt.timedelta(hours=h), v) for s, h, v in rows], SCHEMA)


def polls(spark, times):
    rows = [(t, 200, body(record())) for t in times]
    return spark.createDataFrame(rows, "fetched_at string, status_code int, payload string")


def tables(spark, tmp_path, *names, time="t"):
    return [FeedTable(spark, str(tmp_path / n), time) for n in names]


def test_a_file_is_taken_once_and_only_after_its_commit(spark, tmp_path):
    (source,) = tables(spark, tmp_path, "source")
    feed = Arrivals(source, str(tmp_path / "log"))
    assert feed.next_batch() is None and feed.last() == 0
    source.append(frame(spark, [("a", 1, 1.0), ("a", 30, 2.0)]))
    first = feed.next_batch()
    assert first.number == 1 and first.dates == [START.date(), START.date() + dt.timedelta(days=1)]
    assert feed.next_batch() == first  # nothing is committed yet
    feed.commit(first)
    assert feed.next_batch() is None and feed.last() == 1
    source.append(frame(spark, [("a", -900, 3.0)]))
    second = feed.next_batch()
    assert [r.v for r in second.read().collect()] == [3.0] and second.number == 2
    # a batch of one file at a time takes the oldest first
    source.append(frame(spark, [("b", 2, 4.0)]))
    taken = []
    while batch := feed.next_batch(1):
        taken += [r.v for r in batch.read().collect()]
        feed.commit(batch)
    assert sorted(taken) == [3.0, 4.0] and feed.pending().count() == 0


def test_the_log_is_gathered_and_forgets_files_that_left(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(arrivals_module, "FOLD", 3)
    (source,) = tables(spark, tmp_path, "source")
    feed = Arrivals(source, str(tmp_path / "log"))
    for h in range(7):
        source.append(frame(spark, [("a", h, float(h))]))
        if h == 4:
            source.compact([START.date()])
        seen = []
        while batch := feed.next_batch():
            seen += [r.v for r in batch.read().collect()]
            feed.commit(batch)
        assert seen == ([float(i) for i in range(5)] if h == 4 else [float(h)]) or sorted(seen) == [float(i) for i in range(5)]
    assert feed.pending().count() == 0
    assert feed.taken().distinct().count() < 7


@pytest.mark.parametrize("named", [False, True])
def test_silver_takes_rows_of_any_age_and_reads_new_files_only(spark, tmp_path, named):
    location = "arrived_bronze" if named else str(tmp_path / "bronze")
    bronze = FeedTable(spark, location, "fetched_at")
    silver, unkeyed = tables(spark, tmp_path, "silver", "unkeyed", time="fetched_at")
    log = str(tmp_path / "log")
    iso = lambda d: (dt.datetime(2026, 3, 1, 12) + dt.timedelta(days=d)).isoformat() + "+00:00"
    load_bronze(polls(spark, [iso(0), iso(1), "no time"]), preset.FEED, bronze)
    added = load_silver_arrived(bronze, silver, PLAN, unkeyed, log)
    assert (added.rows, added.unkeyed) == (2, 1)
    load_bronze(polls(spark, [iso(-30), iso(1), iso(2), "no time"]), preset.FEED, bronze)
    batch = Arrivals(bronze, log).next_batch()
    assert batch.read().count() == 4  # not the first load's rows
    assert set(batch.dates) == {dt.date(2026, 1, 30), dt.date(2026, 3, 2), dt.date(2026, 3, 3), None}
    added = load_silver_arrived(bronze, silver, PLAN, unkeyed, log)
    assert (added.rows, added.unkeyed) == (2, 0)
    assert not load_silver_arrived(bronze, silver, PLAN, unkeyed, log)
    assert silver.read().count() == 4 and silver.newest().count() == 1


def test_a_load_that_died_before_its_commit_is_repeated_without_copies(spark, tmp_path, monkeypatch):
    bronze, silver, unkeyed = tables(spark, tmp_path, "bronze", "silver", "unkeyed", time="fetched_at")
    log = str(tmp_path / "log")
    load_bronze(polls(spark, ["2026-03-01T00:00:00+00:00", "no time"]), preset.FEED, bronze)

    def die(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(Arrivals, "commit", die)
        with pytest.raises(RuntimeError):
            load_silver_arrived(bronze, silver, PLAN, unkeyed, log)
    assert not load_silver_arrived(bronze, silver, PLAN, unkeyed, log)
    assert silver.read().count() == 1 and unkeyed.read().count() == 1
    assert Arrivals(bronze, log).next_batch() is None


def full(spark, rows):
    got = change_features(frame(spark, rows), SPEC, None).select(*COLUMNS)
    return sorted(map(str, got.collect()))


@pytest.mark.parametrize("seed", [1, 2])
def test_carried_loads_equal_a_full_computation(spark, tmp_path, seed):
    """Series silent for months, late rows of any age, late and new rows of a series in one load."""
    rng = random.Random(seed)
    keys = {(rng.choice("abcdef"), rng.choice([0, 3000, 6000]) + rng.randrange(60)) for _ in range(150)}
    rows = [(s, h, rng.choice([None, 1.0, 1.0, 2.0])) for s, h in sorted(keys)]
    loads = [[], [], [], []]
    for row in rows:
        loads[min(3, max(0, row[1] // 3000 + (rng.random() < 0.2) + (rng.random() < 0.05)))].append(row)
    source, target = tables(spark, tmp_path, "source", "target")
    state = SeriesState(spark, str(tmp_path / "state"), ("s",), "t")
    done = []
    for part in loads:
        if part:
            source.append(frame(spark, part + part[:2]))  # some copies
        result = load_gold_carried(source, target, SPEC, COLUMNS, state)
        assert result.on_time + result.late == len(set(part))
        done += part
        assert sorted(map(str, target.read().select(*COLUMNS).collect())) == full(spark, done)
        newest = latest_values(state.rows(source), ("s",), "t", ["v", "is_frozen"])
        wanted = latest_values(target.read(), ("s",), "t", ["v", "is_frozen"])
        assert sorted(map(str, newest.collect())) == sorted(map(str, wanted.collect()))
        per_series = state.rows(source).groupBy("s").count().agg(F.max("count")).first()[0]
        assert per_series <= SPEC.lookback
    assert load_gold_carried(source, target, SPEC, COLUMNS, state).files == 0


def test_an_on_time_load_reads_no_history(spark, tmp_path, monkeypatch):
    source, target = tables(spark, tmp_path, "source", "target")
    state = SeriesState(spark, str(tmp_path / "state"), ("s",), "t")
    source.append(frame(spark, [("a", 1, 1.0), ("a", 2, 1.0), ("b", 1, 1.0)]))
    load_gold_carried(source, target, SPEC, COLUMNS, state)
    source.append(frame(spark, [("a", 5000, 1.0), ("b", 5000, 9.0)]))
    read = []
    whole = FeedTable.read

    def watched(self, *args, **bounds):
        read.append((self.location, bounds))
        return whole(self, *args, **bounds)

    monkeypatch.setattr(FeedTable, "read", watched)
    load_gold_carried(source, target, SPEC, COLUMNS, state)
    new_date = (START + dt.timedelta(hours=5000)).date()
    assert read == [(target.location, {"dates": [new_date]})]  # the keys of the new date only
    monkeypatch.undo()
    found = {(r.s, r.v_change, r.is_frozen) for r in target.read(since=START + dt.timedelta(hours=4999)).collect()}
    assert found == {("a", 0.0, True), ("b", 8.0, None)}


@pytest.mark.parametrize("step", ["commit", "put"])
def test_a_carried_load_that_died_is_repeated(spark, tmp_path, monkeypatch, step):
    source, target = tables(spark, tmp_path, "source", "target")
    state = SeriesState(spark, str(tmp_path / "state"), ("s",), "t")
    first = [("a", h, float(h % 3)) for h in range(0, 20, 2)] + [("b", 1, 1.0)]
    second = [("a", 17, 5.0), ("a", 20, 1.0), ("a", 21, 1.0), ("b", -800, 2.0)]
    source.append(frame(spark, first))
    load_gold_carried(source, target, SPEC, COLUMNS, state)
    source.append(frame(spark, second))

    def die(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(*((Arrivals, "commit") if step == "commit" else (SeriesState, "put")), die)
        with pytest.raises(RuntimeError):
            load_gold_carried(source, target, SPEC, COLUMNS, state)
    load_gold_carried(source, target, SPEC, COLUMNS, state)
    assert sorted(map(str, target.read().select(*COLUMNS).collect())) == full(spark, first + second)
    assert {r.t for r in state.rows(source).where("s = 'a'").collect()} == {START + dt.timedelta(hours=h) for h in (20, 21)}


def test_a_target_filled_before_gives_the_first_state(spark, tmp_path):
    source, target = tables(spark, tmp_path, "source", "target")
    rows = [("a", h, 1.0) for h in range(4)]
    source.append(frame(spark, rows))
    target.append(change_features(frame(spark, rows), SPEC, None).select(*COLUMNS))
    state = SeriesState(spark, str(tmp_path / "state"), ("s",), "t")
    with pytest.raises(ValueError):
        state.rows(source)
    source.append(frame(spark, [("a", 9, 1.0)]))
    load_gold_carried(source, target, SPEC, COLUMNS, state)
    assert sorted(map(str, target.read().select(*COLUMNS).collect())) == full(spark, [*rows, ("a", 9, 1.0)])


def test_the_reach_of_late_rows_ends_at_their_neighbours(spark, tmp_path):
    (source,) = tables(spark, tmp_path, "source")
    day = 24
    source.append(frame(spark, [("a", h * day, 1.0) for h in range(0, 400)] + [("z", 0, 1.0), ("z", 100 * day, 1.0)]))
    moment = START + dt.timedelta(days=200)
    late = frame(spark, [("a", 200 * day, 1.0)])
    since, until = reach(source, late, SPEC, moment, moment)
    assert (moment - since).days <= 4 and (until - moment).days <= 4
    moment = START + dt.timedelta(days=100)
    since, until = reach(source, frame(spark, [("z", 100 * day, 1.0)]), SPEC, moment, moment)
    assert since == START and until >= START + dt.timedelta(days=399)


def test_columns_that_the_state_needs_are_asked_for(spark, tmp_path):
    source, target = tables(spark, tmp_path, "source", "target")
    with pytest.raises(ValueError):
        load_gold_carried(source, target, SPEC, ("s", "t", "v_change"), SeriesState(spark, str(tmp_path / "x"), ("s",), "t"))
