"""Daily partials against plain versions of the questions, and what a refresh computes again."""

import datetime as dt
import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pollpipe.operators import merged_summary, percentile, value_summary
from pollpipe.plans import DayPartials, PartialSpec
from pollpipe.plans import partials as ask
from pollpipe.sources import FeedTable

START = dt.datetime(2024, 1, 1)
SCHEMA = "s string, t timestamp, x double, y double, f boolean, extra string"
SPEC = PartialSpec(measures=("x",), flags=("f",), pairs=(("x", "y"),), calibrated=("x",))


def some_rows(seed, n=200, days=4):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        s = rng.choice(["a", "b", "c", None])
        t = START + dt.timedelta(minutes=rng.randrange(days * 1440))
        x = 0.1 if s == "c" else rng.choice([None, rng.gauss(1e6, 1)])
        rows.append((s, t, x, rng.choice([None, rng.random()]), rng.choice([None, True, False]), "clash"))
    return [*rows, ("a", None, 5.0, 5.0, True, "untimed")]


def setup(spark, tmp_path, rows):
    table = FeedTable(spark, str(tmp_path / "table"), "t", ("s",))
    table.append(spark.createDataFrame(rows, SCHEMA))
    return table, DayPartials(table, str(tmp_path / "partials"), ("s",), SPEC)


def day(n):
    return (START + dt.timedelta(days=n)).date()


@pytest.mark.parametrize("since", [None, START + dt.timedelta(hours=31), START + dt.timedelta(days=2)])
def test_questions_equal_the_plain_version(spark, tmp_path, since):
    rows = some_rows(3)
    _, partials = setup(spark, tmp_path, rows)
    assert partials.refresh() == [day(i) for i in range(4)]
    states = partials.states(since)
    own = defaultdict(list)
    for r in rows:
        if r[1] is not None and (since is None or r[1] >= since):
            own[r[0]].append(r)

    means = {r.s: r.m for r in ask.average_of_states(states, ["s"], "x", name="m").collect()}
    largest = {r.s: r.largest_move for r in ask.largest_of_states(states, ["s"], "x").collect()}
    counts = {r.s: (r.n, r.last_seen_at) for r in ask.rows_of_states(states, ["s"]).collect()}
    flagged = {r.s: (r.large_move_count, r.last_large_move_at) for r in ask.flagged_of_states(states, ["s"], "f").collect()}
    related = {r.s: (r.pairs, r.correlation) for r in ask.correlation_of_states(states, ["s"], "x", "y").collect()}
    above = {r.s for r in ask.groups_of_states_above(states, ["s"], "x", 10.0).collect()}
    assert above == {s for s in own if s != "c"}
    for s, group in own.items():
        xs = [r[2] for r in group if r[2] is not None]
        assert means[s] == pytest.approx(sum(xs) / len(xs), rel=1e-12) and largest[s] == max(map(abs, xs))
        assert counts[s] == (len(group), max(r[1] for r in group))
        hits = [r[1] for r in group if r[4]]
        assert flagged.get(s) == ((len(hits), max(hits)) if hits else None)
        both = [(r[2], r[3]) for r in group if r[2] is not None and r[3] is not None]
        n, value = related[s]
        assert n == len(both)
        if s == "c":  # constant on one side
            assert value is None
        else:
            assert value == pytest.approx(float(np.corrcoef(np.array(both).T)[0, 1]), abs=1e-9)
    assert ask.series_seen(partials.sketches(since)).first().series == len(own)


def test_only_dirty_days_are_computed(spark, tmp_path):
    table, partials = setup(spark, tmp_path, some_rows(5))
    partials.refresh()
    assert partials.refresh() == [] and partials.dirty() == []
    before = partials.kept()
    table.append(spark.createDataFrame([("late", START + dt.timedelta(days=1, hours=1), 1.0, 1.0, True, "")], SCHEMA))
    assert partials.dirty() == [day(1)]
    with pytest.raises(ValueError, match="refresh first"):
        partials.threshold("x", 0.5)
    assert not partials.states().where("s = 'late'").count()
    assert partials.refresh() == [day(1)]
    after = partials.kept()
    assert {d for d in after if after[d] != before[d]} == {day(1)}
    assert [r.rows for r in partials.states().where("s = 'late'").collect()] == [1]
    # the day is replaced without the late row
    table.replace_dates(table.read(dates=[day(1)]).where("s <> 'late' or s is null"))
    assert partials.refresh() == [day(1)] and not partials.states().where("s = 'late'").count()


def test_a_refresh_that_dies_is_not_seen_and_is_repeated(spark, tmp_path, monkeypatch):
    table, partials = setup(spark, tmp_path, some_rows(6))
    partials.refresh()
    seen = sorted(partials.states().select("day", "s", "rows").collect(), key=repr)
    table.append(spark.createDataFrame([("new", START, 1.0, 1.0, None, "")], SCHEMA))
    with monkeypatch.context() as broken:
        broken.setattr(DayPartials, "_sketches", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            partials.refresh()
    assert sorted(partials.states().select("day", "s", "rows").collect(), key=repr) == seen
    assert partials.refresh() == [day(0)] and partials.states().where("s = 'new'").count() == 1


def test_windows_without_rows(spark, tmp_path):
    table, partials = setup(spark, tmp_path, [("a", START, float("nan"), None, None, "")])
    assert partials.states().count() == 0 and partials.kept() == {}  # nothing is kept before the first refresh
    partials.refresh()
    late = START + dt.timedelta(days=9, hours=3)
    assert partials.states(late).count() == 0 and ask.series_seen(partials.sketches(late)).first().series == 0
    found = partials.threshold("x", 0.5)
    assert (found.value, found.counted, found.missing, found.not_finite) == (None, 0, 0, 1)
    assert tuple(ask.series_in_both(partials.sketches(), partials.sketches(late)).first()) == (1, 0, 1, 0)


def test_threshold_over_a_window(spark, tmp_path):
    rows = some_rows(8, n=400)
    _, partials = setup(spark, tmp_path, rows)
    partials.refresh()
    since = START + dt.timedelta(hours=20)
    inside = [r for r in rows if r[1] is not None and r[1] >= since]
    values = [abs(r[2]) for r in inside if r[2] is not None]
    found = partials.threshold("x", 0.9, since)
    assert found.value == pytest.approx(float(np.quantile(values, 0.9)), rel=1e-12)
    assert (found.counted, found.missing) == (len(values), len(inside) - len(values))


def test_series_in_both_windows(spark):
    def days(parts):
        frame = spark.createDataFrame([(d, v) for d, vs in parts.items() for v in vs], "day int, v long")
        return frame.groupBy("day").agg(F.theta_sketch_agg(F.xxhash64("v"), ask.SERIES_LG).alias("series"))

    first, second = days({1: range(900), 2: range(500, 1500)}), days({8: range(1200, 3000), 9: range(1000, 1300)})
    assert tuple(ask.series_in_both(first, second).first()) == (1500, 2000, 3000, 500)
    many, more = days({1: range(60_000)}), days({2: range(30_000, 120_000)})
    for got, exact in zip(ask.series_in_both(many, more).first(), (60_000, 90_000, 120_000, 30_000), strict=True):
        assert math.isclose(got, exact, rel_tol=0.05)


def test_wrong_brackets_are_widened(spark):
    """An exact value even where the sketch has its ranks wrong, on either side, among very many equal values."""
    values = [*map(float, range(3000)), *[7.0] * 3000, float("nan"), float("-inf"), None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    finite = [v for v in values[:-3]]
    for shift in (-0.4, 0.4):
        sketch = spark.createDataFrame([(v + shift * 3000,) for v in finite], "x double").agg(value_summary("x").alias("s"))
        true = df.agg(value_summary("x").alias("s"))
        mixed = true.crossJoin(sketch.select(F.col("s.sketch").alias("k"))).select(F.col("s").withField("sketch", F.col("k")).alias("s"))
        found = percentile(df, "x", 0.75, mixed, error=1e-4)
        assert found.value == pytest.approx(float(np.quantile(finite, 0.75)), rel=1e-12)
        assert (found.counted, found.missing, found.not_finite) == (6000, 1, 2)


def test_summaries_merge(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 7 > 0, F.col("id").cast("double")).alias("x"), (F.col("id") % 5).alias("part"))
    parts = df.groupBy("part").agg(value_summary("x").alias("s")).unionByName(df.limit(0).agg(F.lit(9).cast("long").alias("part"), value_summary("x").alias("s")))
    merged = parts.agg(merged_summary("s").alias("s"))
    assert percentile(df, "x", 0.31, merged, bins=8) == percentile(df, "x", 0.31)
