"""Previous values: the cut computations equal the plain window, whatever the skew."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from pollpipe.operators import ChangeSpec, Cut, change_features, choose_cut, latest_rows, with_previous
from pollpipe.operators.lags import SECOND

START = dt.datetime(2024, 1, 1)
SCHEMA = "id bigint, series string, t timestamp, v double, w double"
DAY, HOUR = 86_400 * SECOND, 3_600 * SECOND


def skewed(spark, n=3000, seed=1):
    """One series holds a third of the rows, some values are missing, there are gaps."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        series = "hot" if rng.random() < 0.34 else f"s{rng.randrange(200)}"
        offset = rng.choice([rng.randrange(86_400), rng.randrange(20 * 86_400)])
        v = None if rng.random() < 0.1 else float(rng.randrange(3))
        rows.append((i, series, START + dt.timedelta(seconds=offset), v, float(rng.randrange(100))))
    return spark.createDataFrame(rows, SCHEMA).repartition(8)


def collected(df):
    columns = sorted(df.columns)
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


@pytest.mark.parametrize("slicing", [30 * DAY, DAY, HOUR, SECOND, "range", "auto"])
def test_cuts_equal_the_plain_window(spark, slicing):
    df = skewed(spark)
    args = (["series"], "t", {"v": 5, "w": 2}, ["id"])
    plain = with_previous(df, *args, slicing=None)
    assert collected(with_previous(df, *args, slicing=slicing, rows_per_task=200)) == collected(plain)


def test_plain_window_against_python(spark):
    df = skewed(spark, 500)
    seen = {}
    expected = {}
    for r in sorted(df.collect(), key=lambda r: (r.t, r.id)):
        before = seen.setdefault(r.series, [])
        expected[r.id] = [before[-i] if len(before) >= i else None for i in (1, 2, 3)]
        before.append(r.v)
    got = with_previous(df, ["series"], "t", {"v": 3}, ["id"], slicing=DAY)
    assert {r.id: [r.prev_v_1, r.prev_v_2, r.prev_v_3] for r in got.collect()} == expected


def test_copies_at_one_instant(spark):
    """A third of the rows are copies of one key: only ranges can split them."""
    rows = [(1, "hot", START, 1.0, 1.0)] * 400
    rows += [(i, f"s{i % 50}", START + dt.timedelta(seconds=i), float(i % 2), 1.0) for i in range(800)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert choose_cut(df, ["series"], "t", 2, rows_per_task=100) == Cut("range", (("hot",),))
    got = with_previous(df, ["series"], "t", {"v": 2}, ["id"], rows_per_task=100)
    plain = with_previous(df, ["series"], "t", {"v": 2}, ["id"], slicing=None)
    assert collected(got) == collected(plain)
    assert got.where("series = 'hot' and prev_v_2 is null").count() == 2


def test_width_follows_the_largest_series(spark):
    rows = [(i, "a", START + dt.timedelta(hours=i), 1.0, 1.0) for i in range(2400)]
    df = spark.createDataFrame(rows, SCHEMA)
    cut = lambda n: choose_cut(df, ["series"], "t", 1, rows_per_task=n)
    assert cut(5000) is None
    assert cut(1000) == Cut(30 * DAY, (("a",),))
    assert cut(250) == Cut(DAY, (("a",),))
    # one-hour slices would make every row an edge of the one series
    assert cut(20) == Cut("range", (("a",),))
    assert choose_cut(df.limit(0), ["series"], "t") is None


@pytest.mark.parametrize("width", [DAY, "range"])
def test_only_heavy_series_are_cut(spark, width):
    """The NULL series is heavy, the others go through in one piece."""
    df = skewed(spark).withColumn("series", F.when(F.col("series") != "hot", F.col("series")))
    plain = with_previous(df, ["series"], "t", {"v": 5}, ["id"], slicing=None)
    got = with_previous(df, ["series"], "t", {"v": 5}, ["id"], slicing=Cut(width, ((None,),)), rows_per_task=200)
    assert collected(got) == collected(plain)
    auto = choose_cut(df, ["series"], "t", 5, rows_per_task=300)
    assert auto.heavy == ((None,),)


@pytest.mark.parametrize("cut", [DAY, Cut(DAY, (("hot",),))])
def test_sliced_plan_reads_one_shuffle_and_keeps_codegen(spark, cut):
    df = skewed(spark)
    frame = with_previous(df, ["series"], "t", {"v": 5}, ["id"], slicing=cut)
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in plan
    assert "Python" not in plan


def test_latest_rows_limits_before_the_shuffle(spark):
    df = skewed(spark)
    frame = latest_rows(df, ["series"], "t", 3, ["id"])
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    by_series = {}
    for r in sorted(df.collect(), key=lambda r: (r.t, r.id)):
        by_series.setdefault(r.series, []).append(r.id)
    got = {}
    for r in frame.collect():
        got.setdefault(r.series, set()).add(r.id)
    assert got == {s: set(ids[-3:]) for s, ids in by_series.items()}


def test_features_of_a_sequence(spark):
    spec = ChangeSpec(("series",), "t", "v", "v_change", 0.5, (("w", "w_change"),), lookback=2)
    values = [1.0, 1.0, 1.0, None, 1.0, 2.0, 2.0, 2.0]
    rows = [(i, "a", START + dt.timedelta(minutes=i), v, float(i * i)) for i, v in enumerate(values)]
    got = change_features(spark.createDataFrame(rows, SCHEMA), spec).orderBy("t").collect()
    assert [r.v_change for r in got] == [None, 0.0, 0.0, None, None, 1.0, 0.0, 0.0]
    assert [r.is_large_move for r in got] == [None, False, False, None, None, True, False, False]
    assert [r.is_frozen for r in got] == [None, None, True, None, None, None, False, True]
    assert [r.w_change for r in got] == [None, 1.0, 3.0, 5.0, 7.0, 9.0, 11.0, 13.0]


def test_lookback_must_be_positive(spark):
    with pytest.raises(ValueError):
        ChangeSpec(("s",), "t", "v", "c", 1.0, lookback=0)
    with pytest.raises(ValueError):
        with_previous(skewed(spark, 5), ["series"], "t", {})
