"""Derivations, quality rules and single-row change features."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pollpipe.functions import (
    change, is_frozen, is_large_move, minutes_between, quality_tags, rate_per_basis, rate_per_year, safe_corr,
    seconds_between, within_days,
)
from pollpipe.presets.perpetuals import LARGE_MOVE_THRESHOLD, quality_rules


def test_rates(spark):
    cases = [(0.0001, 8), (0.0000125, 1), (0.00005, 4), (-0.00003, 8), (0.0, 8), (None, 8), (0.0001, None), (0.0001, 0),
             (0.0001, -8), (None, None)]
    df = spark.createDataFrame(cases, "r double, h bigint")
    rows = df.select(rate_per_basis(F.col("r"), F.col("h")), rate_per_year(F.col("r"), F.col("h"))).collect()
    expected = [(r * 8.0 / h, r * (8760.0 / h)) if r is not None and h and h > 0 else (None, None) for r, h in cases]
    assert [tuple(r) for r in rows] == expected
    assert rows[0][0] == pytest.approx(0.0001) and rows[0][1] == pytest.approx(0.1095)


def test_lag(spark):
    at = dt.datetime
    cases = [(at(2026, 9, 18, 3, 40), at(2026, 9, 18, 3, 39), 60.0), (at(2026, 9, 18, 3, 39), at(2026, 9, 18, 3, 40), -60.0),
             (None, at(2026, 9, 18), None), (at(2026, 9, 18), None, None),
             (at(2026, 9, 18, 0, 0, 0, 729000), at(2026, 9, 18), 0.729)]
    df = spark.createDataFrame(cases, "a timestamp_ntz, b timestamp_ntz, e double")
    for row in df.select(seconds_between(F.col("a"), F.col("b")).alias("got"), "e").collect():
        assert row.got == row.e
    assert df.select(minutes_between(F.col("a"), F.col("b"))).first()[0] == 1.0


def test_window_of_days(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 1, 1),), (dt.datetime(2026, 1, 8),)], "t timestamp_ntz")
    as_of = F.lit(dt.datetime(2026, 1, 9)).cast("timestamp_ntz")
    assert [r[0] for r in df.select(within_days(F.col("t"), 7, as_of)).collect()] == [False, True]
    assert df.where(within_days(F.col("t"), 1)).count() == 0


BASE = {
    "rate": -0.0004, "interval_hours": 2, "mark_price": 412.75, "open_interest": 90210.5,
    "fetched_at": dt.datetime(2031, 3, 7, 11, 13), "updated_at": dt.datetime(2031, 3, 7, 11, 12),
    "next_funding_time": dt.datetime(2031, 3, 7, 12), "age_seconds": 60,
}
SCHEMA = ("rate double, interval_hours bigint, mark_price double, open_interest double, fetched_at timestamp, "
          "updated_at timestamp, next_funding_time timestamp, age_seconds bigint")
RULES = [
    ({}, []),
    ({"interval_hours": 0}, ["invalid_interval_hours"]),
    ({"age_seconds": -1}, ["invalid_age_seconds"]),
    ({"age_seconds": 0}, ["invalid_age_seconds"]),
    ({"updated_at": dt.datetime(2031, 3, 7, 11, 14)}, ["updated_at_after_fetched_at"]),
    ({"next_funding_time": dt.datetime(2031, 3, 7, 11, 12)},
     ["stale_next_funding_time", "next_funding_time_not_after_updated_at"]),
    ({"next_funding_time": dt.datetime(2031, 3, 7, 11, 12), "updated_at": dt.datetime(2031, 3, 7, 11, 11)},
     ["stale_next_funding_time"]),
    ({"mark_price": 0.0}, ["invalid_mark_price"]),
    ({"open_interest": -1.0}, ["negative_open_interest"]),
    ({"open_interest": 0.0}, []),
    ({"rate": 0.1}, ["implausible_rate_magnitude"]),
    ({"rate": 0.05}, []),
    ({"rate": -0.05}, []),
    ({"rate": -0.051}, ["implausible_rate_magnitude"]),
    ({"interval_hours": 0, "rate": 1.0, "mark_price": -1.0},
     ["invalid_interval_hours", "invalid_mark_price", "implausible_rate_magnitude"]),
    (dict.fromkeys(BASE), []),
]


def test_quality_rules(spark):
    rows = [tuple({**BASE, **changes}.values()) for changes, _ in RULES]
    df = spark.createDataFrame(rows, SCHEMA).select(quality_tags(quality_rules()).alias("tags"))
    assert [r.tags for r in df.collect()] == [tags for _, tags in RULES]


def test_changes(spark):
    cases = [(0.00018, 0.00010), (0.00005, 0.00010), (None, 0.1), (0.1, None)]
    rows = spark.createDataFrame(cases, "a double, b double").select(change(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in rows] == [0.00018 - 0.00010, 0.00005 - 0.00010, None, None]


def test_large_moves(spark):
    t = LARGE_MOVE_THRESHOLD
    rows = spark.createDataFrame([(2 * t,), (t / 2,), (t,), (-2 * t,), (None,)], "d double")
    assert [r[0] for r in rows.select(is_large_move(F.col("d"), t)).collect()] == [True, False, True, True, None]
    custom = spark.createDataFrame([(0.00005,), (0.00015,)], "d double").select(is_large_move(F.col("d"), 0.0001))
    assert [r[0] for r in custom.collect()] == [False, True]


def test_frozen(spark):
    x, y = 0.0001, 0.0002
    cases = [((x, x, x, x, x, x), True), ((x, x, x, y, x, x), False), ((None, x, x, x, x, x), None),
             ((x, x, None, x, x, x), None), ((x, y, None, x, x, x), None)]
    df = spark.createDataFrame([c for c, _ in cases], "a double, b double, c double, d double, e double, f double")
    got = df.select(is_frozen(F.col("a"), [F.col(n) for n in "bcdef"])).collect()
    assert [r[0] for r in got] == [e for _, e in cases]
    with pytest.raises(ValueError):
        is_frozen(F.col("a"), [])


def test_correlation(spark):
    rows = [("up", 1.0, 2.0), ("up", 2.0, 4.0), ("up", 3.0, 6.0), ("up", None, 9.0), ("flat", 1.0, 1.0),
            ("flat", 1.0, 2.0), ("one", 1.0, 1.0), ("none", None, 1.0), ("mask", 1.0, 5.0), ("mask", 1.0, 6.0),
            ("mask", 7.0, None)]
    df = spark.createDataFrame(rows, "g string, a double, b double")
    got = dict(tuple(r) for r in df.groupBy("g").agg(safe_corr(F.col("a"), F.col("b"))).collect())
    assert got["up"] == pytest.approx(1.0)
    assert got["flat"] is None and got["one"] is None and got["none"] is None and got["mask"] is None
