"""Audits, contracts, comparisons, exact percentiles and bounded results."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pollpipe.operators import (
    Case, approx_key_metrics, approx_percentile, cap_rows, check_contract, compare_results, exact_percentile,
    governed, key_counts, key_differences, key_metrics, latest_poll, lost_keys, row_counts, rows_at_latest, run_gate,
    score_summary, scorecard, side_by_side, top_k, write_report,
)
from pollpipe.presets.perpetuals import GOLD_CONTRACT
from pollpipe.spec import Contract, ContractColumn


def test_key_metrics_have_no_collisions(spark):
    df = spark.createDataFrame([("AB", "C"), ("A", "BC"), ("A", "BC"), (None, "C")], "a string, b string")
    assert tuple(df.agg(*key_metrics(["a", "b"])).first()) == (4, 2)
    assert tuple(df.agg(*approx_key_metrics(["a", "b"])).first()) == (4, 2)


def test_sketch_keeps_no_buffer_per_key(spark, tmp_path):
    rows = [("AB", "C"), ("A", "BC"), ("A", "BC"), (None, "C")]
    spark.createDataFrame(rows, "a string, b string").write.parquet(f"{tmp_path}/rows")
    df = spark.read.parquet(f"{tmp_path}/rows")
    assert tuple(key_counts(df, ["a", "b"]).first()) == (4, 2)
    assert tuple(key_counts(df.limit(0), ["a", "b"]).first()) == (0, 0)
    both = side_by_side(df.agg(*approx_key_metrics(["a", "b"])), key_counts(df, ["a", "b"]).toDF("exact_rows", "exact_keys"))
    assert tuple(both.first()) == (4, 2, 4, 2)
    plan = both._jdf.queryExecution().executedPlan().toString()
    sketches = [line for line in plan.split("\n") if "approx_count_distinct" in line]
    assert sketches and all("keys=[]" in line for line in sketches)


def test_latest_poll(spark):
    df = spark.createDataFrame([(1, 1), (2, 2), (2, 3), (None, 4)], "t int, v int")
    assert tuple(latest_poll(df, "t").first()) == (2, 2)
    assert sorted(r.v for r in rows_at_latest(df, "t").collect()) == [2, 3]
    assert tuple(latest_poll(df.limit(0), "t").first()) == (None, 0)


def test_lost_keys_and_counts(spark):
    up = spark.createDataFrame([(1,), (1,), (2,), (3,)], "k int")
    down = spark.createDataFrame([(3,), (3,)], "k int")
    assert sorted(r.k for r in lost_keys(up, down, ["k"]).collect()) == [1, 2]
    assert row_counts({"up": up, "down": down}).first().asDict() == {
        "up_count": 4, "down_count": 2, "up_minus_down": 2}


def test_gate(spark):
    df = spark.range(3).agg(F.count(F.lit(1)).alias("n"))
    checks = [lambda v: None, lambda v: f"n is {v['n']}"]
    result = run_gate(df, checks)
    assert result.breaches == ("n is 3",) and not result.ok and result.values == {"n": 3}
    with pytest.raises(ValueError, match="n is 3"):
        run_gate(df, checks, strict=True)


def test_contract(spark):
    at = dt.datetime(2026, 1, 1)
    good = ("e", "s", "linear", at, 0.1, None, None, None, None, None, 1.0, None)
    schema = ("exchange string, symbol string, margin_type string, fetched_at timestamp, rate_per_8h double, "
              "funding_change double, is_large_move boolean, is_frozen boolean, open_interest double, "
              "oi_change double, mark_price double, price_change double")
    df = spark.createDataFrame([good], schema)
    as_of = F.lit(at + dt.timedelta(minutes=30))
    assert check_contract(df, GOLD_CONTRACT, as_of).where("violations > 0").count() == 0
    bad = spark.createDataFrame([good, good, (None, "s", "odd", at, *good[4:])], schema).drop("mark_price").withColumn(
        "extra", F.lit(1)).withColumn("oi_change", F.lit(1))
    late = F.lit(at + dt.timedelta(minutes=31))
    found = {(r.rule, r.column_name): r.violations for r in check_contract(bad, GOLD_CONTRACT, late).collect()
             if r.violations}
    assert found == {
        ("missing_column", "mark_price"): 1, ("unexpected_column", "extra"): 1, ("wrong_type", "oi_change"): 1,
        ("not_null", "exchange"): 1, ("allowed_values", "margin_type"): 1,
        ("unique_grain", "exchange,symbol,fetched_at"): 1, ("freshness", "fetched_at"): 1,
    }


def test_governed_projection(spark):
    contract = Contract((ContractColumn("a", "int"), ContractColumn("b", "int")), ("a",))
    df = spark.createDataFrame([(1, 2, 3)], "A int, secret int, b int")
    assert governed(df, contract).columns == ["a", "b"]
    with pytest.raises(Exception, match="secret"):
        governed(df, contract).select("secret").collect()


GOLDEN = [("a", 1.0), ("b", 2.0), ("c", 0.0)]


def sides(spark, actual, golden=GOLDEN):
    return spark.createDataFrame(golden, "k string, x double"), spark.createDataFrame(actual, "k string, y double")


@pytest.mark.parametrize(
    "actual, values, passed, reason",
    [
        ([("a", 1.0005), ("b", 2.0), ("c", 1e-13)], True, True, "ok"),
        ([("a", 9.0), ("b", 2.0), ("c", 0.0)], False, True, "ok"),
        ([("a", 1.002), ("b", 2.0), ("c", 0.0)], True, False, "no number near golden x at key a"),
        ([("a", float("nan")), ("b", 2.0), ("c", 0.0)], True, False, "no number near golden x at key a"),
        ([("a", None), ("b", 2.0), ("c", 0.0)], True, False, "no number near golden x at key a"),
        ([], True, False, "the actual side is empty"),
        ([("a", 1.0), ("a", 1.0)], True, False, "the actual side has several rows for one key"),
        ([("a", 1.0), ("z", 1.0), ("y", 1.0)], True, False, "2 keys are unknown to golden, the smallest is y"),
        ([("a", 1.0)], True, False, "2 golden keys were not found, the smallest is b"),
    ],
)
def test_verdicts(spark, actual, values, passed, reason):
    golden, got = sides(spark, actual)
    verdict = compare_results(golden, got, ["k"], check_values=values).first()
    assert (verdict.passed, verdict.reason) == (passed, reason)


def test_null_keys_match_and_golden_nan_is_ignored(spark):
    golden, got = sides(spark, [(None, 1.0), ("a", 5.0)], [(None, 1.0), ("a", float("nan"))])
    assert compare_results(golden, got, ["k"], check_values=True).first().passed


def test_golden_copies_are_reported(spark):
    golden, got = sides(spark, [("a", 1.0)], [("a", 1.0), ("a", 1.0)])
    assert tuple(compare_results(golden, got, ["k"], check_values=True).first()) == (True, "ok", 1, 0)


@pytest.mark.parametrize("n", [2, 51, 20_000])
def test_missing_keys_fail_at_any_size(spark, n):
    golden = spark.range(n).select(F.col("id").alias("k"))
    lost = compare_results(golden, golden.where(F.col("k") < n - 1), ["k"]).first()
    assert (lost.passed, lost.missing) == (False, 1)
    allowed = compare_results(golden, golden.where(F.col("k") < n - 1), ["k"], allow_missing=True).first()
    assert (allowed.passed, allowed.missing) == (True, 1)


def test_missing_key_column(spark):
    golden, got = sides(spark, [("a", 1.0)])
    renamed = got.withColumnRenamed("k", "key")
    assert compare_results(golden, renamed, ["k"]).first().reason == "the actual side lacks the key columns k"
    assert compare_results(golden, renamed.limit(0), ["k"]).first().reason == "the actual side is empty"


def test_hot_key_does_not_multiply(spark):
    many = spark.range(20_000).select(F.lit("a").alias("k"), F.lit(1.0).alias("x"))
    (row,) = key_differences(many, many, ["k"]).collect()
    assert (row.golden_rows, row.actual_rows, row.mismatch) == (20_000, 20_000, None)


def test_scorecard_and_report(spark, tmp_path):
    golden, got = sides(spark, GOLDEN)
    cards = scorecard([Case("one", golden, got, ("k",), True), Case("two", golden, got.limit(0), ("k",))])
    assert tuple(score_summary(cards).first()) == (1, 2)
    write_report(cards, str(tmp_path / "report"))
    assert spark.read.json(str(tmp_path / "report/cases")).count() == 2
    assert spark.read.json(str(tmp_path / "report/summary")).first().passed == 1


@pytest.mark.parametrize("seed, n", [(0, 1), (1, 2), (2, 999), (3, 5000)])
def test_percentile_is_exact(spark, seed, n):
    rng = random.Random(seed)
    values = [rng.choice([rng.gauss(0, 1), 0.0, 7.0, rng.uniform(1e-300, 1e300)]) for _ in range(n)]
    df = spark.createDataFrame([(v,) for v in [*values, None, float("nan"), float("inf")]], "x double")
    for fraction in (0.0, 0.37, 0.5, 0.99, 1.0):
        expected = float(np.quantile(np.array(values), fraction))
        assert exact_percentile(df, "x", fraction, bins=16) == pytest.approx(expected, rel=1e-12, abs=1e-300)


def test_percentile_of_neighbouring_and_equal_values(spark):
    step = np.nextafter(1.0, 2.0)
    df = spark.createDataFrame([(1.0,)] * 700 + [(float(step),)] * 300, "x double")
    assert exact_percentile(df, "x", 0.5) == 1.0 and exact_percentile(df, "x", 0.9) == float(step)
    assert exact_percentile(df.limit(0), "x", 0.5) is None
    with pytest.raises(ValueError):
        exact_percentile(df, "x", 1.5)


def test_sketch_is_close(spark):
    df = spark.range(10_001).select(F.col("id").cast("double").alias("x"))
    assert approx_percentile(df, "x", 0.99).first()[0] == pytest.approx(9_900, abs=5)


@pytest.mark.parametrize("n, truncated", [(0, False), (50, False), (51, True)])
def test_cap(spark, n, truncated):
    capped = cap_rows(spark.range(n), 50)
    assert capped.rows.count() == min(n, 50) and capped.truncated is truncated


def test_top_k(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 3.0), ("c", 3.0), ("d", None)], "k string, v double")
    assert [r.k for r in top_k(df, "v", ["k"], 3).collect()] == ["b", "c", "a"]
    assert [r.k for r in top_k(df, "v", ["k"], 1_000_000, cap=2).collect()] == ["b", "c"]
    assert [r.k for r in top_k(df, "v", ["k"], cap=4, largest_first=False).collect()] == ["a", "b", "c", "d"]
    assert [r.k for r in top_k(df, "v", ["k"]).collect()] == ["b", "c", "a", "d"]
    assert top_k(spark.range(12_000), "id", ["id"]).count() == 12_000
    for bad in (lambda: top_k(df, "v", ["k"], 0), lambda: cap_rows(df, 0)):
        with pytest.raises(ValueError):
            bad()
