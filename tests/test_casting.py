"""Strict casts, cast issues, silver rows and profiles."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from pollpipe.functions import cast_failed, cast_value
from pollpipe.functions.casting import NO_TIME
from pollpipe.operators import accepted, cast_fields, explode_polls, issue_rows, problem_fields, profile_fields
from pollpipe.operators.profile import problem_cells
from pollpipe.plans import SilverPlan, silver_rows
from pollpipe.presets import perpetuals as preset
from pollpipe.session import setting
from pollpipe.spec import FeedSpec, Field

from test_polls import AT, body, polls, record

FAIL = "fails"
UTC = dt.datetime

CASES = [
    # text, JSON kind, type, result
    ("0.1", "string", "float", 0.1), ("1e-3", "number", "float", 0.001), (" 5. ", "string", "float", 5.0),
    ("true", "boolean", "float", 1.0), ("NaN", "string", "float", FAIL), ("Infinity", "string", "float", FAIL),
    ("1e999", "string", "float", FAIL), ("1.5d", "string", "float", FAIL), ("1_000", "string", "float", 1000.0), ("1__0", "string", "float", FAIL), ("_1", "string", "float", FAIL), ("1_0.2_5e1_0", "string", "float", 10.25e10),
    ("", "string", "float", FAIL), ("[1]", "array", "float", FAIL), (None, None, "float", None),
    ("12", "string", "int", 12), (" +12 ", "string", "int", 12), ("12.9", "string", "int", FAIL),
    ("12.9", "number", "int", 12), ("-12.9", "number", "int", -12), ("1E3", "number", "int", 1000),
    ("9007199254740993", "number", "int", 9007199254740993), ("99999999999999999999", "number", "int", FAIL),
    ("1_000", "string", "int", 1000), ("1_", "string", "int", FAIL), ("false", "boolean", "int", 0), ("Infinity", "number", "int", FAIL),
    ("true", "boolean", "bool", True), ("false", "boolean", "bool", False), ("true", "string", "bool", FAIL),
    ("1", "number", "bool", FAIL),
    ("abc", "string", "str", "abc"), ("", "string", "str", ""), ("7", "number", "str", FAIL),
    ("true", "boolean", "str", FAIL), ('{"a":1}', "object", "str", FAIL), (None, None, "str", None),
    ("2026-09-18T08:00:00+00:00", "string", "datetime", UTC(2026, 9, 18, 8)),
    ("2026-09-18T08:00:00Z", "string", "datetime", UTC(2026, 9, 18, 8)),
    ("2026-09-18T08:00:00", "string", "datetime", UTC(2026, 9, 18, 8)),
    ("2026-09-18 08:00", "string", "datetime", UTC(2026, 9, 18, 8)),
    ("2026-09-18", "string", "datetime", UTC(2026, 9, 18)),
    ("2026-09-18T08:00:00.729+00:00", "string", "datetime", UTC(2026, 9, 18, 8, 0, 0, 729000)),
    ("2026-09-18T08:00:00,5+00:00", "string", "datetime", UTC(2026, 9, 18, 8, 0, 0, 500000)),
    ("2026-09-18T08:00:00-05:30", "string", "datetime", UTC(2026, 9, 18, 13, 30)),
    ("2026-02-30", "string", "datetime", FAIL), ("not-a-timestamp", "string", "datetime", FAIL),
    ("2026", "string", "datetime", FAIL), ("12:00:00", "string", "datetime", FAIL),
    ("now", "string", "datetime", FAIL), ("2026-9-8", "string", "datetime", FAIL),
    ("20260918", "string", "datetime", UTC(2026, 9, 18)), ("2026091", "string", "datetime", FAIL),
    ("20260918T0800", "string", "datetime", UTC(2026, 9, 18, 8)), ("20260918T080005.25Z", "string", "datetime", UTC(2026, 9, 18, 8, 0, 5, 250000)),
    ("2026-09-18T080005+0200", "string", "datetime", UTC(2026, 9, 18, 6, 0, 5)), ("20260230", "string", "datetime", FAIL),
    ("2026-W38-5", "string", "datetime", UTC(2026, 9, 18)), ("2026W38", "string", "datetime", UTC(2026, 9, 14)),
    ("2026W385T08:00", "string", "datetime", UTC(2026, 9, 18, 8)), ("2026-W53-7", "string", "datetime", UTC(2027, 1, 3)),
    ("2025-W53-1", "string", "datetime", FAIL), ("2026-W38-8", "string", "datetime", FAIL), ("2026-W00-1", "string", "datetime", FAIL),
    ("2026-09-18T08:00:00+00:00", "number", "datetime", FAIL),
]


@pytest.mark.parametrize("type_name", ["float", "int", "bool", "str", "datetime"])
def test_casts(spark, type_name):
    cases = [(i, t, k) for i, (t, k, name, _) in enumerate(CASES) if name == type_name]
    df = spark.createDataFrame(cases, "i int, text string, kind string")
    text, kind = F.col("text"), F.col("kind")
    value = cast_value(text, type_name, kind)
    if type_name == "datetime":
        value = value.cast("timestamp_ntz")
    got = {r.i: (r.value, r.failed) for r in df.select(
        "i", value.alias("value"), cast_failed(text, type_name, kind).alias("failed")).collect()}
    for i, (t, k, _, expected) in enumerate(CASES):
        if i in got:
            assert got[i] == ((None, True) if expected == FAIL else (expected, False)), (t, k, type_name)


def test_plain_text_columns_count_as_strings(spark):
    df = spark.createDataFrame([("1.5",), (None,), ("x",)], "v string")
    rows = cast_fields(df, [Field("v", "float")]).collect()
    assert [tuple(r) for r in rows] == [(1.5, []), (None, []), (None, ["v"])]


def test_unknown_type_is_refused():
    with pytest.raises(ValueError):
        Field("a", "decimal")


def test_feed_needs_its_key():
    with pytest.raises(ValueError):
        FeedSpec((Field("a", "str"),), ("a",), "t")


PLAN = SilverPlan(preset.FEED, preset.derived_columns, preset.quality_rules)
GOOD_TIME = "2031-03-07T11:13:00.500+00:00"


def silver(spark, *records, at=GOOD_TIME):
    bronze = explode_polls(polls(spark, body(*records)).withColumn("fetched_at", F.lit(at)), preset.FEED.vendor_fields)
    return silver_rows(bronze, PLAN)


def test_silver_schema_and_good_row(spark):
    df = silver(spark, record())
    assert df.columns == [f.name for f in preset.FEED.fields] + [
        "silver_cast_issues", "bronze_schema_extra_fields", "bronze_schema_missing_fields", "rate_per_8h",
        "rate_annualized", "poll_lag_seconds", "silver_quality_issues"]
    assert [f.dataType for f in df.schema.fields[:19]] == [f.dataType for f in preset.FEED.typed_schema().fields]
    row = df.first()
    assert row.silver_cast_issues == [] and row.silver_quality_issues == []
    assert row.rate == 0.00125 and row.interval_hours == 4 and row.is_stale is False
    assert row.rate_per_8h == 0.00125 * 8.0 / 4 and row.rate_annualized == 0.00125 * (8760.0 / 4)
    assert row.poll_lag_seconds == pytest.approx(47.25)


def test_absent_field_is_null_and_no_issue(spark):
    values = record()
    del values["rate"]
    row = silver(spark, values).first()
    assert row.rate is None and row.silver_cast_issues == []
    assert row.bronze_schema_missing_fields == ["rate"] and row.rate_per_8h is None


def test_failed_fields_in_spec_order(spark):
    row = silver(spark, record(is_stale="true", rate="not_a_number", symbol=None, exchange=7)).first()
    assert row.silver_cast_issues == ["exchange", "rate", "is_stale"]
    assert row.rate is None and row.exchange is None


def test_drift_is_carried_forward(spark):
    assert silver(spark, record(new=1)).first().bronze_schema_extra_fields == ["new"]


def test_only_the_domain(spark):
    assert silver(spark, record(base_coin="ETH"), record()).count() == 1


def test_issue_rows(spark):
    rows = issue_rows(
        silver(spark, record(rate="x", interval_hours=0), record(symbol="OK")), ["symbol"],
        {"cast": "silver_cast_issues", "quality": "silver_quality_issues"},
    ).collect()
    assert sorted(tuple(r) for r in rows) == [
        ("TALLYUSD", "cast", "rate"), ("TALLYUSD", "quality", "invalid_interval_hours")]


def profile(spark, *records, at=AT):
    bronze = accepted(explode_polls(
        polls(spark, body(*records)).withColumn("fetched_at", F.lit(at)), preset.FEED.vendor_fields))
    return profile_fields(bronze, preset.FEED.fields)


def test_profile_of_good_rows(spark):
    report = profile(spark, record(), record())
    rows = {r.field: r for r in report.collect()}
    assert list(rows) == [f.name for f in preset.FEED.fields]
    assert rows["predicted_rate"].null_count == 2 and rows["predicted_rate"].unexpected_null_count == 0
    assert problem_fields(report).count() == 0


def test_profile_of_bad_rows(spark):
    bad = [record(rate=None), record(updated_at="c"), record(updated_at="a"), record(updated_at="d"),
           record(updated_at="b"), record(open_interest=None)]
    report = profile(spark, *bad, at="not-a-timestamp")
    rows = {r.field: r for r in report.collect()}
    assert (rows["rate"].null_count, rows["rate"].unexpected_null_count) == (1, 1)
    assert (rows["open_interest"].null_count, rows["open_interest"].unexpected_null_count) == (1, 0)
    assert rows["updated_at"].cast_failure_count == 4
    assert rows["updated_at"].cast_failure_examples == ["a", "b", "c"]
    assert rows["fetched_at"].cast_failure_count == 6
    assert {r.field for r in problem_fields(report).collect()} == {"rate", "updated_at", "fetched_at"}


def test_profile_counts_absent_columns_as_null(spark):
    df = spark.createDataFrame([("1",)], "a string")
    rows = profile_fields(df, [Field("a", "int"), Field("b", "int")]).collect()
    assert [(r.field, r.null_count, r.unexpected_null_count) for r in rows] == [("a", 0, 0), ("b", 1, 1)]


def test_profile_casts_are_not_interpreted(spark):
    """Inside a generator that holds a lambda, every cast would be."""
    df = spark.createDataFrame([("1", "x", "2031-03-07")], "a string, b string, c string")
    cells = problem_cells(df, [Field("a", "int"), Field("b", "float"), Field("c", "datetime"), Field("d", "str")])
    plan = spark._jvm.PythonSQLUtils.explainString(cells._jdf.queryExecution(), "simple")
    (generate,) = [line for line in plan.splitlines() if "Generate" in line]
    assert "cast(" not in generate.lower() and plan.count("transform(") == 1
    assert sorted(tuple(r) for r in cells.collect()) == [(1, "x", 1), (3, None, 1)]


def test_casts_bound_to_fail_are_not_tried(spark):
    """Only texts that no cast reads are kept from it, and numbers are cut at the ends of the integers."""
    two = spark.range(100).select(F.lpad(F.col("id").cast("string"), 2, "0").alias("n"))
    days = two.crossJoin(two.withColumnRenamed("n", "d")).selectExpr("concat('2031-', n, '-', d) AS t")
    hours = two.selectExpr("explode(array(concat('2031-03-07T', n), concat('2032-02-29 ', n, ':30:00Z'))) AS t")
    judged = days.union(hours).select("t", F.col("t").rlike(NO_TIME).alias("no"), F.col("t").try_cast("timestamp").alias("time"))
    assert judged.where("no AND time IS NOT NULL").count() == 0
    assert judged.where("NOT no AND time IS NULL").collect()[0].t == "2031-02-29"
    assert judged.where("NOT no").count() == 366 + 2 * 24
    texts = ["9223372036854775807", "9223372036854775808", "9.3E18", "-9.223372036854775808E18", "2.9", "-Infinity", "NaN"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    values = [r.v for r in df.select("i", cast_value(F.col("t"), "int", F.lit("number")).alias("v")).orderBy("i").collect()]
    assert values == [2**63 - 1, 2**63 - 1, None, -(2**63), 2, None, None]


def test_raw_json_round_trip(spark):
    (row,) = accepted(explode_polls(polls(spark, body(record(rate=0.1, symbol='a"b\\'))), preset.FEED.vendor_fields)).collect()
    assert json.loads(row.raw_record_json)["symbol"] == 'a"b\\' and row.symbol == 'a"b\\'


def test_typed_rows_stay_within_generated_code(spark):
    """Without the interpreted way out, a plan whose code is too large for the JVM is an error."""
    times = ["2031-W10-5T1112", "20310307T111213", "2031-03-07T11:12:13,5+00:00", "2031-W60"]
    rows = polls(spark, body(*[record(updated_at=t, mark_price_updated_at=t, next_funding_time=t) for t in times]))
    plan = SilverPlan(preset.FEED, preset.derived_columns, preset.quality_rules)
    with setting(spark, "spark.sql.codegen.fallback", "false"):
        bronze = explode_polls(rows, preset.FEED.vendor_fields)
        typed = silver_rows(bronze, plan)
        found = [r.updated_at for r in typed.collect()]
        issue_rows(typed, preset.FEED.key, {"cast": "silver_cast_issues"}).collect()
    hours = [dt.datetime(2031, 3, 7, 11, 12), dt.datetime(2031, 3, 7, 11, 12, 13), dt.datetime(2031, 3, 7, 11, 12, 13, 500_000)]
    assert found == [*hours, None]
