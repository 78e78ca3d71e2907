"""Outcome classes, explode, drift and quarantine."""

import json

from pyspark.sql import functions as F

from pollpipe.operators import accepted, drift_counts, explode_polls, rejected
from pollpipe.presets.perpetuals import FEED
from pollpipe.sources import ENVELOPE, classify_polls, read_polls

EXPECTED = FEED.vendor_fields
AT = "2031-03-07T11:12:54.250000+00:00"


def record(**changes):
    values = {
        "exchange": "Kiosk", "symbol": "TALLYUSD", "base_coin": "BTC", "rate": 0.00125, "predicted_rate": None,
        "interval_hours": 4, "next_funding_time": "2031-03-07T16:00:00+00:00",
        "updated_at": "2031-03-07T11:12:13.250+00:00", "margin_type": "inverse", "asset_class": "coin",
        "mark_price": 412.75, "mark_price_updated_at": "2031-03-07T11:12:11.5+00:00",
        "open_interest": 90210.5, "market_cap_rank": 4, "age_seconds": 41, "data_source": "ledger",
        "freshness_sla_seconds": 900, "is_stale": False,
    }
    return {**values, **changes}


def polls(spark, *payloads, status=200):
    rows = [(AT, status, {}, "https://feed.example", p, None) for p in payloads]
    return spark.createDataFrame(rows, ENVELOPE)


def body(*records):
    return json.dumps({"data": list(records)})


def test_outcomes(spark):
    rows = [
        (AT, 200, {}, "u", body(), None), (None, None, None, None, None, "boom"), (AT, 429, {}, "u", "{}", None),
        (AT, 500, {}, "u", "", None),
    ]
    got = classify_polls(spark.createDataFrame(rows, ENVELOPE)).select("success", "reason").collect()
    assert [tuple(r) for r in got] == [
        (True, None), (False, "network_error: boom"), (False, "rate_limit_or_quota_exceeded"),
        (False, "unexpected_status_500"),
    ]


def test_one_row_per_record_with_poll_columns(spark):
    first = record(symbol="TALLYUSD_Q", rate=0.002, open_interest=None)
    rows = accepted(explode_polls(polls(spark, body(first, record())), EXPECTED)).orderBy("symbol").collect()
    assert [r.symbol for r in rows] == ["TALLYUSD", "TALLYUSD_Q"]
    assert {(r.fetched_at, r.status_code) for r in rows} == {(AT, 200)}
    assert json.loads(rows[0].raw_record_json) == record()
    assert json.loads(rows[1].raw_record_json) == first
    assert all(r.schema_extra_fields == [] and r.schema_missing_fields == [] for r in rows)
    assert float(rows[0].rate) == 0.00125 and float(rows[0].open_interest) == 90210.5
    assert rows[1].open_interest is None and rows[0].is_stale == "false"


def test_kinds(spark):
    odd = record(exchange=7, rate="0.1", interval_hours=2.5, is_stale="true", symbol={"a": 1}, base_coin=[1])
    (row,) = accepted(explode_polls(polls(spark, body(odd)), EXPECTED)).select("field_kinds.*").collect()
    assert (row.exchange, row.rate, row.interval_hours, row.is_stale, row.symbol, row.base_coin) == (
        "number", "string", "number", "string", "object", "array")
    assert row.predicted_rate is None and row.market_cap_rank == "number"


def test_drift(spark):
    extra = record(zeta=1, settlement_currency="USDT")
    few = {k: record()[k] for k in ("exchange", "symbol", "base_coin", "rate")}
    rows = accepted(explode_polls(polls(spark, body(extra, few)), EXPECTED))
    by_size = sorted(rows.collect(), key=lambda r: len(r.schema_missing_fields))
    assert by_size[0].schema_extra_fields == ["settlement_currency", "zeta"]
    assert by_size[0].schema_missing_fields == []
    assert by_size[1].schema_extra_fields == []
    assert by_size[1].schema_missing_fields == sorted(set(EXPECTED) - set(few))
    assert by_size[1].interval_hours is None
    assert tuple(drift_counts(rows).first()) == (1, 1)


def test_null_value_is_not_missing(spark):
    (row,) = accepted(explode_polls(polls(spark, body(record(rate=None))), EXPECTED)).collect()
    assert row.schema_missing_fields == [] and row.rate is None


REJECTS = [
    ("not valid json {{{", "invalid_json"), ("", "invalid_json"), (None, "invalid_json"),
    ('{"data": []} rest', "invalid_json"), ('{"data": [{"a": 1}]', "invalid_json"),
    ('{"data": []}, {"data": []}', "invalid_json"),
    ('{"unexpected": []}', "no_data_array"), ('{"data": null}', "no_data_array"),
    ('{"data": {}}', "no_data_array"), ('{"data": "text"}', "no_data_array"), ("[]", "no_data_array"),
    ("3", "no_data_array"),
    ('{"data": [3]}', "record_not_object"), ('{"data": [null]}', "record_not_object"),
    ('{"data": ["text"]}', "record_not_object"), ('{"data": [[1]]}', "record_not_object"),
]


def test_quarantine(spark):
    rows = [(i, AT, 200, payload) for i, (payload, _) in enumerate(REJECTS)]
    df = spark.createDataFrame(rows, "case int, fetched_at string, status_code int, payload string")
    got = explode_polls(df, ["a"]).select("case", "reject_reason").collect()
    assert {r.case: r.reject_reason for r in got} == {i: reason for i, (_, reason) in enumerate(REJECTS)}
    assert len(got) == len(REJECTS)
    assert accepted(explode_polls(df, ["a"])).count() == 0


def test_rejected_payload_keeps_its_text(spark):
    (row,) = rejected(explode_polls(polls(spark, '{"unexpected": [1]}'), EXPECTED)).collect()
    assert row.raw_json == '{"unexpected": [1]}' and row.fetched_at == AT


def test_empty_data_is_valid(spark):
    assert explode_polls(polls(spark, '{"data": []}'), EXPECTED).count() == 0


def test_failed_poll_is_not_parsed(spark):
    exploded = explode_polls(polls(spark, body(record()), status=429), EXPECTED)
    assert [r.reject_reason for r in exploded.collect()] == ["rate_limit_or_quota_exceeded"]


def test_one_bad_record_leaves_the_others(spark):
    exploded = explode_polls(polls(spark, json.dumps({"data": [record(), 7, record(symbol="X")]})), EXPECTED)
    assert sorted(r.symbol for r in accepted(exploded).collect()) == ["TALLYUSD", "X"]
    assert rejected(exploded).count() == 1


def test_last_value_of_a_repeated_key(spark):
    (row,) = accepted(explode_polls(polls(spark, '{"data": [{"k": 1, "k": 2}]}'), ["k"])).collect()
    assert row.k == "2" and row.schema_extra_fields == []


def test_landed_files(spark, tmp_path):
    polls(spark, body(record()), "broken").write.json(str(tmp_path / "in"))
    exploded = explode_polls(read_polls(spark, str(tmp_path / "in")), EXPECTED)
    assert exploded.where(F.col("reject_reason").isNull()).count() == 1
    assert exploded.count() == 2


def test_keys_of_records_are_parsed_once(spark):
    """A filter on the reason must not parse them again below itself."""
    good = accepted(explode_polls(polls(spark, body(record(), 7), "[]"), EXPECTED))
    plan = spark._jvm.PythonSQLUtils.explainString(good._jdf.queryExecution(), "simple")
    assert plan.count("jsonObjectKeys") == 1
    assert good.count() == 1
