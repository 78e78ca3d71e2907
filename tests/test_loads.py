"""Tables, merges, incremental features, late rows and streams."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from pollpipe.operators import (
    ChangeSpec, change_features, insert_into, insert_only, new_rows, one_per_key, repeated_keys, split_null_keys,
    upsert, upsert_into,
)
from pollpipe.plans import build_features, late_keys, repair_late_rows
from pollpipe.plans import gates
from pollpipe.plans.layers import SilverPlan, load_bronze, load_gold, load_silver
from pollpipe.operators import accepted
from pollpipe.presets import perpetuals as preset
from pollpipe.sources import FeedTable, stream_polls
from pollpipe.streaming import stream_bronze, stream_features, stream_silver

from test_polls import body, record
from test_lags import collected

START = dt.datetime(2024, 1, 1)
KEY = ("s", "t")
SCHEMA = "s string, t timestamp, v double"
SPEC = ChangeSpec(("s",), "t", "v", "v_change", 0.5, lookback=2)
COLUMNS = ("s", "t", "v", "v_change", "is_large_move", "is_frozen")


def frame(spark, rows):
    return spark.createDataFrame([(s, START + dt.timedelta(hours=h), v) for s, h, v in rows], SCHEMA)


def test_insert_only_and_upsert(spark):
    target = frame(spark, [("a", 1, 1.0), ("a", 2, 2.0)])
    batch = frame(spark, [("a", 2, 9.0), ("a", 3, 9.0), ("b", 1, 9.0)])
    values = lambda df: sorted((r.s, r.t.hour, r.v) for r in df.collect())
    assert values(insert_only(target, batch, KEY)) == [("a", 1, 1.0), ("a", 2, 2.0), ("a", 3, 9.0), ("b", 1, 9.0)]
    assert values(upsert(target, batch, KEY)) == [("a", 1, 1.0), ("a", 2, 9.0), ("a", 3, 9.0), ("b", 1, 9.0)]


def test_copies_in_a_batch(spark):
    batch = frame(spark, [("a", 1, 2.0), ("a", 1, 1.0), ("b", 1, 1.0)])
    assert new_rows(batch, frame(spark, [("b", 1, 0.0)]), KEY).count() == 2
    assert [tuple(r) for r in repeated_keys(batch, KEY).select("s", "rows").collect()] == [("a", 2)]
    assert sorted(r.v for r in one_per_key(batch, KEY).collect()) == [1.0, 1.0]


def test_null_keys_are_set_apart(spark):
    df = spark.createDataFrame([("a", START, 1.0), (None, START, 2.0), ("a", None, 3.0)], SCHEMA)
    keyed, without = split_null_keys(df, KEY)
    assert keyed.count() == 1 and sorted(r.v for r in without.collect()) == [2.0, 3.0]


@pytest.mark.parametrize("named", [False, True])
def test_stored_merges(spark, tmp_path, named):
    table = FeedTable(spark, "merge_target" if named else str(tmp_path / "t"), "t")
    assert not table.exists() and table.max_time() is None
    first = frame(spark, [("a", 1, 1.0), ("a", 25, 2.0), ("b", 49, 3.0)])
    insert_into(table, first, KEY)
    for _ in range(2):
        insert_into(table, frame(spark, [("a", 1, 9.0), ("c", 1, 4.0)]), KEY)
    assert sorted(r.v for r in table.read().collect()) == [1.0, 2.0, 3.0, 4.0]
    for _ in range(2):
        upsert_into(table, frame(spark, [("a", 25, 5.0), ("d", 26, 6.0)]), KEY)
    assert sorted(r.v for r in table.read().collect()) == [1.0, 3.0, 4.0, 5.0, 6.0]
    assert table.max_time() == START + dt.timedelta(hours=49)
    assert [r.column_name for r in table.columns().collect()] == ["s", "t", "v"]
    table.compact([START.date()])
    assert table.read().count() == 5
    with pytest.raises(ValueError):
        upsert_into(table, frame(spark, [("a", 1, 1.0), ("a", 1, 2.0)]), KEY)


def test_only_a_missing_folder_counts_as_absent(spark, tmp_path):
    assert not FeedTable(spark, str(tmp_path / "nothing"), "t").exists()
    (tmp_path / "empty").mkdir()
    assert not FeedTable(spark, str(tmp_path / "empty"), "t").exists()
    (tmp_path / "other").mkdir()
    (tmp_path / "other" / "x.parquet").write_text("no parquet")
    with pytest.raises(Exception):
        FeedTable(spark, str(tmp_path / "other"), "t").exists()


def test_bounds_prune_and_push_down(spark, tmp_path):
    table = FeedTable(spark, str(tmp_path / "t"), "t")
    table.append(frame(spark, [("a", h, float(h)) for h in range(100)]))
    read = table.read(since=START + dt.timedelta(hours=30), before=START + dt.timedelta(hours=40))
    assert sorted(r.v for r in read.collect()) == [float(h) for h in range(30, 40)]
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(poll_date" in plan and "PushedFilters: [IsNotNull(t), GreaterThanOrEqual(t" in plan
    assert table.read(after=START, until=START + dt.timedelta(hours=2)).count() == 2


def random_rows(n, seed):
    rng = random.Random(seed)
    keys = {(rng.choice("abc"), rng.randrange(24 * 9)) for _ in range(n)}
    return [(s, h, rng.choice([None, 1.0, 1.0, 1.0, 2.0])) for s, h in sorted(keys)]


@pytest.mark.parametrize("seed", [1, 2])
def test_incremental_equals_full(spark, tmp_path, seed):
    rows = random_rows(150, seed)
    cuts = sorted(random.Random(seed).sample(range(24 * 9), 2))
    source, target = FeedTable(spark, str(tmp_path / "s"), "t"), FeedTable(spark, str(tmp_path / "g"), "t")
    parts = [[r for r in rows if lo <= r[1] < hi] for lo, hi in zip([0, *cuts], [*cuts, 24 * 9])]
    for part in parts:
        source.append(frame(spark, part))
        assert build_features(source, target, SPEC, COLUMNS, None)
        assert not build_features(source, target, SPEC, COLUMNS, None)
    full = change_features(frame(spark, rows), SPEC).select(*COLUMNS)
    assert collected(target.read()) == collected(full)


def test_lookback_bound(spark, tmp_path):
    """Predecessors beyond the bound are unknown, those within it are found."""
    for name, days, expected in (("near", 2, None), ("far", 4, 1.0)):
        source = FeedTable(spark, str(tmp_path / f"s{name}"), "t")
        target = FeedTable(spark, str(tmp_path / f"g{name}"), "t")
        source.append(frame(spark, [("a", 0, 1.0)]))
        build_features(source, target, SPEC, COLUMNS, dt.timedelta(days=days))
        source.append(frame(spark, [("a", 72, 2.0)]))
        build_features(source, target, SPEC, COLUMNS, dt.timedelta(days=days))
        last = target.read().orderBy(F.desc("t")).first()
        assert last.v_change == expected


@pytest.mark.parametrize("lookback", [None, dt.timedelta(days=30)])
def test_late_rows(spark, tmp_path, lookback):
    rows = random_rows(120, 7)
    late = [r for r in rows if r[0] == "b" and 40 <= r[1] < 90]
    source, target = FeedTable(spark, str(tmp_path / "s"), "t"), FeedTable(spark, str(tmp_path / "g"), "t")
    source.append(frame(spark, [r for r in rows if r not in late]))
    build_features(source, target, SPEC, COLUMNS, lookback)
    source.append(frame(spark, late))
    # dropped by the watermark for good, and counted
    assert not build_features(source, target, SPEC, COLUMNS, lookback)
    assert late_keys(source, target, KEY).count() == len(late) > 0
    assert repair_late_rows(source, target, SPEC, COLUMNS, lookback)
    assert collected(target.read()) == collected(change_features(frame(spark, rows), SPEC).select(*COLUMNS))
    assert not repair_late_rows(source, target, SPEC, COLUMNS, lookback)


def test_empty_source(spark, tmp_path):
    source, target = FeedTable(spark, str(tmp_path / "s"), "t"), FeedTable(spark, str(tmp_path / "g"), "t")
    source.append(frame(spark, [("a", 1, 1.0)]).limit(0).unionByName(frame(spark, [("a", 1, 1.0)])))
    build_features(source, target, SPEC, COLUMNS, None)
    assert target.read().count() == 1


PLAN = SilverPlan(preset.FEED, preset.derived_columns, preset.quality_rules)
GOLD = preset.GOLD_CONTRACT.names


def poll_rows(spark, n, contracts=3, start=0):
    rows = []
    for i in range(start, start + n):
        at = (dt.datetime(2026, 9, 18) + dt.timedelta(minutes=10 * i)).isoformat() + "+00:00"
        records = [record(symbol=f"C{c}", rate=0.0001 * (i // 7 + c), mark_price=100.0 + i) for c in range(contracts)]
        rows.append((at, 200, {}, "u", body(*records, record(symbol="E", base_coin="ETH")), None))
    return rows


def test_three_layers_and_gates(spark, tmp_path):
    from pollpipe.sources import ENVELOPE

    bronze, silver, gold, unkeyed = (FeedTable(spark, str(tmp_path / n), "fetched_at") for n in "bsgu")
    for start in (0, 8):
        polls = poll_rows(spark, 8, start=start)
        polls.append((polls[0][0], 200, {}, "u", "broken", None))
        if start:
            polls.append((polls[-1][0], 200, {}, "u", body(record(symbol=None)), None))
        load_bronze(spark.createDataFrame(polls, ENVELOPE), preset.FEED, bronze)
        assert load_silver(bronze, silver, PLAN, unkeyed)
        assert not load_silver(bronze, silver, PLAN, unkeyed)
        assert load_gold(silver, gold, preset.FEATURES, GOLD, dt.timedelta(days=preset.LOOKBACK_DAYS))
    assert tuple(gold.read().columns) == GOLD
    rows = gold.read().where("symbol = 'C1'").orderBy("fetched_at").collect()
    assert [r.is_frozen for r in rows[:7]] == [None] * 5 + [True, True] and rows[7].is_frozen is False
    assert [r.is_large_move for r in rows[6:9]] == [False, True, False]
    assert rows[1].price_change == 1.0 and rows[1].oi_change == 0.0
    assert unkeyed.read().count() == 1

    key, time = preset.FEED.key, "fetched_at"
    domain = bronze.read()
    as_of = F.lit(dt.datetime(2026, 9, 18, 2, 40))
    fine = gates.bronze_gate(domain, key, time, 3, 30, as_of, strict=True, domain=preset.FEED.domain)
    assert fine.values["unkeyed_rows"] == 1
    assert fine.ok and fine.values["latest_poll_contract_count"] == 3 and fine.values["age_minutes"] == 10.0
    poor = gates.bronze_gate(domain, key, time, 35, 5, as_of, domain=preset.FEED.domain)
    assert len(poor.breaches) == 2
    eligible = F.col("rate").isNotNull() & (F.col("interval_hours") > 0)
    derived = ["rate_per_8h", "rate_annualized"]
    assert gates.silver_gate(domain, silver.read(), key, time, eligible, derived, 30, domain=preset.FEED.domain).ok
    holes = silver.read().withColumn("rate_per_8h", F.lit(None).cast("double"))
    assert "NULL" in gates.silver_gate(domain, holes, key, time, eligible, derived, 30).breaches[0]
    assert gates.gold_gate(silver.read(), gold.read(), key, time, 30).ok
    old = gold.read(before=dt.datetime(2026, 9, 18, 1))
    assert "lags" in gates.gold_gate(silver.read(), old, key, time, 30).breaches[0]
    assert "no data" in gates.gold_gate(silver.read(), gold.read().limit(0), key, time, 30).breaches[0]
    domain = accepted(bronze.read()).where("base_coin = 'BTC' and symbol is not null")
    assert gates.reconciliation_gate(domain, silver.read(), gold.read(), strict=True).ok
    twice = gold.read().unionByName(gold.read())
    assert "duplicate" in gates.gold_gate(silver.read(), twice, key, time, 30).breaches[0]
    with pytest.raises(ValueError):
        gates.reconciliation_gate(domain, silver.read(), old, strict=True)


def test_streams_equal_batch(spark, tmp_path):
    from pollpipe.sources import ENVELOPE

    landing = str(tmp_path / "in")
    bronze, silver, unkeyed = (FeedTable(spark, str(tmp_path / n), "fetched_at") for n in "bsu")
    for start in (0, 6):
        spark.createDataFrame(poll_rows(spark, 6, start=start), ENVELOPE).write.mode("append").json(landing)
        stream_bronze(stream_polls(spark, landing, 1), preset.FEED, bronze, str(tmp_path / "c1")).awaitTermination()
        stream_silver(bronze, silver, PLAN, str(tmp_path / "c2"), unkeyed).awaitTermination()
    assert bronze.read().count() == 12 * 4
    assert silver.read().count() == 12 * 3
    assert repeated_keys(silver.read(), preset.FEED.key).count() == 0


@pytest.mark.parametrize("late", ["drop", "repair"])
def test_feature_stream_with_late_files(spark, tmp_path, late):
    rows = random_rows(90, 3)
    middle = [r for r in rows if 60 <= r[1] < 100]
    source, target = FeedTable(spark, str(tmp_path / "s"), "t"), FeedTable(spark, str(tmp_path / "g"), "t")
    landing = str(tmp_path / "in")
    for part in ([r for r in rows if r not in middle], middle):
        frame(spark, part).coalesce(1).write.mode("append").parquet(landing)
        arrivals = spark.readStream.schema(SCHEMA).parquet(landing)
        stream_features(
            arrivals, source, target, SPEC, COLUMNS, dt.timedelta(days=30), str(tmp_path / "c"), late
        ).awaitTermination()
    expected = rows if late == "repair" else [r for r in rows if r not in middle]
    assert collected(target.read()) == collected(change_features(frame(spark, expected), SPEC).select(*COLUMNS))


def layer_set(spark, tmp_path):
    return [FeedTable(spark, str(tmp_path / n), "fetched_at") for n in ("bronze", "silver", "gold", "unkeyed")]


def test_silver_takes_late_untimed_and_same_instant_rows(spark, tmp_path):
    from pollpipe.sources import ENVELOPE

    bronze, silver, _, unkeyed = layer_set(spark, tmp_path)
    polls = poll_rows(spark, 6, contracts=2)
    first, late = [polls[0], polls[5]], [polls[2], polls[5][:4] + (body(record(symbol="LATE")), None)]
    load_bronze(spark.createDataFrame(first, ENVELOPE), preset.FEED, bronze)
    assert load_silver(bronze, silver, PLAN, unkeyed).rows == 4
    untimed = ("no time", 200, {}, "u", body(record(symbol="T")), None)
    load_bronze(spark.createDataFrame([*late, untimed, untimed], ENVELOPE), preset.FEED, bronze)
    added = load_silver(bronze, silver, PLAN, unkeyed)
    assert (added.rows, added.copies, added.unkeyed) == (3, 0, 1)
    assert [r.copies for r in unkeyed.read().collect()] == [2]
    again = load_silver(bronze, silver, PLAN, unkeyed)
    assert not again and (again.rows, again.unkeyed) == (0, 0)
    assert silver.read().count() == 7 and unkeyed.read().count() == 1
    older = poll_rows(spark, 1, contracts=2, start=-200)
    load_bronze(spark.createDataFrame(older, ENVELOPE), preset.FEED, bronze)
    assert not load_silver(bronze, silver, PLAN, unkeyed)
    assert load_silver(bronze, silver, PLAN, unkeyed, reread=dt.timedelta(days=3)).rows == 2


@pytest.mark.parametrize("keep", [True, False])
def test_copies_are_counted_and_gold_has_one_row_per_key(spark, tmp_path, keep):
    from pollpipe.sources import ENVELOPE

    bronze, silver, gold, unkeyed = layer_set(spark, tmp_path)
    polls = poll_rows(spark, 4, contracts=2)
    changed = [p[:4] + (p[4].replace('"mark_price": 10', '"mark_price": 20'), None) for p in polls[1:3]]
    load_bronze(spark.createDataFrame(polls + changed, ENVELOPE), preset.FEED, bronze)
    added = load_silver(bronze, silver, PLAN, unkeyed, keep_copies=keep)
    assert (added.rows, added.copies, added.dropped) == ((12, 4, 0) if keep else (8, 0, 4))
    for _ in range(2):
        load_gold(silver, gold, preset.FEATURES, GOLD, dt.timedelta(days=2))
    assert gold.read().count() == 8 and repeated_keys(gold.read(), preset.FEED.key).count() == 0


def test_gates_survive_unreadable_times(spark, tmp_path):
    rows = [("e", "a", "2024-01-01T00:10:00+00:00"), ("e", "b", "2024-01-01T02:00:00+02:00"), ("e", "c", "zzz"), ("e", None, None)]
    df = spark.createDataFrame(rows, "exchange string, symbol string, fetched_at string")
    lag = gates.layer_lag(df, df.where("symbol = 'b'"), "fetched_at", ("up", "down")).first()
    assert lag.lag_minutes == 10.0
    judged = gates.gate_rows(df, "fetched_at", ("exchange", "e"), START)
    assert sorted(r.symbol for r in judged.collect()) == ["a", "b"]


def test_dates_come_from_partition_names(spark, tmp_path):
    table = FeedTable(spark, str(tmp_path / "t"), "t")
    table.append(frame(spark, [("a", 1, 1.0), ("a", 49, 2.0)]))
    untimed = frame(spark, [("a", 1, 1.0)]).withColumn("t", F.lit(None).cast("timestamp"))
    table.append(untimed)
    assert table.dates() == [START.date(), START.date() + dt.timedelta(days=2)]
    assert table.dates_in(untimed) == [None] and table.read(dates=[None]).count() == 1
    since = START + dt.timedelta(days=1)
    assert table.read(since=since).count() == 1 and table.read(since=since, untimed=True).count() == 2
