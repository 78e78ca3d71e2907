"""Layers compared by digests, and keys counted by date."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pollpipe.operators import GateError, differing, differing_keys, digest_cells, digest_dates
from pollpipe.plans import KeyLedger, rows_gate
from pollpipe.sources import FeedTable

START = dt.datetime(2024, 1, 1)
SCHEMA = "s string, t timestamp, v double"


def frame(spark, rows):
    return spark.createDataFrame([(s, None if h is None else START + dt.timedelta(hours=h), v) for s, h, v in rows], SCHEMA)


def plain_differences(left, right):
    sides = [Counter((s, h) for s, h, _ in side) for side in (left, right)]
    values = [{}, {}]
    for own, side in zip(values, (left, right), strict=True):
        for s, h, v in side:
            own.setdefault((s, h), Counter())[v] += 1
    found = set()
    for key in sides[0] | sides[1]:
        a, b = sides[0][key], sides[1][key]
        kind = "missing" if not b else "unexpected" if not a else "copies" if a != b else "changed" if values[0][key] != values[1][key] else None
        if kind:
            found.add((*key, a, b, kind))
    return found


@pytest.mark.parametrize("seed", [1, 2])
def test_differing_keys_are_those_of_the_plain_version(spark, seed):
    rng = random.Random(seed)
    left = [(rng.choice("abc"), rng.choice([None, *range(60)]), rng.choice([None, 1.0, 2.0])) for _ in range(120)]
    right = [r for r in left if rng.random() < 0.95]
    right += [(s, h, 9.0) for s, h, _ in rng.sample(left, 4)] + [("z", 3, 1.0), (None, 5, 1.0)]
    rng.shuffle(right)
    found = differing_keys(frame(spark, left), frame(spark, right), ["s"], "t", ["v"], parts=4)
    hours = lambda t: None if t is None else int((t - START).total_seconds() // 3600)
    got = {(r.s, hours(r.t), r.left_rows, r.right_rows, r.kind) for r in found.collect()}
    assert got == plain_differences(left, right)


def test_equal_layers_have_equal_digests_in_any_order_and_form(spark):
    rows = [("a", h, 1.0) for h in range(50)] + [("b", 3, None)]
    left, right = frame(spark, rows), frame(spark, rows[::-1]).repartition(5)
    as_text = right.withColumn("t", F.date_format("t", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"))
    assert differing(digest_cells(left, ["s"], "t"), digest_cells(as_text, ["s"], "t")).count() == 0
    assert digest_dates(digest_cells(left, ["s"], "t")).agg(F.sum("rows")).first()[0] == 51
    assert rows_gate(left, as_text, ["s"], "t").ok
    nothing = frame(spark, [])
    assert differing_keys(nothing, nothing, ["s"], "t").count() == 0


def test_one_row_exchanged_at_equal_counts_is_a_breach_that_names_it(spark):
    left = [("a", h, 1.0) for h in range(30)]
    result = rows_gate(frame(spark, left), frame(spark, [*left[:-1], ("b", 29, 1.0)]), ["s"], "t")
    assert not result.ok and "1 missing, 1 unexpected" in result.breaches[0] and "a/2024-01-02 05:00:00 missing" in result.breaches[0]
    with pytest.raises(GateError):
        rows_gate(frame(spark, left), frame(spark, left[1:]), ["s"], "t", strict=True)


def test_only_changed_dates_are_counted_again(spark, tmp_path):
    table = FeedTable(spark, str(tmp_path / "t"), "t")
    ledger = KeyLedger(table, str(tmp_path / "ledger"), ("s", "t"))
    assert ledger.refresh() == [] and tuple(ledger.metrics().first()) == (0, 0, 0)
    table.append(frame(spark, [("a", 1, 1.0), ("a", 25, 1.0), ("b", 25, 1.0), (None, 2, 1.0), ("a", None, 1.0)]))
    assert set(ledger.refresh()) == {START.date(), START.date() + dt.timedelta(days=1), None}
    assert ledger.refresh() == [] and ledger.gate().ok
    table.append(frame(spark, [("a", 25, 7.0)]))
    assert ledger.refresh() == [START.date() + dt.timedelta(days=1)]
    assert tuple(ledger.metrics().first()) == (6, 3, 2)
    result = ledger.gate()
    assert not result.ok and result.breaches == ("duplicate keys on 2024-01-02",)
    table.replace_dates(table.read(dates=[START.date() + dt.timedelta(days=1)]).dropDuplicates(["s", "t"]))
    assert ledger.gate().ok and tuple(ledger.metrics().first()) == (5, 3, 2)
    with pytest.raises(ValueError):
        KeyLedger(table, "x", ("s",))
