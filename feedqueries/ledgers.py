"""Layers compared by digests, and key uniqueness counted by date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from pollpipe.operators import differing_keys
from pollpipe.plans import KeyLedger

from .loads import EVENT_KEY, before, event_tables, from_
from .registry import fresh_dir, query, table

SERIES = ("user_id", "event_type")


@query("""
    SELECT user_id, event_type, ts, 'missing' AS kind FROM events WHERE event_id % 97 = 3
    UNION ALL SELECT -user_id - 1, event_type, ts, 'unexpected' FROM events WHERE event_id % 97 = 3
    UNION ALL SELECT user_id, event_type, ts, 'changed' FROM events WHERE event_id % 89 = 5 AND event_id % 97 <> 3
""")
def exchanged_row_breach(spark, sf_dir):
    """Rows exchanged for others at equal counts, and changed values: named by key, found by digests."""
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "ts", "event_id", "value")
    exchanged = F.when(F.col("event_id") % 97 == 3, -F.col("user_id") - 1).otherwise(F.col("user_id"))
    changed = F.when(F.col("event_id") % 89 == 5, F.col("value") + 1).otherwise(F.col("value"))
    other = events.withColumns({"user_id": exchanged, "value": changed})
    found = differing_keys(events, other, SERIES, "ts", ["value"])
    return found.select("user_id", "event_type", F.col("ts").cast("timestamp_ntz").alias("ts"), "kind")


@query("""
    SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS rows, count(DISTINCT (user_id, event_type, ts)) AS unique_keys
    FROM (SELECT * FROM events UNION ALL SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-20 00:00:00' AND event_id % 10 = 0)
    GROUP BY 1
""")
def unique_by_date(spark, sf_dir):
    """Rows and distinct keys per date after three loads, each counted on the dates it touched only."""
    (stored,) = event_tables(spark, "ledger")
    events = table(spark, sf_dir, "events").drop("props")
    ledger, cut = KeyLedger(stored, fresh_dir(spark, "counts"), EVENT_KEY), dt.datetime(2024, 1, 20)
    for part in (before(events, cut), from_(events, cut), from_(events, cut).where("event_id % 10 = 0")):
        stored.append(part)
        ledger.refresh()
    return ledger.counts().select(F.col("day").cast("string").alias("day"), "rows", "unique_keys")
