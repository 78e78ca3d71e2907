"""The three layer loads: landed polls to bronze, bronze to silver, silver to gold."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.quality import Rule
from ..operators.clean import clean_records
from ..operators.explode import accepted, explode_polls
from ..operators.features import ChangeSpec
from ..operators.merge import Inserted, insert_all
from ..sources.arrivals import FILES_PER_BATCH, Arrivals
from ..sources.tables import FeedTable
from ..spec import FeedSpec
from .features_load import build_features


@dataclass(frozen=True)
class SilverPlan:
    """What turns bronze into silver: the feed, and functions that give the derived columns
    and the quality rules (column expressions need a running session)."""

    feed: FeedSpec
    derived: Callable[[], Mapping[str, Column]]
    rules: Callable[[], Sequence[Rule]]


def load_bronze(polls: DataFrame, feed: FeedSpec, bronze: FeedTable) -> None:
    """Append every record of the polls, of all domains, in one pass and one commit.

    Rejected polls, payloads and records are rows of the same table with a
    ``reject_reason``; :func:`~pollpipe.operators.accepted` and
    :func:`~pollpipe.operators.rejected` tell them apart with a filter the scan can use.
    """
    bronze.append(explode_polls(polls, feed.vendor_fields))


def silver_rows(bronze: DataFrame, plan: SilverPlan) -> DataFrame:
    """Typed, tagged rows of the domain. No row is dropped."""
    records = accepted(bronze) if "reject_reason" in bronze.columns else bronze
    if plan.feed.domain is not None:
        name, value = plan.feed.domain
        records = records.where(F.col(name) == F.lit(value))
    return clean_records(records, plan.feed.fields, plan.derived(), plan.rules())


def load_silver(
    bronze: FeedTable,
    silver: FeedTable,
    plan: SilverPlan,
    unkeyed: FeedTable,
    reread: dt.timedelta = dt.timedelta(0),
    keep_copies: bool = True,
) -> Inserted:
    """Insert the bronze rows that silver does not have. Returns what was added.

    Bronze is read again from the start of the newest silver day, or ``reread`` before it, so
    rows that arrive late within that time, or share the newest instant, are taken; known keys
    are skipped, and a rerun inserts nothing twice. Rows without a complete key, which includes
    those whose time is unreadable, go to ``unkeyed``. Copies of a key within one load all go
    to silver, where the key gate sees them, unless ``keep_copies`` is unset.
    """
    newest = silver.max_time()
    since = None if newest is None else dt.datetime.combine(newest.date(), dt.time()) - reread
    rows = silver_rows(bronze.read(since=since, untimed=True), plan)
    return insert_all(silver, unkeyed, rows, plan.feed.key, since, keep_copies)


def load_silver_arrived(
    bronze: FeedTable,
    silver: FeedTable,
    plan: SilverPlan,
    unkeyed: FeedTable,
    log: str,
    files_per_batch: int = FILES_PER_BATCH,
    keep_copies: bool = True,
) -> Inserted:
    """Insert the rows of all bronze files not taken yet, however old their times are.

    ``log`` is the folder that remembers the files taken. Only new files are read, and of silver
    only the keys of the dates that those files belong to. Each batch of files is committed
    after its rows are in; one that was cut off is repeated, which inserts nothing twice.
    """
    arrivals, added = Arrivals(bronze, log), Inserted()
    while batch := arrivals.next_batch(files_per_batch):
        rows = silver_rows(batch.read(), plan)
        added += insert_all(silver, unkeyed, rows, plan.feed.key, None, keep_copies, batch.dates)
        arrivals.commit(batch)
    return added


def load_gold(
    silver: FeedTable,
    gold: FeedTable,
    spec: ChangeSpec,
    columns: Sequence[str],
    lookback: dt.timedelta | None,
    domain: tuple[str, str] | None = None,
) -> bool:
    """Features of the silver rows newer than gold, upserted by key; one row per key of silver.

    Silver rows that came late are left to :func:`~pollpipe.plans.repair_late_rows`.
    """
    return build_features(silver, gold, spec, columns, lookback, domain)
