"""Preset for a perpetual-futures rate feed: fields, rules, features, contract, limits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.derive import rate_per_basis, rate_per_year, seconds_between
from ..functions.quality import Rule
from ..operators.features import ChangeSpec
from ..spec import Contract, ContractColumn, FeedSpec, Field

# Field names, types and nullability of the feed, tag names, thresholds and
# table contract. Results are compared by these names and numbers.
FEED = FeedSpec(
    fields=(
        Field("exchange", "str"),
        Field("symbol", "str"),
        Field("base_coin", "str"),
        Field("rate", "float"),
        Field("predicted_rate", "float", nullable=True),
        Field("interval_hours", "int"),
        Field("next_funding_time", "datetime"),
        Field("updated_at", "datetime"),
        Field("fetched_at", "datetime"),
        Field("margin_type", "str"),
        Field("asset_class", "str"),
        Field("mark_price", "float"),
        Field("mark_price_updated_at", "datetime"),
        Field("open_interest", "float", nullable=True),
        Field("market_cap_rank", "int", nullable=True),
        Field("age_seconds", "int"),
        Field("data_source", "str"),
        Field("freshness_sla_seconds", "int"),
        Field("is_stale", "bool"),
    ),
    entity=("exchange", "symbol"),
    time="fetched_at",
    domain=("base_coin", "BTC"),
)

MAX_ABS_RATE = 0.05
LARGE_MOVE_THRESHOLD = 0.00008
FROZEN_LOOKBACK = 5
LOOKBACK_DAYS = 2
MIN_CONTRACTS_PER_POLL = 35
MAX_AGE_MINUTES = 30
MAX_LAG_MINUTES = 30



def derived_columns() -> dict[str, Column]:
    return {
        "rate_per_8h": rate_per_basis(F.col("rate"), F.col("interval_hours")),
        "rate_annualized": rate_per_year(F.col("rate"), F.col("interval_hours")),
        "poll_lag_seconds": seconds_between(F.col("fetched_at"), F.col("updated_at")),
    }


def quality_rules(
    rate: str = "rate",
    interval_hours: str = "interval_hours",
    mark_price: str = "mark_price",
    open_interest: str = "open_interest",
    fetched_at: str = "fetched_at",
    updated_at: str = "updated_at",
    next_funding_time: str = "next_funding_time",
    age_seconds: str = "age_seconds",
) -> list[Rule]:
    """The rules in tag order. Arguments name the columns they look at."""
    c = F.col
    return [
        Rule("invalid_interval_hours", c(interval_hours) <= 0),
        Rule("invalid_age_seconds", c(age_seconds) <= 0),
        Rule("updated_at_after_fetched_at", c(updated_at) > c(fetched_at)),
        Rule("stale_next_funding_time", c(next_funding_time) < c(fetched_at)),
        Rule("next_funding_time_not_after_updated_at", c(next_funding_time) <= c(updated_at)),
        Rule("invalid_mark_price", c(mark_price) <= 0),
        Rule("negative_open_interest", c(open_interest) < 0),
        Rule("implausible_rate_magnitude", F.abs(c(rate)) > MAX_ABS_RATE),
    ]


FEATURES = ChangeSpec(
    entity=FEED.entity,
    time=FEED.time,
    measure="rate_per_8h",
    change_as="funding_change",
    threshold=LARGE_MOVE_THRESHOLD,
    changes=(("open_interest", "oi_change"), ("mark_price", "price_change")),
    lookback=FROZEN_LOOKBACK,
)

GOLD_CONTRACT = Contract(
    columns=(
        ContractColumn("exchange", "string"),
        ContractColumn("symbol", "string"),
        ContractColumn("margin_type", "string", values=("linear", "inverse")),
        ContractColumn("fetched_at", "timestamp"),
        ContractColumn("rate_per_8h", "double"),
        ContractColumn("funding_change", "double", nullable=True),
        ContractColumn("is_large_move", "boolean", nullable=True),
        ContractColumn("is_frozen", "boolean", nullable=True),
        ContractColumn("open_interest", "double", nullable=True),
        ContractColumn("oi_change", "double", nullable=True),
        ContractColumn("mark_price", "double"),
        ContractColumn("price_change", "double", nullable=True),
    ),
    grain=FEED.key,
    time=FEED.time,
    max_lag_minutes=MAX_LAG_MINUTES,
)
