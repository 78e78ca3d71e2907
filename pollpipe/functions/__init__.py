from .casting import cast_failed, cast_value, json_kind, json_text
from .changes import change, is_frozen, is_large_move, safe_corr
from .derive import minutes_between, rate_per_basis, rate_per_year, seconds_between, within_days
from .quality import Rule, has_issues, quality_tags

__all__ = [
    "Rule", "cast_failed", "cast_value", "change", "has_issues", "is_frozen", "is_large_move", "json_kind",
    "json_text", "minutes_between", "quality_tags", "rate_per_basis", "rate_per_year", "safe_corr",
    "seconds_between", "within_days",
]
