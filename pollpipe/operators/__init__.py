from .audit import (
    GateError, GateResult, approx_key_metrics, derived_metrics, key_counts, key_metrics, latest_poll, layer_lag, lost_keys,
    row_counts, rows_at_latest, run_gate, side_by_side,
)
from .clean import cast_fields, clean_records, issue_rows
from .compare import Case, compare_results, key_differences, score_summary, scorecard, write_report
from .contract import check_contract, governed
from .digests import differing, differing_keys, digest_cells, digest_dates
from .explode import accepted, drift_counts, explode_polls, extra_fields, missing_fields, rejected
from .features import ChangeSpec, add_features, change_features
from .lags import Cut, choose_cut, latest_rows, latest_times, with_previous
from .merge import (
    Inserted, insert_all, insert_into, insert_only, insert_unkeyed, key_facts, new_rows, one_per_key, repeated_keys,
    split_null_keys, upsert, upsert_into,
)
from .profile import problem_fields, profile_fields
from .quantile import Percentile, approx_percentile, exact_percentile, merged_summary, percentile, value_summary
from .topk import cap_rows, top_k

__all__ = [
    "Case", "ChangeSpec", "Cut", "GateError", "GateResult", "Inserted", "Percentile", "accepted", "add_features", "approx_key_metrics",
    "approx_percentile", "cap_rows", "cast_fields", "change_features", "check_contract", "choose_cut",
    "clean_records", "compare_results", "derived_metrics", "differing", "differing_keys", "digest_cells", "digest_dates", "drift_counts", "exact_percentile", "explode_polls",
    "extra_fields", "governed", "insert_all", "insert_into", "insert_only", "insert_unkeyed", "issue_rows", "key_counts", "key_facts", "key_differences", "key_metrics",
    "latest_poll", "latest_rows", "latest_times", "layer_lag", "lost_keys", "merged_summary", "missing_fields", "new_rows", "one_per_key",
    "percentile", "problem_fields", "profile_fields", "rejected", "repeated_keys", "row_counts", "rows_at_latest", "run_gate",
    "score_summary", "scorecard", "side_by_side", "split_null_keys", "top_k", "upsert", "upsert_into",
    "value_summary", "with_previous", "write_report",
]
