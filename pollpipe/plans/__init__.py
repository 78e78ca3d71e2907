from .carried import Carried, SeriesState, load_gold_carried, reach
from .features_load import (
    affected_by_late_rows, build_features, earliest, features_of_new_rows, late_keys, repair_late_rows,
)
from .ledger import KeyLedger, rows_gate
from .partials import DayPartials, PartialSpec
from .layers import SilverPlan, load_bronze, load_gold, load_silver, load_silver_arrived, silver_rows

__all__ = [
    "Carried", "DayPartials", "KeyLedger", "PartialSpec", "SeriesState", "SilverPlan", "affected_by_late_rows", "build_features", "earliest", "features_of_new_rows",
    "late_keys", "load_bronze", "load_gold", "load_gold_carried", "load_silver", "load_silver_arrived", "reach",
    "repair_late_rows", "rows_gate", "silver_rows",
]
