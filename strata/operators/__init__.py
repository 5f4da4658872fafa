"""DataFrame operators: profiles, merges, counts, batches and views."""

from strata.operators.merge import (
    key_columns, lookup, merge_profiles, merge_stores, period_count, rollup, union_stores,
)
from strata.operators.profile import PERIOD_COLUMN, profile, with_period
from strata.operators.views import exact_metrics, frequent_items, profile_size, profile_table

__all__ = [
    "key_columns", "lookup", "merge_profiles", "merge_stores", "period_count", "rollup",
    "union_stores", "PERIOD_COLUMN", "profile", "with_period", "exact_metrics",
    "frequent_items", "profile_size", "profile_table",
]
