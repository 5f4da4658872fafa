"""strata: mergeable per-column, per-period dataset profiles on Spark.

Main entry points::

    profile(df, date_column, freq)       the profile store (one row per period and column)
    merge_profiles / merge_stores / rollup / lookup
    profile_table / exact_metrics / frequent_items / profile_size
    profile_job(spark, input, ...)       input -> profile -> sinks
    read_input / write_profiles / read_profiles / write_run / read_merged
    count_per_period / distinct_periods / group_into_batches
    custom_profile / merge_custom        user metrics merged by sum/min/max
    UserAggregate / user_profile / merge_user / rollup_user / finish_user
    History / compact / read_history     runs folded into one store per period
    profile_stream / profile_stream_windowed / stream_group_into_batches
"""

from strata.functions import SketchConfig, parse_frequency, period_label
from strata.operators import (
    exact_metrics, frequent_items, lookup, merge_profiles, merge_stores, profile, profile_size,
    profile_table, rollup,
)
from strata.operators.batches import group_into_batches
from strata.operators.counts import count_per_period, distinct_periods
from strata.operators.custom import custom_profile, merge_custom
from strata.operators.user_aggregates import (
    Field, UserAggregate, finish_user, finish_user_long, merge_user, rollup_user, user_profile,
)
from strata.plans.jobs import profile_job
from strata.sinks import History, compact, read_history, read_merged, read_profiles, write_profiles, write_run
from strata.sources import read_input
from strata.streaming import profile_stream, profile_stream_windowed, stream_group_into_batches

__all__ = [
    "SketchConfig", "parse_frequency", "period_label", "exact_metrics", "frequent_items",
    "lookup", "merge_profiles", "merge_stores", "profile", "profile_size", "profile_table",
    "rollup", "group_into_batches", "count_per_period", "distinct_periods", "profile_job",
    "read_merged", "read_profiles", "write_profiles", "write_run", "read_input",
    "profile_stream", "profile_stream_windowed", "stream_group_into_batches",
    "custom_profile", "merge_custom", "Field", "UserAggregate", "user_profile", "merge_user", "rollup_user",
    "finish_user", "finish_user_long", "History", "compact", "read_history",
]
__version__ = "0.1.0"
