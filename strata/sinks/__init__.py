"""Sinks: partitioned Parquet, append-only runs and their compaction, JSON text, caller-supplied
writers, a DataFrame-writer service sink, fan-out."""

from strata.sinks.history import Conflict, History, compact, read_history
from strata.sinks.service import ProfileServiceSink
from strata.sinks.writers import (
    fan_out, read_merged, read_profiles, read_text_profiles, write_each, write_profiles, write_run,
    write_text,
)

__all__ = ["Conflict", "History", "ProfileServiceSink", "compact", "read_history", "fan_out", "read_merged", "read_profiles", "read_text_profiles",
           "write_each", "write_profiles", "write_run", "write_text"]
