"""Structured Streaming: profile panes per micro-batch (merged on read) and
size-bounded batches per key with a processing-time flush."""

from strata.streaming.batches import stream_group_into_batches
from strata.streaming.windows import profile_stream_windowed, rows_dropped_by_watermark
from strata.streaming.panes import (
    PaneWriter, merge_panes, pane_report, parse_lateness, profile_stream, read_panes,
)

__all__ = ["PaneWriter", "merge_panes", "pane_report", "parse_lateness", "profile_stream",
           "profile_stream_windowed", "read_panes", "rows_dropped_by_watermark",
           "stream_group_into_batches"]
