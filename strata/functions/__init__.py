"""Column expressions: period labels and per-column profile metrics."""

from strata.functions.metrics import METRIC_COLUMNS, SketchConfig, type_class
from strata.functions.periods import (
    as_wall_clock, day_start_epoch, epoch_micros, epoch_seconds, from_epoch, label_text,
    parse_frequency, parse_timestamp, period_label,
)

__all__ = [
    "METRIC_COLUMNS", "SketchConfig", "type_class", "as_wall_clock", "day_start_epoch",
    "epoch_micros", "epoch_seconds", "from_epoch", "label_text", "parse_frequency",
    "parse_timestamp", "period_label",
]
