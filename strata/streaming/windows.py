"""Windowed profiles kept in Spark's state store (event-time semantics).

``profile_stream_windowed`` is the stateful counterpart of the pane writer:
one profile per tumbling event-time window, aggregated in the state store and
governed by a watermark.  In ``append`` mode each window is emitted once,
after the watermark passes its end; rows behind the watermark are dropped by
Spark and counted in the query progress (``numRowsDroppedByWatermark``).  In
``update`` mode every trigger emits the windows it changed (accumulating).

The partial aggregate runs before the state shuffle, so a hot window merges
at most one partial row per input partition per trigger.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.metrics import (
    METRIC_COLUMNS, SketchConfig, column_aggregates, quote, unpivot_struct,
)
from strata.functions.names import free_name
from strata.functions.periods import as_wall_clock, epoch_micros, ltz_to_utc_ntz
from strata.operators.profile import PERIOD_COLUMN


def profile_stream_windowed(stream: DataFrame, date_column: str, window: str = "1 day", *,
                            watermark: str, columns: Iterable[str] | None = None,
                            unit: str | None = None,
                            sketches: SketchConfig | None = None) -> DataFrame:
    """Streaming long profile ``(dataset_ts, column, metrics...)`` per window.

    ``dataset_ts`` is the window start (UTC wall clock); windows are aligned
    on the Unix epoch.  Write the result with ``outputMode('append')`` for
    final profiles or ``'update'`` for running ones.
    """
    cfg = sketches or SketchConfig()
    schema = {f.name: f.dataType for f in stream.schema.fields}
    names = list(columns) if columns is not None else list(stream.columns)
    wall = as_wall_clock(F.col(quote(date_column)), schema[date_column], unit)
    # Watermarks need an instant (TIMESTAMP): the UTC wall clock as epoch micros.
    event = F.timestamp_micros(epoch_micros(wall, T.TimestampNTZType()))
    at = free_name(stream.columns, "__event")
    src = stream.withColumn(at, event).where(F.col(at).isNotNull())
    aggs = [F.count(F.lit(1)).alias("__n")]
    for i, name in enumerate(names):
        aggs += column_aggregates(name, schema[name], f"__c{i}_", cfg)
    wide = (src.withWatermark(at, watermark)
            .groupBy(F.window(at, window).alias("__w")).agg(*aggs))
    available = set(wide.columns)
    structs = [unpivot_struct(name, schema[name], f"__c{i}_", "__n", available, cfg)
               for i, name in enumerate(names)]
    long = wide.select(ltz_to_utc_ntz(F.col("__w.start")).alias(PERIOD_COLUMN),
                       F.inline(F.array(*structs)))
    return long.select(PERIOD_COLUMN, *METRIC_COLUMNS)


def rows_dropped_by_watermark(query) -> int:
    """Late rows the windowed aggregation dropped, summed over the query's
    recent progress reports.  Spark counts rows reaching the stateful
    operator, i.e. rows after the partial aggregate, not input rows: a
    non-zero value means late data was discarded, not how many events."""
    total = 0
    for progress in query.recentProgress:
        ops = progress.get("stateOperators", []) if isinstance(progress, dict) else progress.stateOperators
        for op in ops:
            n = op.get("numRowsDroppedByWatermark", 0) if isinstance(op, dict) else op.numRowsDroppedByWatermark
            total += int(n or 0)
    return total
