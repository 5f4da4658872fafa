"""Profiles of a stream as discarding panes.

Each micro-batch is profiled on its own (only the new rows: a *discarding*
pane) and appended to a pane store under ``<path>/panes/pane=<batch_id>``.
Readers merge the panes per period with ``merge_panes``; because profiles are
mergeable, the merged panes equal the profile of all rows seen.

* Exactly once: a replayed micro-batch rewrites its own ``pane=<id>``
  directory (overwrite), so retries never duplicate a pane.
* Early firing: by default the trigger decides pane size -- ``processingTime``
  for the time part, the source's ``maxFilesPerTrigger`` /
  ``maxOffsetsPerTrigger`` for the count part.  With ``pane_rows`` panes are
  exact per period: a pane closes after ``pane_rows`` rows of one period or
  after ``pane_wait`` of processing time, whichever comes first (rows are
  batched per period by ``stream_group_into_batches`` and profiled per
  ``(period, batch_id)``).
* Late data: there is no implicit rule.  With ``lateness`` (e.g.
  ``"2 days"``) rows older than ``max event time of earlier panes - lateness``
  are late and counted per pane in ``<path>/meta``; without it no row is (the
  right default for replaying bounded tables).  ``late="drop"`` leaves them out;
  ``late="keep"`` writes them, as they came, to ``<path>/late/pane=<batch_id>``.
  ``correct_panes`` profiles late rows that no correction has yet into one more
  store, ``<path>/corrections/pane=<first>-<last>``, and ``merge_panes`` merges the
  panes alone (what was on time) or with the corrections (all rows).
* Many panes: ``compact_panes`` folds all but the newest pane into one store per
  period (``strata.sinks.history``); ``merge_panes`` reads the result alike.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException
from pyspark.sql.streaming import StreamingQuery

from strata.functions.metrics import quote
from strata.functions.names import free_name
from strata.functions.periods import as_wall_clock
from strata.operators.merge import merge_profiles
from strata.operators.profile import profile, with_period
from strata.sinks.history import History
from strata.sinks.manifest import Manifest
from strata.streaming.batches import batch_column as batch_name
from strata.streaming.batches import stream_group_into_batches

PANE = "pane"
#: Key of count-or-time panes in the pane store.
BATCH = "batch_id"

_LATENESS_RE = re.compile(r"^\s*(\d+)\s*(second|minute|hour|day|week)s?\s*$", re.I)


def parse_lateness(text: str) -> dt.timedelta:
    m = _LATENESS_RE.match(text)
    if not m:
        raise ValueError(f"lateness must look like '30 minutes' or '2 days', got {text!r}")
    n, unit = int(m.group(1)), m.group(2).lower()
    return dt.timedelta(**{unit + "s": n})


class PaneWriter:
    """``foreachBatch`` function: profile one micro-batch into one pane."""

    def __init__(self, path: str, date_column: str, freq: str = "D", *,
                 lateness: str | None = None, late: str = "drop", batch_column: str | None = None,
                 **profile_kwargs):
        if late not in ("drop", "keep"):
            raise ValueError("late must be 'drop' or 'keep'")
        by = profile_kwargs.get("by")
        if {PANE, BATCH} & set([by] if isinstance(by, str) else by or []):
            raise ValueError(f"rename the key columns {PANE!r} and {BATCH!r}: the pane store has its own")
        self.path = path.rstrip("/")
        self.late = late
        self.batch_column = batch_column
        self.date_column = date_column
        self.freq = freq
        self.lateness = parse_lateness(lateness) if lateness else None
        self.profile_kwargs = profile_kwargs
        self._max_event: dt.datetime | None = None  # of all panes up to self._newest
        self._newest: int | None = None

    @property
    def panes_path(self) -> str:
        return f"{self.path}/panes"

    @property
    def late_path(self) -> str:
        return f"{self.path}/late"

    @property
    def meta_path(self) -> str:
        return f"{self.path}/meta"

    def _watermark(self, spark: SparkSession, batch_id: int) -> dt.datetime | None:
        """Max event time of the panes before ``batch_id`` minus the lateness
        (recovered from the meta table after a restart)."""
        if self.lateness is None:
            return None
        if self._newest is None or self._newest >= batch_id:
            try:  # start, restart or replay: recover from the meta table (any file system)
                row = (spark.read.parquet(self.meta_path).where(F.col("pane") < batch_id)
                       .agg(F.max("max_event").alias("m")).first())
                self._max_event = row.m
            except AnalysisException:  # no pane written yet
                self._max_event = None
        return None if self._max_event is None else self._max_event - self.lateness

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        dtype = batch.schema[self.date_column].dataType
        event = as_wall_clock(F.col(quote(self.date_column)), dtype, self.profile_kwargs.get("unit"))
        wm = self._watermark(spark, batch_id)
        late = F.coalesce(event < F.lit(wm), F.lit(False)) if wm is not None else F.lit(False)
        batch = batch.persist()
        try:
            meta = batch.agg(F.max(event).alias("max_event"),
                             F.count(F.lit(1)).alias("rows"),
                             F.count_if(late).alias("late_rows")).first()
            kept = batch.where(~late) if wm is not None else batch
            kwargs = dict(self.profile_kwargs)
            if self.batch_column is not None:
                by = kwargs.get("by") or []
                kwargs["by"] = [*([by] if isinstance(by, str) else by), self.batch_column]
                kwargs.setdefault("columns", [c for c in batch.columns if c != self.batch_column])
            if self.late == "keep" and meta.late_rows:
                raw = batch.where(late)
                (raw.drop(self.batch_column) if self.batch_column else raw).write.mode("overwrite").parquet(
                    f"{self.late_path}/{PANE}={batch_id}")
            if meta.rows > meta.late_rows:  # an empty micro-batch adds no pane files
                store = profile(kept, self.date_column, self.freq, **kwargs)
                if self.batch_column is not None:
                    store = store.withColumnRenamed(self.batch_column, BATCH)
                (store.hint("rebalance").write.mode("overwrite")
                 .parquet(f"{self.panes_path}/pane={batch_id}"))
            spark.createDataFrame(
                [(meta.max_event, int(meta.rows), int(meta.late_rows), wm)],
                "max_event timestamp_ntz, rows bigint, late_rows bigint, watermark timestamp_ntz",
            ).write.mode("overwrite").parquet(f"{self.meta_path}/pane={batch_id}")
            self._max_event = max((t for t in (self._max_event, meta.max_event) if t is not None), default=None)
            self._newest = batch_id
        finally:
            batch.unpersist()


def profile_stream(stream: DataFrame, path: str, date_column: str, freq: str = "D", *,
                   checkpoint: str, trigger: dict | None = None, lateness: str | None = None, late: str = "drop",
                   query_name: str | None = None, pane_rows: int | None = None,
                   pane_wait: str = "30 seconds", shards: int = 16,
                   **profile_kwargs) -> StreamingQuery:
    """Start a streaming query that writes discarding profile panes to ``path``.

    ``trigger`` is passed to ``DataStreamWriter.trigger`` (e.g.
    ``{"processingTime": "30 seconds"}`` or ``{"availableNow": True}``).
    ``pane_rows`` switches to exact count-or-time panes per period (see module
    doc); ``shards`` spreads one hot period over that many state groups.
    """
    batch_column = None
    if pane_rows is not None:
        by = profile_kwargs.get("by") or []
        by = [by] if isinstance(by, str) else list(by)
        columns = profile_kwargs.pop("columns", None) or [c for c in stream.columns if c not in by]
        label = free_name(stream.columns, "__period")
        labelled = with_period(stream, date_column, freq, unit=profile_kwargs.get("unit"),
                               null_dates=profile_kwargs.get("null_dates", "drop"), out=label)
        batch_column = batch_name(labelled)
        stream = stream_group_into_batches(labelled, label, pane_rows, max_wait=pane_wait, shards=shards).drop(label)
        profile_kwargs["columns"] = columns
    writer = PaneWriter(path, date_column, freq, lateness=lateness, late=late, batch_column=batch_column,
                        **profile_kwargs)
    w = stream.writeStream.foreachBatch(writer).option("checkpointLocation", checkpoint)
    if trigger:
        w = w.trigger(**trigger)
    if query_name:
        w = w.queryName(query_name)
    return w.start()


def read_panes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path.rstrip('/')}/panes")


def pane_history(spark: SparkSession, path: str) -> History:
    return History(spark, f"{path.rstrip('/')}/panes", PANE, drop=[BATCH])


def merge_panes(spark: SparkSession, path: str, *, corrections: bool = False, **merge_kwargs) -> DataFrame:
    """All panes merged to one profile per period (and column); with
    ``corrections`` the late rows that ``correct_panes`` has profiled, too."""
    history = pane_history(spark, path)
    rows = history.rows() if history.versions() else read_panes(spark, path).drop(PANE, BATCH)
    if corrections:
        more = _corrections(spark, path)
        if more.units():
            rows = rows.unionByName(more.rows())
    return merge_profiles(rows, **merge_kwargs)


def compact_panes(spark: SparkSession, path: str) -> Manifest:
    """Fold all panes but the newest one, which a restarted stream may write again."""
    return pane_history(spark, path).compact(keep_newest=1)


def _corrections(spark: SparkSession, path: str) -> History:
    return History(spark, f"{path.rstrip('/')}/corrections", PANE)


def correct_panes(spark: SparkSession, path: str, date_column: str, freq: str = "D", **profile_kwargs) -> list[int]:
    """Profile the late rows of panes that no correction covers yet; returns those
    panes.  Use the arguments of the stream's own profile.  A correction counts once
    it is whole, so a call that dies is simply repeated."""
    path = path.rstrip("/")
    late = History(spark, f"{path}/late", PANE)
    done = [u.partition("=")[2].partition("-")[2] for u in _corrections(spark, path).units()]
    covered = max(map(int, done), default=-1)
    todo = [int(u.partition("=")[2]) for u in late.units()]
    todo = [p for p in todo if p > covered]
    if todo:
        rows = spark.read.option("basePath", f"{path}/late").parquet(*[f"{path}/late/{PANE}={p}" for p in todo]).drop(PANE)
        store = profile(rows, date_column, freq, **profile_kwargs)
        (store.hint("rebalance").write.mode("overwrite")
         .parquet(f"{path}/corrections/{PANE}={min(todo)}-{max(todo)}"))
    return todo


def pane_report(spark: SparkSession, path: str) -> DataFrame:
    """Per pane: rows seen, late rows dropped, the watermark applied."""
    return spark.read.parquet(f"{path.rstrip('/')}/meta")
