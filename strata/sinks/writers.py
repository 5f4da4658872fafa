"""Sinks for profile stores.

* ``write_profiles`` -- Parquet, one directory and one file per period, so a
  later job reads one period by partition pruning;
* ``write_text``     -- JSON lines (sketches base64), for eyeballing and diffing;
* ``write_each``     -- hand rows to a caller's writer function per partition,
  with an idempotency key, so retried tasks do not duplicate uploads;
* ``fan_out``        -- write once to Parquet, then feed every other sink from
  the written files (no recomputation, no dependence on cached blocks).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from urllib.parse import quote

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from strata.functions.metrics import METRIC_COLUMNS, STORE_TYPES
from strata.functions.names import free_name
from strata.operators.merge import merge_profiles
from strata.operators.profile import PERIOD_COLUMN
from strata.sinks import manifest

#: Directories of a store are named after this column; a store that has a key
#: column of that name gets directories with underscores added.
PARTITION_COLUMN = "period"


_LAYOUTS = {"month": "yyyy-MM", "period": "yyyy-MM-dd'T'HH-mm-ss"}


def write_profiles(store: DataFrame, path: str, mode: str = "overwrite",
                   layout: str = "month") -> None:
    """Write a store as Parquet.

    ``layout='month'`` (default): one directory per calendar month of
    ``dataset_ts``, rows sorted by period, so reading a date range prunes
    directories and row groups without a small file per day.  Rows are
    rebalanced by month (``REBALANCE`` hint): adaptive execution keeps a month
    in one task and file, and splits a month that outgrows the advisory
    partition size over several tasks instead of one.
    ``layout='period'``: one directory and one file per period (one profile
    per file, as the reference writes them; fine for coarse frequencies).
    ``layout='flat'``: plain files.  Stores without a period are written flat.
    """
    if layout not in ("month", "period", "flat"):
        raise ValueError("layout must be 'month', 'period' or 'flat'")
    if PERIOD_COLUMN not in store.columns or layout == "flat":
        store.write.mode(mode).parquet(path)
        return
    staged, part = by_directory(store, layout)
    staged = staged.repartition(part) if layout == "period" else staged.hint("rebalance", part)
    (staged.sortWithinPartitions(part, PERIOD_COLUMN, "column")
     .write.mode(mode).partitionBy(part).parquet(path))


def by_directory(store: DataFrame, layout: str = "month") -> tuple[DataFrame, str]:
    """``store`` with the column its directories are named after, and its name."""
    part = free_name(store.columns, PARTITION_COLUMN)
    return store.withColumn(part, F.date_format(PERIOD_COLUMN, _LAYOUTS[layout])), part


def directory_columns(df: DataFrame) -> list[str]:
    """Columns of a store that Spark read from directory names: they follow the
    store's own columns, whose last one is the last metric."""
    last = METRIC_COLUMNS[-1]
    return df.columns[df.columns.index(last) + 1:] if last in df.columns else [
        c for c in df.columns if c == PARTITION_COLUMN]


def read_profiles(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.parquet(path)
    return df.drop(*directory_columns(df))


RUN_COLUMN = "run"


def run_path(path: str, run_id: str) -> str:
    """Directory of one run in an append-only store."""
    return f"{path.rstrip('/')}/{RUN_COLUMN}={quote(str(run_id), safe='')}"


def write_run(store: DataFrame, path: str, run_id: str, layout: str = "month") -> None:
    """Add one run's profiles to an append-only store (incremental jobs).

    Files go to ``run=<run_id>/period=<month>`` and a run is replaced as a
    unit: writing it again (a retried or corrected job) removes all that the
    first attempt wrote, months that it no longer has included, and touches no
    other run.  ``read_merged`` folds all runs.
    """
    if layout not in _LAYOUTS or PERIOD_COLUMN not in store.columns:
        raise ValueError("write_run needs a periodic store and layout 'month' or 'period'")
    if RUN_COLUMN in store.columns:
        raise ValueError(f"rename the key column {RUN_COLUMN!r}: the store's directories are named after runs")
    spark = store.sparkSession
    if run_path("", run_id).lstrip("/") in manifest.load(spark, path.rstrip("/")).folded:
        raise ValueError(f"run {run_id!r} is folded into a base of {path} and cannot be replaced; revert that version first")
    staged, part = by_directory(store, layout)
    (staged.hint("rebalance", part).sortWithinPartitions(part, PERIOD_COLUMN, "column")
     .write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy(part).parquet(run_path(path, run_id)))


def read_merged(spark: SparkSession, path: str, start: str | None = None,
                end: str | None = None) -> DataFrame:
    """All runs of an append-only store merged per period and column.

    ``start``/``end`` (``'yyyy-MM'`` with the month layout) prune partition
    directories before any file is opened.  A compacted history (see
    ``strata.sinks.history``) is read from its bases and the runs since."""
    if manifest.versions(spark, path.rstrip("/")):
        from strata.sinks.history import read_history  # it reads runs through this module

        return read_history(spark, path, start, end)
    df = spark.read.parquet(path)
    return merge_profiles(between(df, start, end).drop(*directory_columns(df)))


def between(df: DataFrame, start: str | None, end: str | None) -> DataFrame:
    """Rows of the directories from ``start`` to ``end``."""
    part = next((c for c in directory_columns(df) if c.startswith(PARTITION_COLUMN)), None)
    if part is not None and start is not None:
        df = df.where(F.col(part).cast("string") >= F.lit(start))
    if part is not None and end is not None:
        df = df.where(F.col(part).cast("string") <= F.lit(end))
    return df


def write_text(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON object per row; Spark writes the sketch bytes as base64, so
    ``read_text_profiles`` gets a mergeable store back."""
    df.write.mode(mode).json(path)


def read_text_profiles(spark: SparkSession, path: str,
                       keys: dict[str, str] | None = None) -> DataFrame:
    """Read a store written by ``write_text``.  ``keys`` maps key columns to
    types (default: a periodic store, ``{"dataset_ts": "timestamp_ntz"}``)."""
    keys = {PERIOD_COLUMN: "timestamp_ntz"} if keys is None else keys
    ddl = ", ".join([f"`{k}` {t}" for k, t in keys.items()] +
                    [f"`{m}` {STORE_TYPES[m]}" for m in METRIC_COLUMNS])
    return spark.read.schema(ddl).json(path)


RowWriter = Callable[[Iterable[tuple[str, Row]]], None]


def write_each(store: DataFrame, writer: RowWriter, dataset_id: str) -> None:
    """Call ``writer`` once per partition with ``(key, row)`` pairs, where
    ``key = f"{dataset_id}/{dataset_ts}/{column}"`` identifies a profile row, so
    the receiving service can drop repeats when a task is retried."""
    has_period = PERIOD_COLUMN in store.columns

    def run(rows: Iterator[Row]) -> None:
        def keyed():
            for r in rows:
                ts = r[PERIOD_COLUMN].isoformat() if has_period and r[PERIOD_COLUMN] else "all"
                yield f"{dataset_id}/{ts}/{r['column']}", r
        writer(keyed())

    store.foreachPartition(run)


def fan_out(store: DataFrame, path: str, sinks: list[Callable[[DataFrame], None]],
            mode: str = "overwrite") -> DataFrame:
    """Write ``store`` to ``path`` once, then run every other sink on the
    written copy; returns the written copy."""
    write_profiles(store, path, mode)
    written = read_profiles(store.sparkSession, path)
    for sink in sinks:
        sink(written)
    return written
