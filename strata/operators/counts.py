"""Row counts per period: the cheap control jobs next to the profile."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.metrics import quote
from strata.operators.batches import group_into_batches
from strata.operators.profile import PERIOD_COLUMN, with_period


def _periods(df: DataFrame, date_column: str, freq: str, unit: str | None, null_dates: str) -> DataFrame:
    """The period of every row, whatever the date column is called."""
    dates = df.select(F.col(quote(date_column)).alias("date"))
    return with_period(dates, "date", freq, unit=unit, null_dates=null_dates).select(PERIOD_COLUMN)


def count_per_period(df: DataFrame, date_column: str, freq: str = "D", *, unit: str | None = None,
                     null_dates: str = "drop") -> DataFrame:
    """``(dataset_ts, n)``: rows per period (partial counts before the shuffle)."""
    p = _periods(df, date_column, freq, unit, null_dates)
    return p.groupBy(PERIOD_COLUMN).agg(F.count(F.lit(1)).alias("n"))


def count_per_period_batched(df: DataFrame, date_column: str, freq: str = "D", *,
                             batch_size: int = 10_000, unit: str | None = None,
                             null_dates: str = "drop") -> DataFrame:
    """Same answer as ``count_per_period``, computed from size-bounded batches
    (count per batch, then sum per period)."""
    p = _periods(df, date_column, freq, unit, null_dates)
    b = group_into_batches(p, PERIOD_COLUMN, batch_size, keep_partition=True)
    # batch_id determines __part; grouping by both keeps the window's partitioning
    per_batch = b.groupBy(PERIOD_COLUMN, "__part", "batch_id").agg(F.count(F.lit(1)).alias("rows"))
    return per_batch.groupBy(PERIOD_COLUMN).agg(F.sum("rows").cast("bigint").alias("n"))


def distinct_periods(df: DataFrame, date_column: str, freq: str = "D", *, unit: str | None = None,
                     null_dates: str = "drop") -> DataFrame:
    """The periods that have at least one row (empty periods never appear)."""
    return _periods(df, date_column, freq, unit, null_dates).distinct()


def count_per_epoch_day(df: DataFrame, epoch_column: str) -> DataFrame:
    """``(day_start, n)``: rows per UTC day of an epoch-seconds column, keyed by
    the day start in epoch seconds; a missing time counts under day 0."""
    from strata.functions.periods import day_start_epoch

    key = day_start_epoch(F.col(quote(epoch_column))).alias("day_start")
    return df.select(key).groupBy("day_start").agg(F.count(F.lit(1)).alias("n"))


def count_null_dates(df: DataFrame, date_column: str) -> int:
    """Rows without a date (what ``null_dates='drop'`` leaves out).  Scans the
    date column only."""
    return df.select(quote(date_column)).where(F.col(quote(date_column)).isNull()).count()


def count_missing_periods(df: DataFrame, date_column: str, freq: str = "D", *, unit: str | None = None,
                          date_errors: str = "raise") -> int:
    """Rows that get no period: those without a date and, under
    ``date_errors='coerce'``, those whose text does not parse."""
    dates = df.select(F.col(quote(date_column)).alias("date"))
    labelled = with_period(dates, "date", freq, unit=unit, null_dates="keep", date_errors=date_errors)
    return labelled.where(F.col(PERIOD_COLUMN).isNull()).count()
