"""The product job: input -> profile per period -> sinks.

``profile_job`` takes what the reference's job template takes (input table or
query, date column, grouping frequency, output location, monitoring-service
writer) as validated keyword arguments.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.metrics import SketchConfig, quote
from strata.functions.periods import as_wall_clock, parse_frequency
from strata.operators.counts import count_missing_periods
from strata.operators.profile import COLUMNS_PER_PASS, profile
from strata.operators.views import profile_table
from strata.sinks.writers import (
    RowWriter, fan_out, read_merged, read_profiles, run_path, write_each, write_run,
)
from strata.sources.tables import read_input


def _undated(df: DataFrame, date_column: str, unit: str | None, date_errors: str) -> Column:
    """Whether a row gets no period."""
    c, kind = F.col(quote(date_column)), df.schema[date_column].dataType
    if date_errors == "coerce" and isinstance(kind, T.StringType):
        return as_wall_clock(c, kind, unit, errors=date_errors).isNull()
    return c.isNull()


def _log_dropped(dropped: Observation | None, date_column: str | None) -> None:
    if dropped is not None:
        logging.getLogger("strata").info("%d rows without %s are not profiled", dropped.get["dropped"], date_column)


def profile_job(spark: SparkSession, input: str | None = None, *, table: str | None = None,
                query: str | None = None, table_path: str | None = None, format: str = "parquet",
                date_column: str | None = None, freq: str = "D", output: str | None = None,
                writer: RowWriter | None = None, dataset_id: str = "dataset",
                columns: Sequence[str] | None = None, unit: str | None = None,
                null_dates: str = "drop", fanout: int | None = None,
                sketches: SketchConfig | None = None, readable: bool = False,
                run_id: str | None = None, row_shuffle: bool = False,
                date_errors: str = "raise", dropped: Observation | None = None) -> DataFrame:
    """Profile one input per period of ``date_column`` (globally without it).

    With ``output`` the store is written once (partitioned by month) and the
    returned frame and the ``writer`` read that written copy.  With ``run_id``
    too, the run is appended to the store at ``output`` instead of replacing
    it (rerunning the same ``run_id`` replaces only that run), and the
    returned frame is the whole history merged; the ``writer`` gets the run's
    own profiles.  ``row_shuffle`` picks the
    aggregation plan (see ``profile``).

    Rows dropped for a missing date, or for one that does not parse under
    ``date_errors='coerce'`` (``null_dates='drop'``), are observed by the profiling
    query itself, so the input is read once.  ``dropped`` is an ``Observation`` of the
    caller's: ``dropped.get["dropped"]`` is their number once the profile has run.
    With ``output`` it is also logged.  (An executor lost half-way may have rows
    observed twice; the profile itself counts every row once.)
    """
    parse_frequency(freq)  # fail before any Spark work on a bad frequency
    df = read_input(spark, input, table=table, query=query, path=table_path, format=format)
    if date_column is not None and date_column not in df.columns:
        raise ValueError(f"date column {date_column!r} is not in the input")
    observed = date_column is not None and null_dates == "drop"
    names = list(columns) if columns is not None else list(df.columns)
    if observed and len(names) > COLUMNS_PER_PASS:  # several passes would observe a row several times
        if dropped is not None:
            raise ValueError(f"dropped= needs an input of at most {COLUMNS_PER_PASS} profiled columns")
        observed = False
        n = count_missing_periods(df, date_column, freq, unit=unit, date_errors=date_errors)
        logging.getLogger("strata").info("%d rows without %s are not profiled", n, date_column)
    if observed:
        dropped = dropped or Observation(f"strata-dropped-{uuid.uuid4().hex}")
        df = df.observe(dropped, F.count_if(_undated(df, date_column, unit, date_errors)).alias("dropped"))
    store = profile(df, date_column, freq, columns=columns, unit=unit, null_dates=null_dates,
                    fanout=fanout, sketches=sketches, row_shuffle=row_shuffle,
                    date_errors=date_errors)
    if output is not None and run_id is not None:
        if date_column is None:
            raise ValueError("run_id needs a date_column (runs are stored per period)")
        write_run(store, output, run_id)
        _log_dropped(dropped if observed else None, date_column)
        if writer is not None:  # this run's profiles, read from the written copy
            write_each(read_profiles(spark, run_path(output, run_id)), writer, dataset_id)
        store = read_merged(spark, output)
    elif output is not None:
        sinks = [lambda s: write_each(s, writer, dataset_id)] if writer is not None else []
        store = fan_out(store, output, sinks)
        _log_dropped(dropped if observed else None, date_column)
    elif writer is not None:
        write_each(store, writer, dataset_id)
    return profile_table(store) if readable else store
