"""Profiles: one wide aggregate per input, merged as a two-level tree.

Plan of ``profile(df, "ts", "D")``::

    scan (pruned to the profiled columns, IsNotNull(ts) pushed down)
      -> Project [label(ts) AS dataset_ts, pmod(spark_partition_id(), fanout) AS salt, ...]
      -> partial aggregate (map side, one row per (dataset_ts, salt) per task)
      -> Exchange hashpartitioning(dataset_ts, salt)
      -> final aggregate: one wide row per (dataset_ts, salt)
      -> inline(array(struct per column))        -- the small result is unpivoted
      -> Exchange hashpartitioning(dataset_ts, column)
      -> merge aggregate (``merge_profiles``): one row per (dataset_ts, column)

The salt keeps a hot period (or a global profile) from landing on a single
reducer: each (period, salt) reducer merges only the partial rows of the
tasks with that salt, and the final merge of a (period, column) sees at most
``fanout`` rows.  Rows are never exploded per column; only aggregated rows are.

The tree depth follows the input width P (number of input partitions): a
reducer of a plain ``groupBy(period)`` merges at most P partial rows, so for
P <= ``SINGLE_LEVEL_MAX`` one level is enough and the unpivoted rows are the
store.  Wider inputs use the salted tree with ``fanout = ceil(sqrt(P))``, so
both levels merge about sqrt(P) partial rows per group.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.metrics import (
    METRIC_COLUMNS, SketchConfig, cols, column_aggregates, quote, unpivot_struct,
)
from strata.functions.names import free_name, free_prefix
from strata.functions.periods import EPOCH_NTZ, FREQ_KEY, as_wall_clock, period_label
from strata.operators.merge import merge_profiles
from strata.session import checkpoint_root

# Largest input width merged in one level (reducer fan-in bound).
SINGLE_LEVEL_MAX = 64

# Columns profiled per aggregate; wider tables are profiled in chunks whose
# long results are unioned (Parquet reads each chunk's columns only, so the
# bytes scanned do not grow, and every plan stays small).
COLUMNS_PER_PASS = 64

PERIOD_COLUMN = "dataset_ts"


def with_period(df: DataFrame, date_column: str, freq: str = "D", *, unit: str | None = None,
                null_dates: str = "drop", anchor: str | None = None,
                out: str = PERIOD_COLUMN, date_errors: str = "raise") -> DataFrame:
    """Add the period label (TIMESTAMP_NTZ) of ``date_column`` as ``out``.

    ``null_dates`` decides what happens to rows without a date:
    ``'drop'`` (default; the filter reaches the scan), ``'keep'`` (a NULL
    period), ``'epoch'`` (period of 1970-01-01) or ``'error'`` (fail the job).
    Text dates that do not parse fail the job (``date_errors='raise'``) or
    count as missing (``'coerce'``).  An input that has a column ``out`` is
    refused: name another one.
    """
    if out.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"the input has a column {out!r}; name another one as out=")
    if null_dates not in ("drop", "keep", "epoch", "error"):
        raise ValueError("null_dates must be 'drop', 'keep', 'epoch' or 'error'")
    dtype = df.schema[date_column].dataType
    src = F.col(quote(date_column))
    wall = as_wall_clock(src, dtype, unit, errors=date_errors)
    label = period_label(wall, freq, anchor).cast("timestamp_ntz")
    if date_errors == "coerce" and isinstance(dtype, T.StringType):
        src = wall  # unparsable text is a missing date
    if null_dates == "drop":
        df = df.where(src.isNotNull())
    elif null_dates == "epoch":
        label = F.coalesce(label, F.expr(EPOCH_NTZ))
    elif null_dates == "error":
        label = F.when(src.isNull(), F.raise_error(F.lit(f"NULL in date column {date_column}"))
                       .cast("timestamp_ntz")).otherwise(label)
    described = {} if anchor else {FREQ_KEY: freq}
    return df.withColumn(out, label).withMetadata(out, described)  # roll-ups check it


def input_partitions(df: DataFrame) -> int:
    """Partitions the input arrives in, found without running it.

    A plan that ends in a shuffle (a query with joins or aggregates) arrives
    in ``spark.sql.shuffle.partitions`` pieces; asking its RDD would make
    adaptive execution run the upstream stages, so only plain scans are
    asked (that only lists their file splits)."""
    shuffle_width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    try:
        plan = df._jdf.queryExecution().executedPlan().toString()
    except AttributeError:  # Spark Connect: no JVM handle; assume shuffle width
        return shuffle_width
    if "Exchange" in plan or "AdaptiveSparkPlan" in plan:
        return shuffle_width
    return df.rdd.getNumPartitions()


def task_slots(spark) -> int:
    """Tasks the cluster runs at once (classic sessions), else the shuffle width."""
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext
        return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spread_narrow_input(df: DataFrame, partitions: int | None = None) -> tuple[DataFrame, int]:
    """Spread an input that has fewer partitions than the cluster has
    task slots (one unsplittable file, one Parquet row group) so the
    sketch-heavy map side runs on every core.  Inputs with enough splits --
    anything large -- are left untouched: no shuffle.  Returns the frame and
    its partition count."""
    slots = task_slots(df.sparkSession)
    p = input_partitions(df) if partitions is None else partitions
    if p < slots:
        # Hash of the row id (deterministic for a given scan) spreads rows
        # evenly without the local sort a round-robin repartition needs.
        return df.repartition(slots, F.monotonically_increasing_id()), slots
    return df, p


def tree_fanout(partitions: int) -> int:
    """Salt width for an input of ``partitions`` partitions (1 = no salt)."""
    if partitions <= SINGLE_LEVEL_MAX:
        return 1
    return math.ceil(math.sqrt(partitions))


#: Fair shares per shuffle partition: a key that holds more than one share is split.
SHARES = 4
WEIGHT = "rows"


def key_weights(df: DataFrame, date_column: str | None = None, freq: str = "D", *,
                by: str | Sequence[str] | None = None, unit: str | None = None, null_dates: str = "drop",
                anchor: str | None = None, date_errors: str = "raise") -> DataFrame:
    """Rows per key (period and/or ``by`` columns) in the column ``rows``: reads the key
    columns only, and histograms of several inputs add up (``merge_weights``)."""
    by_cols = [by] if isinstance(by, str) else list(by or [])
    if WEIGHT in by_cols:
        raise ValueError(f"rename the key column {WEIGHT!r}")
    src = df.select(*cols(dict.fromkeys([*([date_column] if date_column else []), *by_cols])))
    label = free_name(df.columns, "__period")
    if date_column is not None:
        src = with_period(src, date_column, freq, unit=unit, null_dates=null_dates, anchor=anchor, out=label,
                          date_errors=date_errors)
    named = ([F.col(label).alias(PERIOD_COLUMN)] if date_column is not None else []) + cols(by_cols)
    return src.groupBy(*named).agg(F.count(F.lit(1)).alias(WEIGHT))


def merge_weights(weights: DataFrame) -> DataFrame:
    """Histograms of several inputs, added up."""
    keys = [c for c in weights.columns if c != WEIGHT]
    return weights.groupBy(*cols(keys)).agg(F.sum(WEIGHT).alias(WEIGHT))


def _salts_by_weight(src: DataFrame, keys: list[str], label: str, weights: DataFrame | None) -> tuple[DataFrame, Column]:
    """``src`` and the number of salts of each row's key.  Only keys above a fair share
    are joined, and there are fewer of these than shares, so they can be broadcast."""
    spark = src.sparkSession
    shares = SHARES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    if not keys:
        return src, F.lit(shares)
    own = free_prefix(src.columns, "__w")
    if weights is None:
        weights = src.groupBy(*[F.col(quote(k)).alias(PERIOD_COLUMN if k == label else k) for k in keys]).agg(
            F.count(F.lit(1)).alias(WEIGHT))
    # written once: read for the total and for the heavy keys
    folder = f"{checkpoint_root(spark)}/key-weights-{uuid.uuid4().hex[:12]}"
    weights.withColumnsRenamed({PERIOD_COLUMN if k == label else k: f"{own}{i}" for i, k in enumerate(keys)}).write.parquet(folder)
    known = spark.read.parquet(folder)
    total = known.agg(F.sum(WEIGHT)).first()[0] or 0
    heavy = known.where(F.col(WEIGHT) * shares > total).select(
        *[f"{own}{i}" for i in range(len(keys))], F.ceil(F.col(WEIGHT) * shares / F.lit(max(total, 1))).alias(f"{own}n"))
    same = [F.col(quote(k)).eqNullSafe(F.col(f"{own}{i}")) for i, k in enumerate(keys)]
    return src.join(F.broadcast(heavy), same, "left"), F.coalesce(F.col(f"{own}n"), F.lit(1))


def profile(df: DataFrame, date_column: str | None = None, freq: str = "D", *,
            by: str | Sequence[str] | None = None, columns: Iterable[str] | None = None,
            unit: str | None = None, null_dates: str = "drop", anchor: str | None = None,
            fanout: int | None = None, sketches: SketchConfig | None = None,
            columns_per_pass: int = COLUMNS_PER_PASS,
            row_shuffle: bool = False, weights: DataFrame | None = None, date_errors: str = "raise") -> DataFrame:
    """Profile every column of ``df``: per period of ``date_column`` at
    frequency ``freq``, per value of the ``by`` columns, or globally.

    Returns the long profile store: key columns (``dataset_ts`` and/or the
    ``by`` columns), then ``METRIC_COLUMNS``; one row per key and column.
    Input columns may have any name, ``dataset_ts`` included: the period lives
    under a name of its own until the store is made.
    The date column itself is profiled too unless ``columns`` says otherwise.
    ``fanout`` overrides the salt width of the aggregation tree (see module doc).

    ``row_shuffle=True`` is the plan for inputs whose tasks each see many
    periods (event time not clustered in the files): partial sketches per
    (task, period) would then outweigh the rows, so the profiled columns are
    shuffled by ``(period, row-position salt)`` instead and aggregated after the
    exchange.  How many salts a key gets follows its weight (``key_weights``): one
    for most, as many as it takes to fill a fair share of the partitions for keys
    that hold more, so a hot period spreads evenly and the others are not split.
    ``weights`` is a histogram of the keys from earlier (``key_weights``, added up over
    runs by ``merge_weights``); without it the key columns are counted first.
    ``fanout`` gives every key that many salts instead.  The choice of this plan is the
    caller's: it is never made from the data.
    """
    if df.isStreaming:
        raise ValueError("profile() takes a batch DataFrame; for streams use "
                         "strata.streaming.profile_stream or profile_stream_windowed")
    cfg = sketches or SketchConfig()
    by_cols = [by] if isinstance(by, str) else list(by or [])
    names = list(columns) if columns is not None else list(df.columns)
    schema = {f.name: f.dataType for f in df.schema.fields}
    missing = [c for c in names + by_cols if c not in schema]
    if missing:
        raise ValueError(f"unknown columns: {missing}")
    clash = [c for c in by_cols if c in METRIC_COLUMNS or c == PERIOD_COLUMN]
    if clash:
        raise ValueError(f"key columns {clash} clash with profile store columns; rename them")
    if fanout is not None and fanout < 1:
        raise ValueError("fanout must be >= 1")
    if row_shuffle not in (True, False):
        raise ValueError("row_shuffle must be True or False")
    if len(names) > columns_per_pass:
        from functools import reduce
        chunks = [names[i:i + columns_per_pass] for i in range(0, len(names), columns_per_pass)]
        stores = [profile(df, date_column, freq, by=by_cols, columns=chunk, unit=unit,
                          null_dates=null_dates, anchor=anchor, fanout=fanout, sketches=cfg,
                          columns_per_pass=columns_per_pass, row_shuffle=row_shuffle, weights=weights,
                          date_errors=date_errors)
                  for chunk in chunks]
        return reduce(lambda a, b: a.unionByName(b), stores)

    keys: list[str] = []
    label = free_name(df.columns, "__period")
    salt = free_name([*df.columns, label], "__salt")
    if date_column is not None and null_dates == "drop":
        df = df.where(F.col(quote(date_column)).isNotNull())  # below any exchange: reaches the scan
    # (with row_shuffle the exchange on (period, salt) already spreads the rows)
    salts = fanout
    if row_shuffle:
        src = df
    else:
        src, width = spread_narrow_input(df)
        fanout = fanout or tree_fanout(width)
    if date_column is not None:
        src = with_period(src, date_column, freq, unit=unit, null_dates=null_dates, anchor=anchor,
                          date_errors=date_errors, out=label)
        keys.append(label)
    keys += by_cols
    group = list(keys)
    if row_shuffle:
        # Salt by row position (deterministic for a given input, and it
        # splits even a hot period made of identical copies), then co-locate
        # each (period, salt) before aggregating: the exchange moves the
        # profiled columns once and the aggregate needs no second exchange.
        src = src.select(*cols(dict.fromkeys(keys + names)))
        if salts is not None:
            n_salts = F.lit(salts)
        else:
            src, n_salts = _salts_by_weight(src, keys, label, weights)
        src = src.withColumn(salt, F.pmod(F.monotonically_increasing_id(), n_salts))
        group.append(salt)
        src = src.select(*cols(dict.fromkeys([*group, *names]))).repartition(*cols(group))
    elif fanout > 1:
        src = src.withColumn(salt, F.pmod(F.spark_partition_id(), F.lit(fanout)))
        group.append(salt)

    own = free_prefix(group, "__")  # the aggregates stand beside the keys
    aggs = [F.count(F.lit(1)).alias(f"{own}n")]
    for i, name in enumerate(names):
        aggs += column_aggregates(name, schema[name], f"{own}c{i}_", cfg)
    wide = src.groupBy(*cols(group)).agg(*aggs)
    split = bool(row_shuffle) or fanout > 1
    if not keys and split:
        # A global profile of an empty input still lists every column (n = 0):
        # add the aggregate's identity row; Catalyst folds it to a local row.
        # (Without a salt, the global aggregate yields that row by itself.)
        empty = src.where(F.lit(False)).groupBy().agg(*aggs).withColumn(salt, F.lit(-1))
        wide = wide.unionByName(empty)
    available = set(wide.columns)
    structs = [unpivot_struct(name, schema[name], f"{own}c{i}_", f"{own}n", available, cfg)
               for i, name in enumerate(names)]
    named = [F.col(quote(k)).alias(PERIOD_COLUMN) if k == label else F.col(quote(k)) for k in keys]
    keys = [PERIOD_COLUMN if k == label else k for k in keys]
    long = wide.select(*named, F.inline(F.array(*structs)))
    if not split:
        # one level: (keys, column) is already unique
        return long.select(*cols(keys), *METRIC_COLUMNS)
    return merge_profiles(long, keys=keys, sketches=cfg)
