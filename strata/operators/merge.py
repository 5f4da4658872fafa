"""Merging profile stores: the profile algebra as ordinary aggregates.

A profile store is a DataFrame of rows ``(keys..., column, metrics...)``.
Merging is a ``groupBy`` of the keys plus ``column``:

* counts add up, extrema take ``min``/``max``;
* moments ``(n, mean, m2)`` merge by exact whole-number sums of a fixed size
  (``strata.functions.moments``), one set per order of magnitude of the means:
  no rounding, no cancellation, no list of partial rows, and every metric
  combines on the map side;
* sketches merge with ``hll_union_agg``, ``kll_merge_agg_*`` and
  ``approx_top_k_combine``.

The empty store is the identity and merging is associative and commutative,
so partial stores (per batch, per day, per streaming pane, per run) can be
folded in any order.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from strata.functions.metrics import METRIC_COLUMNS, SketchConfig, cols
from strata.functions.moments import limb_sums, with_bucket_moments, with_folded_moments, with_limbs
from strata.functions.names import free_prefix
from strata.functions.periods import FREQ_KEY, as_wall_clock, parse_frequency, period_label


_EMPTY_TOPK: dict[tuple[int, int], Row] = {}


def empty_topk_state(spark: SparkSession, capacity: int) -> Column:
    """Literal of an empty string top-k state (computed once per session)."""
    key = (id(spark), capacity)
    if key not in _EMPTY_TOPK:
        _EMPTY_TOPK[key] = spark.sql(
            f"SELECT approx_top_k_accumulate(CAST(NULL AS STRING), {int(capacity)}) "
            "FILTER (WHERE false) AS s").first().s
    st = _EMPTY_TOPK[key]
    return F.struct(F.lit(bytes(st.sketch)).cast("binary").alias("sketch"),
                    F.lit(st.maxItemsTracked).cast("int").alias("maxItemsTracked"),
                    F.lit(st.itemDataType).alias("itemDataType"),
                    F.lit(st.itemDataTypeDDL).alias("itemDataTypeDDL"))


def key_columns(store: DataFrame) -> list[str]:
    return [c for c in store.columns if c not in METRIC_COLUMNS]


def merge_profiles(store: DataFrame, keys: Sequence[str] | None = None,
                   sketches: SketchConfig | None = None) -> DataFrame:
    """Merge all rows of ``store`` that share ``keys`` and ``column``.

    Top-k states keep the width they were made with.  States of unequal widths
    (or a store without top-k beside one of another width than the default)
    fail the job, unless ``sketches`` names the width of the result."""
    cfg = sketches or SketchConfig()
    keys = list(keys) if keys is not None else key_columns(store)
    own = free_prefix([*store.columns, *keys], "__")
    gk = [*keys, "column", "type_class", "kll_kind"]
    cap = cfg.topk_capacity if cfg.topk_capacity > 0 else 128
    width = f", {cap}" if sketches is not None else ""
    # approx_top_k_combine learns the item type from its first input; a group
    # without any state (columns that keep no top-k) would leave it untyped,
    # so those rows contribute a typed empty state instead of NULL.
    empty = empty_topk_state(store.sparkSession, cap)
    combined = [F.expr(e) for e in (
        *(f"sum(`{c}`) AS `{c}`" for c in ("n", "nonnull", "null", "nan", "inf", "mom_n")),
        *(f"min({c}) AS {c}" for c in ("min_i", "min_d", "min_s")),
        *(f"max({c}) AS {c}" for c in ("max_i", "max_d", "max_s")),
        "hll_union_agg(hll, true) AS hll",
        "CASE kll_kind "
        "WHEN 'bigint' THEN kll_merge_agg_bigint(kll) FILTER (WHERE kll_kind = 'bigint' AND kll IS NOT NULL) "
        "WHEN 'double' THEN kll_merge_agg_double(kll) FILTER (WHERE kll_kind = 'double' AND kll IS NOT NULL) "
        "END AS kll",
        f"CASE WHEN count(topk) > 0 THEN approx_top_k_combine({own}topk{width}) END AS topk")]
    stated = lambda df: df.withColumn(f"{own}topk", F.coalesce(F.col("topk"), empty))
    # Every metric, the exact moment sums of a bucket included, combines on the map side.
    parts = stated(with_limbs(store, own)).groupBy(*cols(gk), f"{own}bucket").agg(*combined, *limb_sums(own))
    # Nearly always one bucket per group by now, a fixed number at most.
    parts = stated(with_bucket_moments(parts, own))
    merged = parts.groupBy(*cols(gk)).agg(*combined, F.expr(f"array_sort(collect_list({own}part)) AS {own}parts"))
    own_name = {"mom_mean": f"{own}mean", "mom_m2": f"{own}m2"}
    return with_folded_moments(merged, own).select(
        *cols(keys), *[F.col(own_name[m]).alias(m) if m in own_name else F.col(m) for m in METRIC_COLUMNS])


def union_stores(stores: Sequence[DataFrame]) -> DataFrame:
    if not stores:
        raise ValueError("need at least one store")
    return reduce(lambda a, b: a.unionByName(b), stores)


def merge_stores(stores: Sequence[DataFrame], keys: Sequence[str] | None = None,
                 sketches: SketchConfig | None = None) -> DataFrame:
    """Fold a list of stores (e.g. yesterday's history and today's run) into one."""
    return merge_profiles(union_stores(stores), keys=keys, sketches=sketches)


def rollup(store: DataFrame, freq: str, *, period_column: str = "dataset_ts",
           anchor: str | None = None, sketches: SketchConfig | None = None,
           source_freq: str | None = None) -> DataFrame:
    """Re-key a periodic store to a coarser frequency and merge, e.g. days to
    months, without touching the source data again.

    Every fine period must lie inside one coarse period (day -> week, month,
    quarter, year; hour -> day); pairs that do not nest, such as weeks to
    months, are refused.  The store's own frequency is read from its period
    column (Spark and Parquet keep it); ``source_freq`` names it for stores
    that lost it, such as those read back from text.
    """
    dtype = store.schema[period_column].dataType
    source = source_freq or (store.schema[period_column].metadata or {}).get(FREQ_KEY)
    if source is not None and not parse_frequency(source).nests_in(parse_frequency(freq)):
        raise ValueError(f"periods of {source!r} do not nest in periods of {freq!r}: profile the rows again")
    relabelled = store.withColumn(
        period_column,
        period_label(as_wall_clock(F.col(period_column), dtype), freq, anchor).cast("timestamp_ntz"))
    relabelled = relabelled.withMetadata(period_column, {} if anchor else {FREQ_KEY: freq})
    return merge_profiles(relabelled, keys=key_columns(store), sketches=sketches)


def lookup(store: DataFrame, **key_values) -> DataFrame:
    """Rows of ``store`` whose key columns equal the given values, e.g.
    ``lookup(store, dataset_ts=datetime(1995, 3, 31))``."""
    import datetime as _dt

    from pyspark.sql import types as T

    cond = F.lit(True)
    for k, v in key_values.items():
        if k not in store.columns:
            raise ValueError(f"{k} is not a column of the store")
        value = F.lit(v)
        if isinstance(v, _dt.datetime) and isinstance(store.schema[k].dataType, T.TimestampNTZType):
            # a wall-clock literal: through text, so the session time zone plays no part
            value = F.lit(v.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")
        cond = cond & (cols([k])[0] == value)
    return store.where(cond)


def period_count(store: DataFrame, period_column: str = "dataset_ts") -> DataFrame:
    """Number of periods in a store (the index length)."""
    return store.agg(F.count_distinct(period_column).alias("periods"))
