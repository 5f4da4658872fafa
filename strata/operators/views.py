"""Readable views of a profile store (the store itself stays mergeable)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.metrics import cols, decimal_key, decimal_text
from strata.functions.periods import EPOCH_NTZ
from strata.operators.merge import key_columns, merge_profiles

# Keys that sort after and before all of decimal_key.
ABOVE, BELOW = "1", "!"

# Quantile ranks shown by profile_table.
DEFAULT_QUANTILES = (0.0, 0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99, 1.0)


def quantiles_expr(ranks: Sequence[float]) -> Column:
    arr = "array(" + ", ".join(repr(float(r)) for r in ranks) + ")"
    return F.expr(
        "CASE kll_kind "
        f"WHEN 'bigint' THEN CASE WHEN kll_sketch_get_n_bigint(kll) > 0 THEN "
        f"cast(kll_sketch_get_quantile_bigint(kll, {arr}) as array<double>) END "
        f"WHEN 'double' THEN CASE WHEN kll_sketch_get_n_double(kll) > 0 THEN "
        f"kll_sketch_get_quantile_double(kll, {arr}) END END")


def _stddev() -> Column:
    return F.sqrt(F.col("mom_m2") / F.col("mom_n"))


def profile_table(store: DataFrame, quantiles: Sequence[float] = DEFAULT_QUANTILES,
                  top_k: int = 10) -> DataFrame:
    """One row per key and column with the estimates decoded from the sketches:
    ``distinct_est``, ``quantiles`` (of values, or of lengths for text),
    ``frequent_items`` (array of ``(item, count)``), and ``types``, the count
    of values per type class (columns are statically typed, so every non-null
    value has the column's class)."""
    keys = key_columns(store)
    return store.select(
        *cols(keys), "column", "type_class", "n", "nonnull", "null", "nan", "inf",
        "min_i", "max_i", "min_d", "max_d", "min_s", "max_s",
        F.col("mom_mean").alias("mean"), _stddev().alias("stddev"),
        F.create_map(F.col("type_class"), F.col("nonnull")).alias("types"),
        F.expr("hll_sketch_estimate(hll)").alias("distinct_est"),
        quantiles_expr(quantiles).alias("quantiles"),
        F.expr(f"CASE WHEN topk IS NOT NULL THEN approx_top_k_estimate(topk, {int(top_k)}) END")
        .alias("frequent_items"),
    )


def _is_exact(s: str, d: str) -> str:
    """Whether the decimal key ``s`` is the extremum ``d`` (else it came from a double)."""
    return f"{s} IS NOT NULL AND cast({decimal_text(s)} AS double) = {d}"


def _double_key(d: str) -> str:
    """``decimal_key`` of a double to 18 digits after the point; beyond 38 digits before
    it one key above (below) all others."""
    return (f"CASE WHEN {d} >= 1e38 THEN '{ABOVE}' WHEN {d} <= -1e38 THEN '{BELOW}' ELSE coalesce("
            + ", ".join(decimal_key(f"try_cast(cast({d} AS string) AS decimal(38,{k}))") for k in (18, 0)) + ") END")


def exact_extrema(store: DataFrame) -> DataFrame:
    """``(keys..., column, type_class, minimum, maximum)``: exact extrema of every type as
    text: numbers in full, dates and times in ISO form, text as it is, binary in
    hexadecimal."""
    low, high = [], []
    for out, i, d, s in ((low, "min_i", "min_d", "min_s"), (high, "max_i", "max_d", "max_s")):
        moment = f"date_format({EPOCH_NTZ} + make_dt_interval(0, 0, 0, {i} / 1000000.0), \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\")"
        out.append(F.expr(
            f"CASE type_class WHEN 'fractional' THEN CASE WHEN {_is_exact(s, d)} THEN {decimal_text(s)} ELSE cast({d} AS string) END "
            f"WHEN 'datetime' THEN {moment} WHEN 'integral' THEN cast({i} AS string) ELSE {s} END"))
    return store.select(*cols(key_columns(store)), "column", "type_class", low[0].alias("minimum"), high[0].alias("maximum"))


def across_types(store: DataFrame) -> DataFrame:
    """One row per key and column of a store whose columns may have changed their type
    between runs: counts over all types, ``types`` (values per type class), and the exact
    least and greatest number over whole and fractional values as text (``+`` and ``-``
    stand for numbers of more than 38 digits).  Sketches and
    moments of unlike types do not add up and stay with their types in the store."""
    keys = key_columns(store)
    merged = merge_profiles(store, keys=keys)
    number = lambda i, d, s: F.expr(  # noqa: E731 - a key that sorts as the number does
        f"CASE type_class WHEN 'integral' THEN {decimal_key(f'cast({i} AS decimal(38,0))')} "
        f"WHEN 'fractional' THEN CASE WHEN {_is_exact(s, d)} THEN {s} ELSE {_double_key(d)} END END")
    rows = merged.select("*", number("min_i", "min_d", "min_s").alias("least"), number("max_i", "max_d", "max_s").alias("greatest"))
    total = [F.sum(F.col(f"`{c}`")).alias(c) for c in ("n", "nonnull", "null", "nan", "inf")]
    out = rows.groupBy(*cols(keys), "column").agg(
        *total, F.map_from_entries(F.array_sort(F.collect_list(F.struct("type_class", "nonnull")))).alias("types"),
        F.min("least").alias("least"), F.max("greatest").alias("greatest"))
    return out.select(*cols(keys), "column", "n", "nonnull", "null", "nan", "inf", "types",
                      *[F.when(F.col(c) == ABOVE, F.lit("+")).when(F.col(c) == BELOW, F.lit("-"))
                        .otherwise(F.expr(decimal_text(c))).alias(c) for c in ("least", "greatest")])


def exact_metrics(store: DataFrame, key_formats: dict[str, str] | None = None,
                  digits: int = 4) -> DataFrame:
    """The deterministic part of a store, keys printed as text and moments
    rounded: what an exact SQL engine can reproduce.

    The mean is published as ``total = round(mean * count, 2)``: data on a
    decimal grid (prices, integers, lengths) makes means land exactly on
    rounding ties, while sums stay far from them.
    """
    key_formats = key_formats or {}
    keys = [F.date_format(cols([k])[0], key_formats[k]).alias(k) if k in key_formats
            else cols([k])[0] for k in key_columns(store)]
    return store.select(
        *keys, "column", "type_class", "n", "nonnull", "null", "nan", "inf",
        "min_i", "max_i", "min_d", "max_d", "min_s", "max_s",
        F.round(F.col("mom_mean") * F.col("mom_n"), 2).alias("total"),
        F.round(_stddev(), digits).alias("stddev"),
    )


def frequent_items(store: DataFrame, top_k: int = 10) -> DataFrame:
    """Long form of the top-k sketches: ``(keys..., column, item, count)``."""
    keys = key_columns(store)
    return (store.where(F.col("topk").isNotNull())
            .select(*cols(keys), "column",
                    F.explode(F.expr(f"approx_top_k_estimate(topk, {int(top_k)})")).alias("fi"))
            .select(*cols(keys), "column", F.col("fi.item").cast("string").alias("item"),
                    F.col("fi.count").cast("bigint").alias("count")))


def profile_size(store: DataFrame) -> DataFrame:
    """Serialized size of every profile (bytes of sketches plus fixed fields),
    per key: the monitoring query behind batch-size estimates."""
    keys = key_columns(store)
    sketch_bytes = (F.coalesce(F.length("hll"), F.lit(0)) + F.coalesce(F.length("kll"), F.lit(0))
                    + F.coalesce(F.length("topk.sketch"), F.lit(0))
                    + F.coalesce(F.length("min_s"), F.lit(0)) + F.coalesce(F.length("max_s"), F.lit(0))
                    + F.lit(8 * 13))
    return store.groupBy(*cols(keys)).agg(F.count(F.lit(1)).alias("columns"),
                                    F.sum(sketch_bytes).cast("bigint").alias("bytes"))
