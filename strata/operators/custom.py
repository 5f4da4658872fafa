"""User-defined profile metrics (the user aggregate surface).

A custom metric is a per-row column expression plus a mergeable kind::

    metrics = {
        "positive": ("sum", lambda c: (c > 0).cast("int")),   # rows with c > 0
        "longest":  ("max", lambda c: F.length(c)),           # longest text
    }
    custom_profile(df, metrics, "ts", "D", columns=["price", "comment"])

Each metric is aggregated with its kind (``sum``, ``min`` or ``max``: all
associative and commutative, so partial results merge exactly) in one
``groupBy(...).agg(...)`` next to the scan, with map-side partial
aggregation, then unpivoted to a long store ``(keys..., column, metric, kind,
value)`` that ``merge_custom`` folds like a profile store.

``value`` has the common type of all results: bigint if all are whole numbers,
their own type if all have the same, double for other mixtures of numbers.  Results
that share no type are refused; ``strata.operators.user_aggregates`` keeps every
result's own type and has states of several fields.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.metrics import cols, quote
from strata.functions.names import free_name, free_prefix
from strata.operators.profile import PERIOD_COLUMN, with_period

# The merge operations a custom metric may use.
KINDS = {"sum": F.sum, "min": F.min, "max": F.max}

CUSTOM_COLUMNS = ["column", "metric", "kind", "value"]

MetricSpec = tuple[str, Callable[[Column], Column]]


def common_type(kinds: Sequence[T.DataType]) -> T.DataType:
    """The type that holds results of all ``kinds`` (see module doc)."""
    if all(isinstance(k, T.IntegralType) for k in kinds):
        return T.LongType()
    if len(set(kinds)) == 1:
        return kinds[0]
    if all(isinstance(k, T.NumericType) for k in kinds):
        return T.DoubleType()
    raise ValueError(f"results of types {sorted({k.simpleString() for k in kinds})} do not fit one column")


def custom_profile(df: DataFrame, metrics: dict[str, MetricSpec], date_column: str | None = None,
                   freq: str = "D", *, by: str | Sequence[str] | None = None,
                   columns: Iterable[str] | None = None, unit: str | None = None,
                   null_dates: str = "drop") -> DataFrame:
    """Long store of user metrics per period (and/or ``by`` key) and column."""
    for name, (kind, _) in metrics.items():
        if kind not in KINDS:
            raise ValueError(f"metric {name!r}: kind must be one of {sorted(KINDS)}")
    by_cols = [by] if isinstance(by, str) else list(by or [])
    names = list(columns) if columns is not None else [c for c in df.columns if c not in by_cols]
    keys: list[str] = []
    src = df
    label = free_name(df.columns, "__period")
    if date_column is not None:
        src = with_period(src, date_column, freq, unit=unit, null_dates=null_dates, out=label)
        keys.append(label)
    keys += by_cols
    own = free_prefix(keys, "__")
    aggs, structs = [], []
    for i, name in enumerate(names):
        c = F.col(quote(name))
        for j, (metric, (kind, build)) in enumerate(metrics.items()):
            alias = f"{own}c{i}_m{j}"
            aggs.append(KINDS[kind](build(c)).alias(alias))
            structs.append((name, metric, kind, alias))
    wide = src.groupBy(*cols(keys)).agg(*aggs)
    value = common_type([wide.schema[alias].dataType for *_, alias in structs])
    rows = [F.struct(F.lit(name).alias("column"), F.lit(metric).alias("metric"), F.lit(kind).alias("kind"),
                     F.col(alias).cast(value).alias("value")) for name, metric, kind, alias in structs]
    named = [F.col(quote(k)).alias(PERIOD_COLUMN) if k == label else F.col(quote(k)) for k in keys]
    return wide.select(*named, F.inline(F.array(*rows)))


def merge_custom(store: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Fold custom-metric rows that share keys, column and metric."""
    keys = list(keys) if keys is not None else [c for c in store.columns if c not in CUSTOM_COLUMNS]
    v, kind = F.col("value"), F.col("kind")
    numeric = isinstance(store.schema["value"].dataType, T.NumericType)
    own = free_prefix(keys, "__")
    merged = store.groupBy(*cols(keys), "column", "metric", "kind").agg(
        (F.sum(v) if numeric else F.max(v)).alias(f"{own}sum"), F.min(v).alias(f"{own}min"), F.max(v).alias(f"{own}max"))
    value = (F.when(kind == "sum", F.col(f"{own}sum")).when(kind == "min", F.col(f"{own}min"))
             .otherwise(F.col(f"{own}max")))
    return merged.select(*cols(keys), "column", "metric", "kind", value.alias("value"))
