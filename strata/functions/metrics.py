"""Per-column profile metrics as Spark aggregate expressions.

A profile row describes one column over one group of input rows (one period,
one key, or the whole table).  Everything in it is *mergeable*: counts and
extrema merge with ``sum``/``min``/``max``, moments with the parallel-variance
formula, and the three sketches with Spark's own union aggregates
(``hll_union_agg``, ``kll_merge_agg_*``, ``approx_top_k_combine``).

Metric policy per Spark type (design decision, see README):

=============  ==============================================================
type class     metrics besides counts
=============  ==============================================================
integral       min/max (exact, bigint), moments, KLL(bigint), HLL, top-k
fractional     NaN/Inf counts, min/max over non-NaN, moments over finite
               values, KLL(double), HLL (on a 64-bit value hash), no top-k;
               decimals: min/max also as exact text (``decimal_key``)
boolean        HLL, top-k
string         min/max text, moments and KLL of the length, HLL, top-k
binary         min/max as hexadecimal text, moments and KLL of the length, HLL
datetime       min/max and KLL of epoch microseconds (UTC), HLL
object         (array/map/struct) HLL of the canonical JSON text
=============  ==============================================================
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.periods import EPOCH_NTZ

# Column order of a profile store after the key columns.
METRIC_COLUMNS = [
    "column", "type_class", "n", "nonnull", "null", "nan", "inf",
    "min_i", "max_i", "min_d", "max_d", "min_s", "max_s",
    "mom_n", "mom_mean", "mom_m2", "hll", "kll_kind", "kll", "topk",
]

TOPK_TYPE = "struct<sketch:binary,maxItemsTracked:int,itemDataType:string,itemDataTypeDDL:string>"

STORE_TYPES = {
    "column": "string", "type_class": "string", "n": "bigint", "nonnull": "bigint",
    "null": "bigint", "nan": "bigint", "inf": "bigint", "min_i": "bigint", "max_i": "bigint",
    "min_d": "double", "max_d": "double", "min_s": "string", "max_s": "string",
    "mom_n": "bigint", "mom_mean": "double", "mom_m2": "double", "hll": "binary",
    "kll_kind": "string", "kll": "binary", "topk": TOPK_TYPE,
}


@dataclass(frozen=True)
class SketchConfig:
    """Sketch sizes.  ``lg_k=12`` gives ~1.6 % HLL error, ``kll_k=200`` ~1.3 %
    rank error; top-k is exact while a group has < 0.75 * capacity items."""

    lg_k: int = 12
    kll_k: int = 200
    topk_capacity: int = 128

    def __post_init__(self):
        # The parameter ranges Spark's sketch functions accept.
        if not 4 <= self.lg_k <= 21:
            raise ValueError("lg_k must be within 4..21")
        if not 8 <= self.kll_k <= 65535:
            raise ValueError("kll_k must be within 8..65535")
        if not 0 <= self.topk_capacity <= 1_000_000:
            raise ValueError("topk_capacity must be within 0..1000000 (0 = no top-k)")


def type_class(dtype: T.DataType) -> str:
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "integral"
    if isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType)):
        return "fractional"
    if isinstance(dtype, T.BooleanType):
        return "boolean"
    if isinstance(dtype, (T.StringType, T.VarcharType, T.CharType)):
        return "string"
    if isinstance(dtype, T.BinaryType):
        return "binary"
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "datetime"
    return "object"


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def cols(names) -> list[Column]:
    """Columns by exact name (dots and spaces in names are not paths)."""
    return [F.col(quote(n)) for n in names]


def _epoch_micros_sql(q: str, dtype: T.DataType) -> str:
    if isinstance(dtype, T.TimestampNTZType):
        return f"timestampdiff(MICROSECOND, {EPOCH_NTZ}, {q})"
    if isinstance(dtype, T.TimestampType):
        return f"unix_micros({q})"
    return f"cast(unix_date({q}) as bigint) * 86400000000"


# Whole and fractional digits of a decimal's key; Spark's widest
# decimal has 38 of either.
KEY_DIGITS = 38
_FLIP = ("0123456789", "9876543210")


def decimal_key(q: str) -> str:
    """SQL text of a decimal that sorts as the number does, whatever its precision and
    scale: sign, then digits on a fixed grid (of negative numbers, their complement)."""
    plain = f"cast(abs({q}) AS string)"
    digits = (f"concat(lpad(split_part({plain}, '.', 1), {KEY_DIGITS}, '0'), '.', "
              f"rpad(split_part({plain}, '.', 2), {KEY_DIGITS}, '0'))")
    return f"CASE WHEN {q} < 0 THEN concat('-', translate({digits}, '{_FLIP[0]}', '{_FLIP[1]}')) ELSE concat('0', {digits}) END"


def decimal_text(key: str) -> str:
    """SQL text of the number that a ``decimal_key`` stands for."""
    body = f"substring({key}, 2)"
    digits = f"CASE WHEN {key} LIKE '-%' THEN translate({body}, '{_FLIP[0]}', '{_FLIP[1]}') ELSE {body} END"
    trimmed = f"rtrim('.', rtrim('0', ltrim('0', {digits})))"
    return (f"CASE WHEN {key} IS NOT NULL THEN concat(CASE WHEN {key} LIKE '-%' THEN '-' ELSE '' END, "
            f"CASE WHEN {trimmed} = '' THEN '0' WHEN {trimmed} LIKE '.%' THEN concat('0', {trimmed}) ELSE {trimmed} END) END")


def column_aggregates(name: str, dtype: T.DataType, prefix: str, cfg: SketchConfig) -> list[Column]:
    """Partial-profile aggregate expressions of one column.

    Each output is aliased ``{prefix}{metric}``; metrics that do not apply to
    the type are left out and filled with typed NULLs by ``unpivot_columns``.
    """
    q = quote(name)
    tc = type_class(dtype)
    out: dict[str, str] = {"nonnull": f"count({q})"}
    hll_value = q
    kll_value = None
    kll_kind = None
    mom_value = None
    topk_value = None

    if tc == "integral":
        v = f"cast({q} as bigint)"
        out["min_i"], out["max_i"] = f"min({v})", f"max({v})"
        hll_value = kll_value = v
        kll_kind = "bigint"
        mom_value = f"cast({q} as double)"
        topk_value = f"cast({q} as string)"
    elif tc == "fractional":
        v = f"cast({q} as double)"
        out["nan"] = f"count_if(isnan({v}))"
        out["inf"] = f"count_if({v} = double('inf') or {v} = double('-inf'))"
        out["min_d"] = f"min(CASE WHEN NOT isnan({v}) THEN {v} END)"
        out["max_d"] = f"max(CASE WHEN NOT isnan({v}) THEN {v} END)"
        if isinstance(dtype, T.DecimalType):
            # a double rounds beyond 15 digits: the exact extrema are kept as text
            out["min_s"], out["max_s"] = f"min({decimal_key(q)})", f"max({decimal_key(q)})"
        # Distinct values of a double are counted on a 64-bit hash of the value:
        # no text formatting per row, and -0.0 / 0.0 hash alike.  Floats and
        # decimals that a double holds exactly hash as that double, so runs of
        # either type merge; wider decimals hash as they are.
        exact = not isinstance(dtype, T.DecimalType) or dtype.precision <= 15
        hll_value = f"CASE WHEN {q} IS NOT NULL THEN xxhash64({v if exact else q}) END"
        kll_value, kll_kind = v, "double"
        mom_value = f"CASE WHEN NOT isnan({v}) AND abs({v}) != double('inf') THEN {v} END"
    elif tc == "boolean":
        hll_value = f"cast({q} as bigint)"
        topk_value = f"cast({q} as string)"
    elif tc == "string":
        out["min_s"], out["max_s"] = f"min({q})", f"max({q})"
        kll_value, kll_kind = f"cast(length({q}) as bigint)", "bigint"
        mom_value = f"cast(length({q}) as double)"
        topk_value = q
    elif tc == "binary":
        out["min_s"], out["max_s"] = f"min(hex({q}))", f"max(hex({q}))"  # sorts as the bytes do
        kll_value, kll_kind = f"cast(length({q}) as bigint)", "bigint"
        mom_value = f"cast(length({q}) as double)"
    elif tc == "datetime":
        v = _epoch_micros_sql(q, dtype)
        out["min_i"], out["max_i"] = f"min({v})", f"max({v})"
        hll_value = kll_value = v
        kll_kind = "bigint"
    else:  # object: canonical JSON text
        hll_value = f"to_json({q})"

    if mom_value is not None:
        out["mom_n"] = f"count({mom_value})"
        out["mom_mean"] = f"avg({mom_value})"
        # var_pop overflows to NaN or +inf depending on the order of values;
        # a sum of squares that overflowed is reported as +inf either way.
        m2 = f"(var_pop({mom_value}) * count({mom_value}))"
        out["mom_m2"] = f"CASE WHEN isnan({m2}) THEN double('inf') ELSE {m2} END"
    out["hll"] = f"hll_sketch_agg({hll_value}, {cfg.lg_k})"
    if kll_value is not None:
        out["kll"] = f"kll_sketch_agg_{kll_kind}({kll_value}, {cfg.kll_k})"
    if topk_value is not None and cfg.topk_capacity > 0:
        out["topk"] = (f"approx_top_k_accumulate({topk_value}, {cfg.topk_capacity}) "
                       f"FILTER (WHERE {q} IS NOT NULL)")
    return [F.expr(sql).alias(prefix + metric) for metric, sql in out.items()]


def column_kll_kind(dtype: T.DataType) -> str | None:
    tc = type_class(dtype)
    if tc == "fractional":
        return "double"
    if tc in ("integral", "string", "binary", "datetime"):
        return "bigint"
    return None


def unpivot_struct(name: str, dtype: T.DataType, prefix: str, n_col: str,
                   available: set[str], cfg: SketchConfig) -> Column:
    """One long-form metric struct for a column of a wide partial row."""
    tc = type_class(dtype)
    fields = []
    for metric in METRIC_COLUMNS:
        typ = STORE_TYPES[metric]
        if metric == "column":
            e = F.lit(name)
        elif metric == "type_class":
            e = F.lit(tc)
        elif metric == "n":
            e = F.col(n_col)
        elif metric == "null":
            e = F.col(n_col) - F.col(prefix + "nonnull")
        elif metric in ("nan", "inf") and prefix + metric not in available:
            e = F.lit(0)
        elif metric == "kll_kind":
            kind = column_kll_kind(dtype)
            e = F.lit(kind)
        elif prefix + metric in available:
            e = F.col(prefix + metric)
        else:
            e = F.lit(None)
        fields.append(e.cast(typ).alias(metric))
    return F.struct(*fields)
