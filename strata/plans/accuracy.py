"""Bounds checks of the sketch estimates against the data they summarise.

Sketch answers vary from run to run (and with partitioning), so they are
compared with exact answers as booleans rather than hashed.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.metrics import cols, quote, type_class
from strata.functions.names import free_name
from strata.functions.periods import epoch_micros
from strata.operators.profile import PERIOD_COLUMN, task_slots, with_period
from strata.operators.views import frequent_items, quantiles_expr

# Accepted errors.  HLL lgK=12 has ~1.6 % relative standard error
# (5 % is > 3 sigma); KLL k=200 has ~1.7 % normalised rank error at 99 %.
DISTINCT_REL_ERROR = 0.05
RANK_ERROR = 0.03
MERGED_REL_ERROR = 0.065  # four standard errors: many periods are checked at once
PAIRS_PER_TASK = 1_000_000  # pairs of row and column that one task counts
TOPK_ERROR = 3.5 / 256  # share of the rows; 128 items are tracked in a map of 256


def _kll_value(name: str, dtype: T.DataType):
    tc = type_class(dtype)
    c = F.col(quote(name))
    if tc in ("integral", "fractional"):
        return c.cast("double")
    if tc in ("string", "binary"):
        return F.length(c).cast("double")
    if tc == "datetime":
        return epoch_micros(c, dtype).cast("double")
    return None


def global_sketch_accuracy(df: DataFrame, store: DataFrame, rank: float = 0.5) -> DataFrame:
    """Per column of a global store: exact distinct count next to
    ``distinct_ok`` (HLL within bound) and ``quantile_ok`` (the KLL ``rank``
    quantile is a valid quantile of the data within ``RANK_ERROR``)."""
    schema = {f.name: f.dataType for f in df.schema.fields}
    est = store.select(
        "column", "n",
        F.expr("hll_sketch_estimate(hll)").alias("distinct_est"),
        F.expr(f"CASE kll_kind "
               f"WHEN 'bigint' THEN CASE WHEN kll_sketch_get_n_bigint(kll) > 0 THEN "
               f"cast(kll_sketch_get_quantile_bigint(kll, {rank}) as double) END "
               f"WHEN 'double' THEN CASE WHEN kll_sketch_get_n_double(kll) > 0 THEN "
               f"kll_sketch_get_quantile_double(kll, {rank}) END END").alias("q_est"))
    # The estimates are one small row per column; the exact side is one more
    # aggregate pass over the data with the estimates as literals.
    estimates = {r["column"]: r["q_est"] for r in est.select("column", "q_est").collect()}
    aggs = []
    names = [n for n in schema if n in estimates]
    for i, name in enumerate(names):
        c = F.col(quote(name))
        canon = F.to_json(c) if type_class(schema[name]) == "object" else c
        aggs.append(F.count_distinct(canon).alias(f"d{i}"))
        v = _kll_value(name, schema[name])
        qv = estimates[name]
        if v is not None and qv is not None:
            aggs.append(F.count_if(v < F.lit(qv)).alias(f"lt{i}"))
            aggs.append(F.count_if(v <= F.lit(qv)).alias(f"le{i}"))
            aggs.append(F.count(v).alias(f"m{i}"))
    exact = df.agg(*aggs)
    rows = []
    for i, name in enumerate(names):
        has_q = f"lt{i}" in exact.columns
        q_ok = (((F.col(f"lt{i}") / F.col(f"m{i}")) <= F.lit(rank + RANK_ERROR)) &
                ((F.col(f"le{i}") / F.col(f"m{i}")) >= F.lit(rank - RANK_ERROR))) if has_q else F.lit(None)
        rows.append(F.struct(F.lit(name).alias("column"),
                             F.col(f"d{i}").cast("bigint").alias("distinct_exact"),
                             q_ok.cast("boolean").alias("quantile_ok")))
    exact_long = exact.select(F.inline(F.array(*rows)))
    return (est.join(exact_long, "column")
            .select("column", "n", "distinct_exact",
                    (F.abs(F.col("distinct_est") - F.col("distinct_exact"))
                     <= F.greatest(F.lit(DISTINCT_REL_ERROR) * F.col("distinct_exact"), F.lit(2.0)))
                    .alias("distinct_ok"),
                    "quantile_ok"))


def _distinct_per_period(df: DataFrame, date_column: str, freq: str, columns: list[str]) -> DataFrame:
    """Exact distinct values per period and column.  Nearly every value may be a key
    of its own, so no task gets more than about ``PAIRS_PER_TASK`` of them: the rows
    are dealt out evenly by place, a task's repeats leave before the shuffle (a
    frequent value then costs a row per task), and as many tasks count what is left.
    The rows are counted first, which a Parquet table answers from its footers."""
    spark = df.sparkSession
    tasks = max(task_slots(spark), math.ceil(df.count() * len(columns) / PAIRS_PER_TASK))
    place = free_name(df.columns, "__place")
    needed = df.select(*cols(dict.fromkeys([date_column, *columns])),
                       F.pmod(F.monotonically_increasing_id(), F.lit(16 * tasks)).alias(place))
    hashes = [F.struct(F.lit(c).alias("column"), F.when(F.col(quote(c)).isNotNull(), F.xxhash64(F.col(quote(c)))).alias("hash"))
              for c in columns]
    keys = [PERIOD_COLUMN, "column", "hash"]
    # a table's rows of one place share a task, so their repeats need no shuffle of their own
    local = (with_period(needed.repartition(tasks, place), date_column, freq)
             .select(place, PERIOD_COLUMN, F.inline(F.array(*hashes))).dropDuplicates([place, *keys]))
    return (local.select(*keys).repartition(tasks, *keys).dropDuplicates(keys)
            .groupBy(PERIOD_COLUMN, "column").agg(F.count("hash").alias("distinct_exact")))


def merged_sketch_accuracy(df: DataFrame, store: DataFrame, date_column: str, freq: str,
                           columns: list[str], ranks: tuple[float, ...] = (0.1, 0.5, 0.9)) -> DataFrame:
    """Per period and column of a periodic ``store``, held against the rows of
    ``df``: exact distinct values, whether the HLL estimate is within
    ``MERGED_REL_ERROR`` and whether every KLL quantile of ``ranks`` is within
    ``RANK_ERROR``.  The rows meet their period's estimates in one join; these are
    a few numbers per period and column and are broadcast, so that a period's rows
    never have to meet in one task."""
    schema = {f.name: f.dataType for f in df.schema.fields}
    values = [F.struct(F.lit(c).alias("column"), _kll_value(c, schema[c]).alias("v")) for c in columns]
    rows = with_period(df, date_column, freq).select(PERIOD_COLUMN, F.inline(F.array(*values)))
    est = store.where(F.col("column").isin(columns)).select(
        PERIOD_COLUMN, "column", F.col("n").alias("n_store"),
        F.expr("hll_sketch_estimate(hll)").alias("est"), quantiles_expr(ranks).alias("q"))
    sides = [e for i in range(len(ranks)) for e in (
        F.count_if(F.col("v") < F.col("q")[i]).alias(f"lt{i}"),
        F.count_if(F.col("v") <= F.col("q")[i]).alias(f"le{i}"))]
    got = rows.join(F.broadcast(est), [PERIOD_COLUMN, "column"], "left").groupBy(PERIOD_COLUMN, "column").agg(
        F.first("n_store").alias("n"), F.first("est").alias("est"), F.count("v").alias("m"), *sides)
    got = got.join(_distinct_per_period(df, date_column, freq, columns), [PERIOD_COLUMN, "column"])
    quantiles_ok = F.lit(True)
    for i, r in enumerate(ranks):
        quantiles_ok &= ((F.col(f"lt{i}") <= (r + RANK_ERROR) * F.col("m") + 1)
                         & (F.col(f"le{i}") >= (r - RANK_ERROR) * F.col("m") - 1))
    distinct_ok = (F.abs(F.col("est") - F.col("distinct_exact"))
                   <= F.greatest(MERGED_REL_ERROR * F.col("distinct_exact"), F.lit(2.0)))
    return got.select(PERIOD_COLUMN, "column", "n", "distinct_exact", distinct_ok.alias("distinct_ok"),
                      quantiles_ok.alias("quantiles_ok"))


def merged_topk_accuracy(df: DataFrame, store: DataFrame, date_column: str, freq: str,
                         column: str, top_k: int = 20) -> DataFrame:
    """Per period: values of ``column`` and whether each reported frequency is
    within ``TOPK_ERROR`` of the values, for more items than the state tracks."""
    rows = with_period(df, date_column, freq).where(F.col(quote(column)).isNotNull())
    exact = rows.groupBy(PERIOD_COLUMN, F.col(quote(column)).cast("string").alias("item")).agg(
        F.count(F.lit(1)).alias("exact"))
    told = frequent_items(store.where(F.col("column") == column), top_k).select(
        PERIOD_COLUMN, "item", F.col("count").alias("told"))
    both = exact.join(told, [PERIOD_COLUMN, "item"], "full").groupBy(PERIOD_COLUMN).agg(
        F.sum("exact").alias("n"),
        F.max(F.abs(F.col("told") - F.coalesce("exact", F.lit(0)))).alias("off"))
    return both.select(PERIOD_COLUMN, "n", (F.coalesce("off", F.lit(0)) <= TOPK_ERROR * F.col("n") + 1).alias("topk_ok"))
