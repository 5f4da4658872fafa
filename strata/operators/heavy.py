"""Heavy hitters with exact counts, for columns of every type.

A frequent-items sketch alone gives estimates, and only for some types.  Here it
only proposes candidates, which are then counted:

1. one aggregate tracks, per group and column, the hashes of the values (64 bits
   of the value's text, so any type will do) in a sketch of fixed size;
2. the rows whose hashes were proposed are counted by their whole text.

A value held by more than ``bound`` rows is always proposed, so the result, every
value above ``bound`` with its exact count, is complete.  ``bound`` is a fixed share of
the group's non-null rows: ``SLACK / map size``.  Raise ``capacity`` to lower it.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.metrics import cols, quote
from strata.functions.names import free_prefix

#: Twice the sketch's guaranteed error of 3.5 rows in its map's size: an item above
#: it has a lower bound above the error and is always listed.
SLACK = 7.0


def map_size(capacity: int) -> int:
    """Slots of the sketch that tracks ``capacity`` items."""
    return 2 ** math.ceil(math.log2(math.ceil(capacity / 0.75)))


def value_text(column: Column, kind: T.DataType) -> Column:
    """The text that stands for a value; null for null."""
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return (column + F.lit(0.0).cast(kind)).cast("string")  # -0.0 and 0.0 are one value
    if isinstance(kind, T.BinaryType):
        return F.hex(column)
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(column)
    return column.cast("string")


def heavy_hitters(df: DataFrame, columns: Iterable[str] | None = None, *, by: str | Sequence[str] | None = None,
                  capacity: int = 1024) -> DataFrame:
    """``(by..., column, item, count, rows, bound)``: every value that more than ``bound``
    of the group's ``rows`` non-null values equal, with its exact count."""
    if capacity < 1:
        raise ValueError("capacity must be >= 1")
    keys = [by] if isinstance(by, str) else list(by or [])
    kinds = {f.name: f.dataType for f in df.schema.fields}
    names = list(columns) if columns is not None else [c for c in df.columns if c not in keys]
    clash = set(keys) & {"column", "item", "count", "rows", "bound"}
    if clash:
        raise ValueError(f"rename the key columns {sorted(clash)}")
    own = free_prefix(keys, "__")
    texts = {c: value_text(F.col(quote(c)), kinds[c]) for c in names}
    size = map_size(capacity)

    src = df.select(*cols(keys), *[F.when(texts[c].isNotNull(), F.xxhash64(texts[c])).alias(f"{own}{i}") for i, c in enumerate(names)])
    aggs = []
    for i in range(len(names)):
        aggs += [F.count(f"{own}{i}").alias(f"{own}n{i}"),
                 F.expr(f"approx_top_k_accumulate({own}{i}, {capacity}) FILTER (WHERE {own}{i} IS NOT NULL)").alias(f"{own}s{i}")]
    wide = src.groupBy(*cols(keys)).agg(*aggs)
    found = [F.struct(F.lit(c).alias("column"), F.col(f"{own}n{i}").alias("rows"),
                      F.expr(f"transform(approx_top_k_estimate({own}s{i}, {capacity}), x -> x.item)").alias("items"))
             for i, c in enumerate(names)]
    listed = wide.select(*cols(keys), F.inline(F.array(*found)))
    candidates = listed.select(*[F.col(quote(k)).alias(f"{own}k{j}") for j, k in enumerate(keys)],
                               F.col("column").alias(f"{own}c"), "rows", F.explode("items").alias(f"{own}h"))

    values = F.array(*[F.struct(F.lit(c).alias("column"), texts[c].alias("item")) for c in names])
    long = df.select(*cols(keys), F.inline(values)).where("item IS NOT NULL")
    same = [F.col("column") == F.col(f"{own}c"), F.xxhash64("item") == F.col(f"{own}h")]
    same += [F.col(quote(k)).eqNullSafe(F.col(f"{own}k{j}")) for j, k in enumerate(keys)]
    if not keys:  # at most capacity rows per column
        candidates = F.broadcast(candidates)
    hit = long.join(candidates, same)
    counted = hit.groupBy(*cols(keys), "column", "item").agg(F.count(F.lit(1)).alias("count"), F.max("rows").alias("rows"))
    bound = F.floor(F.lit(SLACK) * F.col("rows") / F.lit(size)).alias("bound")
    return counted.select(*cols(keys), "column", "item", "count", "rows", bound).where(F.col("count") > F.col("bound"))
