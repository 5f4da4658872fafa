"""Size-bounded batches per key (the batch-side ``GroupIntoBatches``).

``group_into_batches(df, key, size)`` adds ``batch_id`` so that every
``(key, batch_id)`` holds at most ``size`` rows (an input that has such a column
keeps it, and the new one gets underscores: ``batch_columns`` tells the names).  Batches are packed densely
inside each input partition: rows are numbered per ``(key, input partition)``
in scan order, so a hot key is numbered by as many tasks as it has input
partitions, never by one task.  The numbering is deterministic for a given
input, so a recomputed task yields the same batches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.metrics import quote
from strata.functions.names import free_name


def batch_columns(df: DataFrame) -> tuple[str, str]:
    """Names under which ``group_into_batches(df, ...)`` adds the batch and the
    input partition."""
    return free_name(df.columns, "batch_id"), free_name(df.columns, "__part")


def group_into_batches(df: DataFrame, key: str | Column, size: int, *,
                       keep_partition: bool = False) -> DataFrame:
    """Add ``batch_id``; with ``keep_partition`` also keep ``__part`` (the
    input partition), so a following ``groupBy(key, "__part", "batch_id")``
    reuses the window's partitioning instead of shuffling again.  See
    ``batch_columns`` for inputs that have columns of these names."""
    if size < 1:
        raise ValueError("size must be >= 1")
    key_col = F.col(quote(key)) if isinstance(key, str) else key
    rid = F.monotonically_increasing_id()
    name, part = batch_columns(df)
    row = free_name([*df.columns, name, part], "__rid")
    tagged = df.withColumn(row, rid).withColumn(part, F.shiftright(F.col(row), 33))
    w = Window.partitionBy(key_col, F.col(part)).orderBy(row)
    seq = F.row_number().over(w) - 1
    batch = F.floor(seq / F.lit(size)).cast("bigint")
    out = tagged.withColumn(name, F.shiftleft(F.col(part), 31) + batch).drop(row)
    return out if keep_partition else out.drop(part)


def batch_sizes(batched: DataFrame, key: str, size: int, batch: str = "batch_id") -> DataFrame:
    """Per key: rows, batches (told apart by ``batch``), largest batch and whether
    every batch fits."""
    per = batched.groupBy(F.col(quote(key)), F.col(quote(batch)).alias("batch")).agg(F.count(F.lit(1)).alias("rows"))
    return per.groupBy(quote(key)).agg(
        F.sum("rows").cast("bigint").alias("n"),
        F.count(F.lit(1)).alias("batches"),
        F.max("rows").alias("max_batch"),
        (F.max("rows") <= F.lit(size)).alias("sizes_ok"),
    )
