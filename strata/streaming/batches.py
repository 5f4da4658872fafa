"""Streaming ``GroupIntoBatches``: batches of at most ``size`` rows per key,
emitted when full or when a key's first held row has waited ``max_wait``
(processing time).

Keys are sharded (``shards`` buckets drawn per row, like a sharded key) so one
hot key is buffered and emitted by many tasks, never by one, even when its rows
are identical copies.

Per (key, shard) the state (``transformWithStateInPandas``) is a list of the held
rows and one mark: how many they are, the next batch number, and the timer that
is set for them.  A trigger only *appends* its new rows to the list; the list is
read when a batch is full or its timer is due, and cleared then.  So a trigger's
work follows its own rows, not the rows held, and a task holds one batch and one
chunk of its input.

Rows pass through Python as one JSON text each, written and read by Spark: every
value comes back as it was (NaN and NULL stay apart, 64-bit integers, decimals
and microseconds stay exact).

Output: the input columns plus ``batch_id`` (shard * 2^32 + sequence number
within the (key, shard)), so ``(key, batch_id)`` identifies a batch of at most
``size`` rows.  An input that has such a column keeps it; the new one then has
underscores added (``batch_column`` tells the name).
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from strata.functions.metrics import cols, quote
from strata.functions.names import free_name

_WAIT_RE = re.compile(r"^\s*(\d+)\s*(ms|millisecond|second|minute|hour)s?\s*$", re.I)
_MS = {"ms": 1, "millisecond": 1, "second": 1000, "minute": 60_000, "hour": 3_600_000}

# Spark's setting and class for state in RocksDB.
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# JSON formats that keep microseconds.
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def _wait_ms(text: str) -> int:
    m = _WAIT_RE.match(text)
    if not m:
        raise ValueError(f"max_wait must look like '30 seconds', got {text!r}")
    return int(m.group(1)) * _MS[m.group(2).lower()]


def batch_column(stream: DataFrame) -> str:
    """Name under which ``stream_group_into_batches`` adds the batch."""
    return free_name(stream.columns, "batch_id")


def use_rocksdb(spark: SparkSession) -> None:
    """Keep streaming state in RocksDB, which list states and timers need.  Queries
    that are already running, or restart from a checkpoint, keep what they have."""
    if spark.conf.get(_PROVIDER, None) != _ROCKSDB:
        spark.conf.set(_PROVIDER, _ROCKSDB)


def stream_group_into_batches(stream: DataFrame, key: str, size: int, *,
                              max_wait: str = "120 seconds", shards: int = 16) -> DataFrame:
    """Streaming batches of at most ``size`` rows per ``key`` value."""
    if size < 1 or shards < 1:
        raise ValueError("size and shards must be >= 1")
    wait_ms = _wait_ms(max_wait)
    use_rocksdb(stream.sparkSession)
    # Shard with a seeded per-partition random sequence: spreads a hot key even
    # when its rows are identical copies (a content hash would not), and a
    # replayed micro-batch (same offsets, same partitions) draws the same shards.
    sharded = stream.select(
        F.col(quote(key)).alias("__key"),
        F.floor(F.rand(7) * F.lit(shards)).cast("bigint").alias("__shard"),
        F.to_json(F.struct(*cols(stream.columns)), _JSON).alias("row"))

    class Batches(StatefulProcessor):
        """One (key, shard): its held rows and ``(held, next batch, timer or 0)``."""

        def init(self, handle):
            self.handle = handle
            self.rows = handle.getListState("rows", "row string")
            self.mark = handle.getValueState("mark", "held long, seq long, due long")

        def _taken(self):
            rows = [r[0] for r in self.rows.get()]
            self.rows.clear()
            return rows

        def handleInputRows(self, key, rows, timerValues):
            held, seq, due = self.mark.get() if self.mark.exists() else (0, 0, 0)
            first = int(key[1]) << 32
            fresh = []  # rows that are not in the state yet
            for pdf in rows:
                fresh += pdf["row"].tolist()
                at = 0
                while held + len(fresh) - at >= size:
                    take = size - held
                    batch = (self._taken() if held else []) + fresh[at:at + take]
                    at, held = at + take, 0
                    if due:
                        self.handle.deleteTimer(due)
                        due = 0
                    yield pd.DataFrame({"row": batch, "batch_id": first + seq})
                    seq += 1
                fresh = fresh[at:]
            if fresh:
                self.rows.appendList([(r,) for r in fresh])
            if fresh and not due:
                due = timerValues.getCurrentProcessingTimeInMs() + wait_ms
                self.handle.registerTimer(due)
            self.mark.update((held + len(fresh), seq, due))

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            held, seq, due = self.mark.get() if self.mark.exists() else (0, 0, 0)
            if held and due == expiredTimerInfo.getExpiryTimeInMs():
                # the sequence number outlives the rows, so batch ids of a key never repeat
                self.mark.update((0, seq + 1, 0))
                yield pd.DataFrame({"row": self._taken(), "batch_id": (int(key[1]) << 32) + seq})

        def close(self):
            pass

    batches = sharded.groupBy("__key", "__shard").transformWithStateInPandas(
        Batches(), "row string, batch_id long", "append", "ProcessingTime")
    return (batches.select(F.from_json("row", stream.schema, _JSON).alias("__row"), "batch_id")
            .select("__row.*", F.col("batch_id").alias(batch_column(stream))))
