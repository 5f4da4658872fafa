"""Sharding by fixed virtual slots.

Every record is hashed (id, text and place in the input, so that no id makes a
hot slot) into one of ``n_slots`` slots, a number that never changes; bytes are aggregated per slot; a small *slot map* says which shard
owns each slot.  Moving data means editing that map: each edit is stored as a
new version, and only the records of the edited slots move.

The largest table that reaches one place is the slot statistics: ``n_slots``
rows, whatever the input.  A record's position inside its shard is numbered
from (written input part, shard) groups, so no task holds a whole shard.

Defined cases: a null id hashes like any value, a null text has no bytes
(crc of nothing, 0), rows that repeat or share an id are spread over the slots by
their place and get positions of their own, an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import scratch, written

N_SLOTS = 4096
ROW_BYTES = 8


@dataclass(frozen=True)
class SlotMap:
    """Owner of each slot; ``version`` counts the edits."""

    version: int
    shards: int
    owner: tuple[int, ...]

    def moved(self, other: "SlotMap") -> list[int]:
        return [s for s, (a, b) in enumerate(zip(self.owner, other.owner)) if a != b]


def digest(docs: DataFrame, n_slots: int = N_SLOTS) -> DataFrame:
    """``doc_id, size, text_crc32, virtual_slot, part`` of every record."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + F.lit(ROW_BYTES)).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        # the id alone would put rows of one id (or of none) into one slot
        F.pmod(F.xxhash64(F.col("doc_id"), F.crc32(text), F.monotonically_increasing_id()), F.lit(n_slots))
        .cast("int").alias("virtual_slot"),
        F.spark_partition_id().alias("part"))


def slot_bytes(records: DataFrame, n_slots: int = N_SLOTS) -> list[int]:
    """Bytes per slot (``n_slots`` numbers)."""
    out = [0] * n_slots
    for r in records.groupBy("virtual_slot").agg(F.sum("size").alias("b")).collect():
        out[r.virtual_slot] = int(r.b)
    return out


def plan_map(sizes: Sequence[int], shards: int) -> SlotMap:
    """First version: heaviest slot first, each to the lightest shard."""
    if shards < 1:
        raise ValueError("shards must be at least 1")
    owner = [0] * len(sizes)
    load = [(0, 0, s) for s in range(shards)]
    for slot in sorted(range(len(sizes)), key=lambda s: (-sizes[s], s)):
        used, slots, shard = heapq.heappop(load)
        owner[slot] = shard
        heapq.heappush(load, (used + sizes[slot], slots + 1, shard))
    return SlotMap(1, shards, tuple(owner))


def rebalance(old: SlotMap, sizes: Sequence[int], shards: int | None = None) -> SlotMap:
    """The next version: slots move only from shards above the mean to the
    lightest shard, and only where that brings the two closer.  With more
    shards than before, the new ones start empty and so are the receivers."""
    shards = shards or old.shards
    if shards < old.shards:
        raise ValueError("a shard is retired by moving its slots first")
    owner = list(old.owner)
    load = [0] * shards
    held: list[list[int]] = [[] for _ in range(shards)]
    for slot, s in enumerate(owner):
        load[s] += sizes[slot]
        held[s].append(slot)
    for h in held:
        h.sort(key=lambda s: (-sizes[s], s))
    fresh = set(range(old.shards, shards))
    targets = fresh or set(range(shards))
    for _ in range(len(sizes)):
        low = min(targets, key=lambda s: (load[s], s))
        high = max((s for s in range(shards) if s not in fresh), key=lambda s: (load[s], -s))
        gap = load[high] - load[low]
        slot = next((s for s in held[high] if 0 < sizes[s] <= gap // 2), None)
        if slot is None or high == low:
            break
        held[high].remove(slot)
        held[low].append(slot)
        owner[slot] = low
        load[high] -= sizes[slot]
        load[low] += sizes[slot]
    return SlotMap(old.version + 1, shards, tuple(owner))


def save_map(spark: SparkSession, slots: SlotMap, path: str) -> None:
    """Write a version; versions are never overwritten."""
    rows = [(i, o, slots.shards) for i, o in enumerate(slots.owner)]
    (spark.createDataFrame(rows, "virtual_slot int, shard int, shards int").coalesce(1)
     .write.mode("error").parquet(f"{path}/version={slots.version}"))


def load_map(spark: SparkSession, path: str, version: int | None = None) -> SlotMap:
    """A stored version, the newest by default."""
    df = spark.read.parquet(path)
    if version is None:
        version = df.agg(F.max("version")).first()[0]
    rows = df.where(F.col("version") == version).orderBy("virtual_slot").collect()
    if not rows:
        raise ValueError(f"no version {version} of the slot map")
    return SlotMap(int(version), rows[0].shards, tuple(r.shard for r in rows))


def assign(records: DataFrame, slots: SlotMap) -> DataFrame:
    """Add each record's ``shard`` (the map has one row per slot: broadcast)."""
    spark = records.sparkSession
    m = spark.createDataFrame(list(enumerate(slots.owner)), "virtual_slot int, shard int")
    return records.join(F.broadcast(m), "virtual_slot")


def number(placed: DataFrame) -> DataFrame:
    """Position of each record inside its shard, from 0 without gaps.

    Groups of (input part, shard) are numbered on their own and then moved by
    the count of the earlier parts of the same shard."""
    counts = placed.groupBy("part", "shard").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("part", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("part", "shard").orderBy("doc_id", "text_crc32", "size")
    return (placed.withColumn("at", F.row_number().over(inside) - 1)
            .join(starts, ["part", "shard"])
            .withColumn("slot", (F.col("first") + F.col("at")).cast("long")).drop("at", "first"))


def shard_documents(docs: DataFrame, shards: int = 24, n_slots: int = N_SLOTS,
                    map_path: str | None = None) -> DataFrame:
    """Place every record: ``doc_id, size, text_crc32, virtual_slot, part,
    shard, slot, map_version``.  The text is read once."""
    spark = docs.sparkSession
    records = written(digest(docs, n_slots), "shard-digest")
    path = map_path or scratch(spark, "slot-map")
    save_map(spark, plan_map(slot_bytes(records, n_slots), shards), path)
    slots = load_map(spark, path)
    return number(assign(records, slots)).withColumn("map_version", F.lit(slots.version))
