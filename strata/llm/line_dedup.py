"""Repeated lines dropped through a sharded minimal perfect hash.

* *Lines.*  Each task of the dealt-out texts hashes its lines (128 bits of the
  key) and keeps one row per group of documents and key: how many documents of
  the group hold it and their largest id.  A line that a third of all documents
  share is then one row per group.  These rows are written once.
* *Index.*  The rows are summed per key and sent to shards by their hash.  Each
  shard numbers its distinct keys by a minimal perfect hash (levels of bit arrays
  after Limasset et al. 2017: a key that is alone in its cell of a level gets
  that cell, the others try the next level; the rank of the cell is its number)
  and fills plain arrays by that number: a 32-bit fingerprint, the count of
  documents, the largest document id.  The index is a written table of one row
  per shard; the shard count follows the number of written rows, so a shard's
  arrays have a bounded size at any input size.
* *Probe.*  The groups' keys go to the shards and are looked up in the arrays
  there; only the keys to drop come back, one list per group.
* *Texts.*  Each group's texts meet their group's list and lose the lines.

Texts are moved once, by the group that their row position falls into, so
neither equal ids nor equal texts make a large group.

Defined cases: a null or empty text is one empty line and stays; a text's lines
count once per document however often it repeats them; every row is a document
of its own, also where rows share an id; a key's lines stay in every row that
has the largest id (null ids are smaller than all others, and rows of null ids
keep a key that only they hold); an empty table gives an empty result; further
columns are kept, and ``n_lines``, ``n_dropped`` and ``kept_text`` get
underscores where the input has such columns.  Keys are told apart by 128 bits of
their hash.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import arrow_schema, byte_slices, free_name, mix64, quoted, word_spans, written

LEAST_CHARS = 20
LEAST_DOCUMENTS = 3
#: Keys and groups' rows that a shard holds on average.
SHARD_ROWS = 1 << 13
#: Groups of documents per partition of the dealt-out texts, and the most bytes of the
#: input (as Spark estimates them) that a group should hold.
GROUPS = 4
GROUP_BYTES = 64 << 20
#: Estimates from here on mean that Spark does not know the size.
UNKNOWN_BYTES = 1 << 50
#: Cells of a level per key that is left.
GAMMA = 2.0
#: Fixed value: rows of null ids sort before all others.
NULL_ID = -(2**63)
COUNT_TOP = 2**32 - 1

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_LEVEL = 0x9E3779B97F4A7C15

INDEX = "shard int, keys int, levels array<int>, bits binary, prints binary, counts binary, tops binary"


# ------------------------------------------------------------------- lines

class Lines:
    """The lines of one slice of texts: where they are and their keys' hashes."""

    def __init__(self, data: np.ndarray, off: np.ndarray, least_chars: int):
        #: line ends are the line feeds of each text and the text's own end
        feeds = np.flatnonzero(data == 10)
        text = np.searchsorted(off, feeds, "right") - 1
        last = np.arange(len(off) - 1)
        self.text = np.concatenate([text, last])
        ends = np.concatenate([feeds, off[1:]])
        order = np.lexsort((ends, self.text))  # the text's end comes after its feeds
        self.text, self.ends = self.text[order], ends[order]
        first = np.ones(len(self.ends), bool)
        first[1:] = self.text[1:] != self.text[:-1]
        self.starts = np.where(first, off[self.text], np.concatenate([[0], self.ends[:-1] + 1]))
        word_starts, word_ends, _ = word_spans(data, off, ~_SPACE)
        i = np.searchsorted(word_starts, self.starts, "left")
        j = np.searchsorted(word_ends, self.ends, "right") - 1
        some = i <= j
        a, b = np.where(some, i, 0), np.where(some, j, 0)
        low = word_starts[a] if len(word_starts) else np.zeros(len(i), np.int64)
        high = word_ends[b] if len(word_ends) else np.zeros(len(i), np.int64)
        points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        #: lines whose key is long enough to be dropped
        self.long = np.flatnonzero(some & (points[high] - points[low] >= least_chars))
        body = memoryview(_LOWER[data].tobytes())
        digest = xxhash.xxh3_128_digest
        raw = b"".join([digest(body[s:e]) for s, e in zip(low[self.long].tolist(), high[self.long].tolist())])
        self.keys = np.frombuffer(raw, ">u8").reshape(-1, 2).astype(np.uint64)

    def cut(self, data: np.ndarray, gone: np.ndarray) -> Iterator[tuple[int, bytes]]:
        """``(text, what is left)`` of every text that loses one of the lines ``gone`` (flags)."""
        body = data.tobytes()
        for t in np.unique(self.text[gone]).tolist():
            a, b = np.searchsorted(self.text, [t, t + 1])
            stay = np.flatnonzero(~gone[a:b]) + a
            yield t, b"\n".join([body[s:e] for s, e in zip(self.starts[stay].tolist(), self.ends[stay].tolist())])


def _pairs(keys: np.ndarray) -> np.ndarray:
    """Rows of two words as one sortable value each."""
    return np.ascontiguousarray(keys.astype(">u8")).view("V16").ravel()


# ------------------------------------------------------- minimal perfect hash

def _cells(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        step = mix64(np.array([level + 1], np.uint64) * np.uint64(_LEVEL))
        return (mix64(keys[:, 0] ^ mix64(keys[:, 1] + step)) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """Numbers the distinct ``keys`` it was built over 0 .. n-1 without gaps;
    any other key gets some number or -1."""

    def __init__(self, levels: list[int], bits: bytes):
        self.levels = levels
        self.flags = np.unpackbits(np.frombuffer(bits, np.uint8), count=sum(levels)).astype(bool)
        self.rank = np.cumsum(self.flags) - 1

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels, flags, left = [], [], keys
        while len(left):
            size = max(8, math.ceil(GAMMA * len(left)))
            cell = _cells(left, len(levels), size)
            alone = np.bincount(cell, minlength=size) == 1
            levels.append(size)
            flags.append(alone)
            left = left[~alone[cell]]
        return cls(levels, np.packbits(np.concatenate(flags) if flags else np.zeros(0, bool)).tobytes())

    @property
    def bits(self) -> bytes:
        return np.packbits(self.flags).tobytes()

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, np.int64)
        left, start = np.arange(len(keys)), 0
        for level, size in enumerate(self.levels):
            cell = _cells(keys[left], level, size) + start
            hit = self.flags[cell]
            out[left[hit]] = self.rank[cell[hit]]
            left, start = left[~hit], start + size
        return out


def _prints(keys: np.ndarray) -> np.ndarray:
    """32-bit fingerprints, from a mix of their own."""
    return (mix64(keys[:, 1] ^ np.uint64(0xA0761D6478BD642F)) >> np.uint64(32)).astype(np.uint32)


class Shard:
    """One shard of the index: the hash and its arrays."""

    def __init__(self, levels: list[int], bits: bytes, prints: bytes, counts: bytes, tops: bytes):
        self.hash = PerfectHash(levels, bits)
        self.prints = np.frombuffer(prints, np.uint32)
        self.counts = np.frombuffer(counts, np.uint32)
        self.tops = np.frombuffer(tops, np.int64)

    def probe(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count and largest id of each key; count 0 for keys that are not here."""
        n = self.hash.numbers(keys)
        here = n >= 0
        here[here] = self.prints[n[here]] == _prints(keys[here])
        counts, tops = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        counts[here], tops[here] = self.counts[n[here]], self.tops[n[here]]
        return counts, tops


def _key_columns(table: pa.Table | pa.RecordBatch) -> np.ndarray:
    return np.stack([table["h"].to_numpy().view(np.uint64), table["g"].to_numpy().view(np.uint64)], 1)


def build_shard(table: pa.Table) -> pa.Table:
    """The index row of one shard from its ``(shard, h, g, docs, top)`` rows."""
    keys = _key_columns(table)
    mph = PerfectHash.build(keys)
    at = mph.numbers(keys)
    prints, counts, tops = np.zeros(len(keys), np.uint32), np.zeros(len(keys), np.uint32), np.zeros(len(keys), np.int64)
    prints[at] = _prints(keys)
    counts[at] = np.minimum(table["docs"].to_numpy(), COUNT_TOP)
    tops[at] = table["top"].to_numpy()
    return pa.table({
        "shard": pa.array([table["shard"][0].as_py()], pa.int32()), "keys": pa.array([len(keys)], pa.int32()),
        "levels": pa.array([mph.levels], pa.list_(pa.int32())), "bits": pa.array([mph.bits], pa.binary()),
        "prints": pa.array([prints.tobytes()], pa.binary()), "counts": pa.array([counts.tobytes()], pa.binary()),
        "tops": pa.array([tops.tobytes()], pa.binary())})


# ------------------------------------------------------------------- stages

def _group_count(docs: DataFrame) -> int:
    """Groups of documents: at least ``GROUPS`` per shuffle partition, more where the
    input is known to be large, so that a group fits a task at any size.  Where Spark
    does not know the size, the shuffle width alone decides."""
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(GROUPS * width, math.ceil(size / GROUP_BYTES) if size < UNKNOWN_BYTES else 0)


def _line_rows(dealt: DataFrame, least_chars: int) -> DataFrame:
    """``(grp, h, g, docs, top)``: per group of documents and key."""

    def lines(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grp, ids = batch["grp"].to_numpy(), batch["id"].fill_null(NULL_ID).to_numpy()
            for a, b, data, off in byte_slices(batch["text"]):
                found = Lines(data, off, least_chars)
                rows = found.text[found.long] + a
                # once per document
                order = np.lexsort((found.keys[:, 1], found.keys[:, 0], rows))
                k, r = found.keys[order], rows[order]
                new = np.ones(len(r), bool)
                new[1:] = (r[1:] != r[:-1]) | (k[1:] != k[:-1]).any(1)
                k, r = k[new], r[new]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(grp[r]), pa.array(k[:, 0].view(np.int64)), pa.array(k[:, 1].view(np.int64)),
                     pa.array(ids[r])], names=["grp", "h", "g", "top"])

    held = dealt.select("grp", "id", "text").mapInArrow(lines, "grp int, h long, g long, top long")
    return held.groupBy("grp", "h", "g").agg(F.count(F.lit(1)).alias("docs"), F.max("top").alias("top"))


def build_index(rows: DataFrame, shards: int) -> DataFrame:
    """The index over the distinct keys of ``rows``, one row per shard."""
    keys = rows.groupBy("h", "g").agg(F.sum("docs").alias("docs"), F.max("top").alias("top"))
    dealt = keys.withColumn("shard", F.pmod("h", F.lit(shards)).cast("int"))
    return dealt.groupBy("shard").applyInArrow(build_shard, INDEX)


def probe_index(rows: DataFrame, index: DataFrame, shards: int, least_documents: int) -> DataFrame:
    """``(grp, h, g, top)`` of the groups' keys that at least ``least_documents``
    documents hold, looked up in the arrays of their shards."""

    def probe(left: pa.Table, right: pa.Table) -> pa.Table:
        empty = pa.table({"grp": pa.array([], pa.int32()), **{c: pa.array([], pa.int64()) for c in ("h", "g", "top")}})
        if not len(left) or not len(right):
            return empty
        row = right.slice(0, 1).to_pylist()[0]
        shard = Shard(row["levels"], row["bits"], row["prints"], row["counts"], row["tops"])
        counts, tops = shard.probe(_key_columns(left))
        drop = pa.array(counts >= least_documents)
        return left.select(["grp", "h", "g"]).append_column("top", pa.array(tops)).filter(drop)

    dealt = rows.select("grp", "h", "g", F.pmod("h", F.lit(shards)).cast("int").alias("shard"))
    return dealt.groupBy("shard").cogroup(index.groupBy("shard")).applyInArrow(
        probe, "grp int, h long, g long, top long")


def drop_repeated_lines(docs: DataFrame, least_chars: int = LEAST_CHARS,
                        least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """``docs`` with ``n_lines``, ``n_dropped`` and ``kept_text`` (see module doc)."""
    groups = _group_count(docs)
    names = {c: free_name(docs, c) for c in ("n_lines", "n_dropped", "kept_text")}
    rest = [c for c in docs.columns]
    packed = docs.select(F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)).cast("int").alias("grp"),
                         quoted("doc_id").cast("long").alias("id"), quoted("text").alias("text"),
                         F.struct(*[quoted(c).alias(f"c{i}") for i, c in enumerate(rest) if c != "text"]).alias("others"))
    dealt = packed.repartition(math.ceil(groups / GROUPS), "grp")
    rows = written(_line_rows(dealt, least_chars), "lines")
    shards = max(1, math.ceil(rows.count() / SHARD_ROWS))  # the count is read from the files' footers
    index = written(build_index(rows, shards), "line-index")
    gone = probe_index(rows, index, shards, least_documents)

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.combine_chunks()
        n_lines, n_dropped = np.zeros(len(left), np.int64), np.zeros(len(left), np.int64)
        kept: list[str | None] = [None] * len(left)
        ids = left["id"].fill_null(NULL_ID).to_numpy()
        known, tops = _pairs(_key_columns(right)), right["top"].to_numpy()
        order = np.argsort(known)
        known, tops = known[order], tops[order]
        for a, _, data, off in byte_slices(left["text"]):
            found = Lines(data, off, least_chars)
            n_lines[a:a + len(off) - 1] = np.bincount(found.text, minlength=len(off) - 1)
            gone = np.zeros(len(found.text), bool)
            if len(known) and len(found.long):
                k = _pairs(found.keys)
                at = np.minimum(np.searchsorted(known, k), len(known) - 1)
                gone[found.long] = (known[at] == k) & (tops[at] != ids[a + found.text[found.long]])
            n_dropped[a:a + len(off) - 1] = np.bincount(found.text[gone], minlength=len(off) - 1)
            for t, body in found.cut(data, gone):
                kept[a + t] = body.decode()
        return pa.table({"text": left["text"], "others": left["others"], "n_lines": n_lines, "n_dropped": n_dropped,
                         "kept": pa.array(kept, pa.string())})

    out = dealt.groupBy("grp").cogroup(gone.groupBy("grp")).applyInArrow(
        cut, arrow_schema(dealt.select("text", "others"), {"n_lines": "long", "n_dropped": "long", "kept": "string"}))
    keep = [F.col("text") if c == "text" else F.col(f"others.c{i}") for i, c in enumerate(rest)]
    return out.select(*[k.alias(c) for k, c in zip(keep, rest)], F.col("n_lines").alias(names["n_lines"]),
                      F.col("n_dropped").alias(names["n_dropped"]),
                      F.when(F.col("n_dropped") == 0, F.coalesce("text", F.lit(""))).otherwise(F.col("kept"))
                      .alias(names["kept_text"]))
