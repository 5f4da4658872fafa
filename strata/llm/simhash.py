"""SimHash near-duplicates, found by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into three segments of 22, 21 and 21 bits.  The
binary Golay code [23, 12, 7] is perfect: every 23-bit word lies within three
bits of exactly one codeword, so decoding maps a segment to a 12-bit codeword
index, and the indices reached from a segment and its one-bit neighbours (one
or six of them) are shared by any segment one bit away.

At most three differing bits fall on three segments, which leaves two cases:

* every segment differs by at most one bit: the triple of indices agrees, when
  each segment uses its own index on one side and its neighbours' on the other;
* some segment takes two or three bits: of the other two, one is equal and one
  differs by at most one bit, so (equal segment, index of the other) agrees.

Keys are therefore 33 to 36 bits of the fingerprint.  They are joined
(one side's own keys with the other side's neighbour keys), each pair is
verified by its bit distance, and the links' components are found by
alternating star contraction.  Copies meet before any of that: the keys are
made from distinct fingerprints.  Every join has two sides that grow with the
input, and a side made in Python is many times the files it is made from, which
Spark takes for its size: all are merge joins, so none passes through the driver.

Defined cases: null or blank text has fingerprint zero and links like any
other; a null id takes no part in the minimum (the component of null ids alone
is null); repeated rows count once per fingerprint; an empty table gives an
empty result; further columns are carried by ``drop_near_duplicates``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import arrow_schema, free_name, quoted, written

SHINGLE = 3
MAX_BITS = 3
SEED = 42
# Segment widths, and the Golay generator polynomial
# x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
WIDTHS = (22, 21, 21)
GENERATOR = 0b101011100011

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of the ASCII-lower-cased word shingles of a text (unsigned)."""
    ws = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not ws:
        return 0
    n = len(ws) - shingle + 1
    digest = xxhash.xxh64_intdigest
    if n < 2:
        hs = [digest(b" ".join(ws), SEED)]
    else:
        line = b" ".join(ws)
        ends = np.cumsum(np.fromiter(map(len, ws), np.int64, len(ws)) + 1)
        starts = np.concatenate([[0], ends[:-1]])[:n].tolist()
        hs = [digest(line[a:b], SEED) for a, b in zip(starts, (ends[shingle - 1:] - 1).tolist())]
    return int(majority(np.array(hs, np.uint64)))


def majority(hs: np.ndarray, step: int = 1 << 16) -> np.uint64:
    """Bits set in over half of the hashes."""
    count = np.zeros(64, np.int64)
    for a in range(0, len(hs), step):
        part = hs[a:a + step].astype("<u8")
        count += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * count > len(hs)).astype(np.uint8)
    return np.packbits(bits, bitorder="little").view("<u8")[0]


def with_fingerprint(docs: DataFrame, name: str = "fp", shingle: int = SHINGLE) -> DataFrame:
    """``docs`` plus the fingerprint of ``text`` as a signed 64-bit number."""
    schema = arrow_schema(docs, {name: "long"})
    text_at = docs.columns.index("text")

    def run(batches):
        for b in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in b.column(text_at)], np.uint64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(fps.view(np.int64))], schema.names)

    return docs.mapInArrow(run, schema)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, fp`` of every document."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return with_fingerprint(d, "fp", shingle).drop("text")


class Golay:
    """Decoder tables of the code: parity of each index, error of each syndrome."""

    def __init__(self):
        index = np.arange(1 << 12, dtype=np.int64)
        rest = index << 11
        for bit in range(22, 10, -1):
            rest = np.where((rest >> bit) & 1, rest ^ (GENERATOR << (bit - 11)), rest)
        self.parity = rest
        bits = [1 << i for i in range(23)]
        errors = [0] + bits + [a | b for i, a in enumerate(bits) for b in bits[:i]]
        errors += [a | b | c for i, a in enumerate(bits) for j, b in enumerate(bits[:i]) for c in bits[:j]]
        errors = np.array(errors, np.int64)
        self.leader = np.zeros(1 << 11, np.int64)
        self.leader[self.syndrome(errors)] = errors

    def syndrome(self, v: np.ndarray) -> np.ndarray:
        return (v & 0x7FF) ^ self.parity[v >> 11]

    def decode(self, v: np.ndarray) -> np.ndarray:
        """Index of the codeword within three bits of each 23-bit word."""
        return (v ^ self.leader[self.syndrome(v)]) >> 11

    def around(self, v: np.ndarray, width: int) -> np.ndarray:
        """(n, 6) distinct indices of each word and its one-bit neighbours,
        padded with -1."""
        near = v[:, None] ^ np.concatenate([[0], 1 << np.arange(width, dtype=np.int64)])[None, :]
        idx = np.sort(self.decode(near), axis=1)
        new = np.ones(idx.shape, bool)
        new[:, 1:] = idx[:, 1:] != idx[:, :-1]
        rank = np.cumsum(new, axis=1) - 1
        out = np.full((len(v), int(rank[:, -1].max(initial=0)) + 1), -1, np.int64)
        r, c = np.nonzero(new)
        out[r, rank[r, c]] = idx[r, c]
        return out


_GOLAY: list[Golay] = []


def golay() -> Golay:
    if not _GOLAY:
        _GOLAY.append(Golay())
    return _GOLAY[0]


def segments(fp: np.ndarray) -> list[np.ndarray]:
    u, out, at = fp.view(np.uint64), [], 0
    for w in WIDTHS:
        out.append(((u >> np.uint64(at)) & np.uint64((1 << w) - 1)).astype(np.int64))
        at += w
    return out


def keys(fp: np.ndarray, own: bool) -> tuple[np.ndarray, np.ndarray]:
    """``(row, key)`` of one side: a fingerprint's own keys or its neighbours'.
    The top four bits of a key tell the kind."""
    g, seg = golay(), segments(fp)
    home = [g.decode(s) for s in seg]
    ball = [g.around(s, w) for s, w in zip(seg, WIDTHS)]
    rows, out = [], []

    def emit(kind: int, value: np.ndarray, ok: np.ndarray):
        r = np.nonzero(ok)[0]
        rows.append(r)
        out.append((kind << 60) | value[ok])

    if own:  # own, own, neighbours
        v = (home[0] << 24 | home[1] << 12)[:, None] | np.maximum(ball[2], 0)
        emit(0, v, ball[2] >= 0)
    else:  # neighbours, neighbours, own
        a, b = ball[0][:, :, None], ball[1][:, None, :]
        v = (np.maximum(a, 0) << 24 | np.maximum(b, 0) << 12) | home[2][:, None, None]
        emit(0, v, (a >= 0) & (b >= 0))
    kind = 1
    for a in range(3):
        for b in range(3):
            if a == b:
                continue
            if own:
                emit(kind, seg[a] << 12 | home[b], np.ones(len(fp), bool))
            else:
                emit(kind, (seg[a] << 12)[:, None] | np.maximum(ball[b], 0), ball[b] >= 0)
            kind += 1
    return np.concatenate(rows), np.concatenate(out)


def keyed(fps: DataFrame, own: bool) -> DataFrame:
    """``key, fp`` rows of one side of the candidate join."""

    def run(batches):
        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for at in range(0, len(fp), 4096):
                part = fp[at:at + 4096]
                r, k = keys(part, own)
                yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(part[r])], ["key", "fp"])

    return fps.select("fp").mapInArrow(run, "key long, fp long")


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Verified links ``a < b`` between distinct fingerprints."""
    if not 0 <= max_bits <= 3:
        raise ValueError("the key scheme covers up to three differing bits")
    own = keyed(fps, True).withColumnRenamed("fp", "a")
    near = keyed(fps, False).withColumnRenamed("fp", "b")
    hit = own.join(near.hint("merge"), (own["key"] == near["key"]) & (F.col("a") != F.col("b"))
                   & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits))
    return hit.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``node, root`` of every node with an edge (``a, b``), by alternating
    large-star and small-star steps (Kiveris et al. 2014).  Each step is one
    minimum per node and one join; the edges are written out between rounds, and
    the minima before their join, so that Spark can split a node with many edges."""
    e = written(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), "links")
    state = None
    for _ in range(rounds):
        # large star: a node's larger neighbours go to its smallest one
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = both.where("v > u").join(low.hint("merge"), "u").select(F.col("m").alias("a"), F.col("v").alias("b"))
        large = written(large.distinct(), "links")
        # small star: a node and its smaller neighbours go to the smallest
        low = written(large.groupBy("b").agg(F.min("a").alias("m")), "least")
        small = large.join(low.hint("merge"), "b").select(F.col("m").alias("a"), F.col("a").alias("b")).where("a <> b")
        e = written(small.unionAll(low.select(F.col("m").alias("a"), "b")).distinct(), "links")
        now = e.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        if state == now:
            return e.select(F.col("b").alias("node"), F.col("a").alias("root"))
        state = now
    raise RuntimeError("components did not settle")


def classes(own: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``fp, root, component_id`` of every distinct fingerprint of ``doc_id, fp``
    rows; ``root`` names the component."""
    one = written(own.groupBy("fp").agg(F.min("doc_id").alias("first")), "fp-classes")
    roots = written(components(links(one, max_bits)), "fp-roots")
    named = written(one.join(roots.hint("merge"), one["fp"] == roots["node"], "left")
                    .select("fp", "first", F.coalesce("root", "fp").alias("root")), "fp-named")
    least = written(named.groupBy("root").agg(F.min("first").alias("component_id")), "fp-least")
    return written(named.join(least.hint("merge"), "root").select("fp", "root", "component_id"), "fp-components")


def cluster(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``doc_id, fp, component_id``: the smallest id that links reach."""
    own = written(fingerprints(docs, shingle), "fingerprints")
    return own.join(classes(own, max_bits).hint("merge"), "fp").select("doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One document of each component, the one with the smallest id (of rows
    that share it, the first as written), with the columns of ``docs``."""
    fp, at = free_name(docs, "near_fp"), free_name(docs, "near_row")
    stored = written(with_fingerprint(docs, fp, shingle).withColumn(at, F.monotonically_increasing_id()), "near-docs")
    own = stored.select(quoted(fp).alias("fp"), F.col("doc_id").cast("long").alias("doc_id"), quoted(at).alias("at"))
    keep = written(own.join(classes(own, max_bits).hint("merge"), "fp")
                   .where(F.col("doc_id").eqNullSafe(F.col("component_id")))
                   .groupBy("root").agg(F.min("at").alias(at)).select(at), "near-keep")
    # the list of kept rows grows with the input: never broadcast
    return stored.join(keep.hint("merge"), at, "left_semi").select(*[quoted(c) for c in docs.columns])
