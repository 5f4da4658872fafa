"""Hard negatives by a secondary-sort shuffle of pair scores.

* *Scores.*  Anchors and rows are packed into blocks; each task multiplies one
  block of anchors with one block of rows.  Rows and anchors reach their blocks
  by a hash of a row number, so blocks are even whatever ids and labels repeat.
* *Pairs.*  A task sends on what can matter, and nothing else: an anchor's best
  ``positives`` rows of its label in the block, and the rows of other labels that
  reach the lowest window these leave open.  The block's own last positive is at
  most the anchor's last positive, so no pair that a window could take is left
  out.
* *Shuffle.*  Pairs are packed into ``(anchor, descending score, id)`` keys, dealt
  by anchor and sorted within their partition (``repartition`` and
  ``sortWithinPartitions``, the DataFrame form of
  ``repartitionAndSortWithinPartitions``; the sort spills to disk).
* *Stream.*  One iterator walks each partition in that order.  A positive opens a
  window; the negatives that follow fill the open windows until each has
  ``negatives`` of them or the scores fall below it.  An anchor is never held: its
  state is its open windows, also where its pairs span many batches.

A window of a positive score p takes scores s with ``LOW * p <= 100 * s <= HIGH *
p``; positives below zero have no such scores, and a positive of zero takes
scores of zero, which may come before it in the order, so the first few zeros
are remembered.

Defined cases: rows with a null label, a null vector or any null or non-finite
component take no part; ties in the score go to the smaller id, null ids last,
then to the earlier row; every row is a row of its own, also where ids repeat, so
repeated anchors are answered one by one and a copy of an anchor is an "other
row"; a null id is no anchor; vectors of unlike lengths are not compared; an empty
vector scores zero; an empty table gives an empty result; further columns are
ignored.  Scores are exact: integer sums below 2**53 run as doubles, larger ones
as 64-bit integers, and what would not fit those fails the job.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import quoted, written

POSITIVES = 5
NEGATIVES = 3
#: A window's bounds in per cent of the positive's score.
LOW, HIGH = 50, 95
#: Rows and anchors of a block.
ROWS, ANCHORS = 4096, 1024
#: Scores that a task holds at a time.
CHUNK = 1 << 21

RESULT = ("anchor long, anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
          "negative_score long")


def quantised(vector: Column, scale: int = 256) -> Column:
    """``floor(scale * x)`` of every component; null unless all are finite."""
    whole = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                     & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return F.when(vector.isNotNull() & sound, whole)


def _matrix(table: pa.Table) -> np.ndarray:
    col = table["v"].combine_chunks()
    col = col.chunk(0) if isinstance(col, pa.ChunkedArray) else col
    return col.flatten().to_numpy().reshape(len(col), -1)


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of all rows of ``a`` with all rows of ``b``."""
    top = lambda m: int(max(abs(int(m.max())), abs(int(m.min())))) if m.size else 0
    bound = top(a) * top(b) * a.shape[1]
    if bound < 2**53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    if bound < 2**56:  # windows compare a hundred times the score
        return a @ b.T
    raise ValueError("inner products do not fit 64-bit integers")


def _block_pairs(positives: int, low: int):
    """Pairs of one block of anchors and one block of rows."""

    def pairs(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, ...]] = []
        if len(rows) and len(anchors):
            r, a = _matrix(rows), _matrix(anchors)
            label, rid = rows["label"].to_numpy(), rows["rid"].to_numpy()
            a_label, a_rid = anchors["label"].to_numpy(), anchors["rid"].to_numpy()
            ids, known = rows["id"].fill_null(0).to_numpy(), rows["id"].is_valid().to_numpy(zero_copy_only=False)
            # among equal scores: smaller ids first, nulls last, then earlier rows
            order = np.lexsort((rid, ids, ~known))
            r, label, rid, ids, known = r[order], label[order], rid[order], ids[order], known[order]
            step = max(1, CHUNK // len(r))
            for at in range(0, len(a), step):
                s = _scores(a[at:at + step], r)
                same = label[None, :] == a_label[at:at + step, None]
                self_ = rid[None, :] == a_rid[at:at + step, None]
                for k in range(len(s)):
                    mine = np.flatnonzero(same[k] & ~self_[k])
                    best = mine[np.argsort(-s[k, mine], kind="stable")[:positives]]
                    floor = max(0, low * int(s[k, best[-1]])) if len(best) == positives else 0
                    rest = np.flatnonzero(~same[k] & (100 * s[k] >= floor))
                    both = np.concatenate([best, rest])
                    out.append((np.full(len(both), a_rid[at + k]), -s[k, both], ids[both], known[both], rid[both],
                                np.arange(len(both)) < len(best)))
        cols = [np.concatenate(c) if out else np.zeros(0) for c in (zip(*out) if out else [()] * 6)]
        kinds = [np.int64, np.int64, np.int64, bool, np.int64, bool]
        cols = [c.astype(k) for c, k in zip(cols, kinds)]
        return pa.table({"anchor": cols[0], "falling": cols[1], "id": pa.array(cols[2], mask=~cols[3]),
                         "rid": cols[4], "positive": cols[5]})

    return pairs


class Windows:
    """The open windows of the anchor that the stream is at."""

    def __init__(self, anchor: int, positives: int, negatives: int, low: int, high: int):
        self.anchor, self.left, self.want, self.low, self.high = anchor, positives, negatives, low, high
        self.open: list[list] = []  # [positive id, score, taken so far]
        self.zeros: list = []  # first negatives of score zero
        self.done: list[tuple] = []

    def _take(self, window: list, i, s: int) -> None:
        window[2] += 1
        self.done.append((self.anchor, window[0], window[2], i, window[1], s))

    def feed(self, score: np.ndarray, ids: list, positive: np.ndarray) -> None:
        """The anchor's next pairs, in order."""
        at = 0
        opens = np.flatnonzero(positive)[:self.left].tolist() if self.left else []
        for stop in [*opens, len(score)]:
            self._negatives(score, ids, positive, at, stop)
            if stop < len(score):
                self.left -= 1
                p = int(score[stop])
                window = [ids[stop], p, 0]
                if p > 0:
                    self.open.append(window)
                elif p == 0:
                    for i in self.zeros:
                        self._take(window, i, 0)
                    if window[2] < self.want:
                        self.open.append(window)
            at = stop + 1

    def _negatives(self, score: np.ndarray, ids: list, positive: np.ndarray, a: int, b: int) -> None:
        if a >= b:
            return
        part = score[a:b]
        for window in self.open:
            # scores fall: the window's first place by search, then its next negatives
            i = int(np.searchsorted(-100 * part, -self.high * window[1], "left"))
            while i < len(part) and window[2] < self.want and 100 * int(part[i]) >= self.low * window[1]:
                if not positive[a + i]:
                    self._take(window, ids[a + i], int(part[i]))
                i += 1
        end = int(part[-1])
        self.open = [w for w in self.open if w[2] < self.want and 100 * end >= self.low * w[1]]
        if len(self.zeros) < self.want and end <= 0:
            for i in np.flatnonzero((part == 0) & ~positive[a:b])[:self.want - len(self.zeros)].tolist():
                self.zeros.append(ids[a + i])


def _streamed(positives: int, negatives: int, low: int, high: int):
    def rows(done: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*done)) if done else [()] * 6
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        names = ["anchor", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

    def stream(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: Windows | None = None
        for batch in batches:
            anchor, score = batch["anchor"].to_numpy(), -batch["falling"].to_numpy()
            positive, ids = batch["positive"].to_numpy(zero_copy_only=False), batch["id"]
            cuts = [0, *(np.flatnonzero(anchor[1:] != anchor[:-1]) + 1).tolist(), len(anchor)]
            done: list[tuple] = []
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if now is None or now.anchor != anchor[a]:
                    now = Windows(int(anchor[a]), positives, negatives, low, high)
                now.feed(score[a:b], _Lazy(ids, a), positive[a:b])
                done += now.done
                now.done = []
            yield rows(done)

    return stream


class _Lazy:
    """Ids of an Arrow column, read one by one (null: None)."""

    def __init__(self, column: pa.Array, start: int):
        self.column, self.start = column, start

    def __getitem__(self, i: int):
        return self.column[self.start + i].as_py()


def mine(rows: DataFrame, anchors: Column, *, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = LOW, high: int = HIGH, block: tuple[int, int] = (ROWS, ANCHORS)) -> DataFrame:
    """Hard negatives of the rows that ``anchors`` (a condition on ``id``) selects.

    ``rows`` has ``id`` (long), ``label`` and ``v`` (array of long, null: no
    part).  Returns ``RESULT``: per anchor row and positive the first
    ``negatives`` rows of other labels in the positive's window."""
    sound = rows.where(F.col("label").isNotNull() & F.col("v").isNotNull()).select("id", F.col("label").cast("long"), "v")
    # numbered once, so that every later reading sees the same row numbers
    base = written(sound.withColumn("rid", F.monotonically_increasing_id()), "vectors")
    chosen = base.where(anchors)
    n_rows, n_anchors = base.count(), chosen.count()
    across, down = max(1, math.ceil(n_anchors / block[1])), max(1, math.ceil(n_rows / block[0]))
    slot = lambda n: F.pmod(F.xxhash64("rid"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dim = F.size("v").alias("dim")
    left = base.select("*", dim, slot(down).alias("r")).select("*", every(across).alias("a"))
    right = chosen.select("rid", "label", "v", dim, slot(across).alias("a")).select("*", every(down).alias("r"))
    pairs = left.groupBy("a", "r", "dim").cogroup(right.groupBy("a", "r", "dim")).applyInArrow(
        _block_pairs(positives, low), "anchor long, falling long, id long, rid long, positive boolean")
    ordered = pairs.repartition("anchor").sortWithinPartitions(
        "anchor", "falling", F.col("id").asc_nulls_last(), "rid")
    found = ordered.mapInArrow(_streamed(positives, negatives, low, high),
                               RESULT.replace("anchor_id long, ", ""))
    named = chosen.select(F.col("rid").alias("anchor"), F.col("id").alias("anchor_id"))
    return found.join(named, "anchor").select("anchor", "anchor_id", "positive_id", "rank", "negative_id",
                                              "positive_score", "negative_score")


def mine_embeddings(table: DataFrame) -> DataFrame:
    """Hard negatives of an ``embeddings`` table: labels of every seventh id are
    moved by one, components are floored at 1/256, every fiftieth id is an anchor."""
    vec, label = quoted("vec_id").cast("long"), quoted("label").cast("long")
    moved = F.when(vec % 7 == 0, (label + 1) % 10).otherwise(label)
    rows = table.select(vec.alias("id"), moved.alias("label"), quantised(quoted("embedding")).alias("v"))
    return mine(rows, F.col("id") % 50 == 0)
