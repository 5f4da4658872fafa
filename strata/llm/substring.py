"""Repeated passages by window hashing, in place of a relative Lempel-Ziv parse.

The reference is the corpus itself in ascending document order, and it is
indexed in two block sizes, so that what is sent around stays small:

* *content blocks*: a text is cut where a hash of its words says so (about
  every ``BLOCK`` words), and each block is extended by the ``window - 1`` words
  after it.  If an extended block occurs in an earlier document, every window
  that starts in the block does too.
* *windows* of ``window`` words, only for blocks that are new in their document
  and only where the window's smallest ``GRAM``-word hash (its minimizer) occurs
  in more than one document: two equal windows have equal minimizers, so no
  other window can have an earlier occurrence.

Each window of a document is flagged by look-ups in this index, and the union of
the flagged windows' words is removed.  No factor (reference document, position,
length) is made: windows that touch may come from several documents, and words
are not compared after equal hashes.  A look-up never joins occurrences with each other:
the index is a minimum of the document id per hash, so a passage in a third of
all documents costs one row per document before map-side combining.

Index entries are 64-bit hashes of the word sequence, whose length is hashed
too.  Words are those between ASCII white space, unchanged.

Defined cases: null or blank text has no words and keeps an empty text; every
row is a document of its own, also where rows share an id: they follow each
other in the order of their ids (null ids first), then of the input, and a
window is removed for occurring in an earlier row of the same id; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import Powers, byte_slices, mix64, ranges, word_hashes, word_spans, written

WINDOW = 20
GRAM = 6
BLOCK = 32

_WORD = np.ones(256, bool)
_WORD[[0x20, *range(0x09, 0x0E)]] = False
_SEQUENCE = Powers(0xC2B2AE3D27D4EB4F)
NULL_ID = -(2**63)  # order of a null id


class Parsed:
    """The words of the texts of one slice and the hashes of their windows."""

    def __init__(self, data: np.ndarray, off: np.ndarray, window: int):
        self.data = data
        self.starts, self.ends, self.first = word_spans(data, off, _WORD)
        self.window = window
        h = word_hashes(data, self.starts, self.ends)
        n = len(h)
        self.n = n
        up, self.down = _SEQUENCE.upto(n + 1)
        self.prefix = np.zeros(n + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(h * up[:n], out=self.prefix[1:])
        counts = np.maximum(np.diff(self.first) - window + 1, 0)
        #: first word of every window, and the text that it is in
        self.at = ranges(self.first[:-1], counts)
        self.text = np.repeat(np.arange(len(counts)), counts)
        self.hash = self.sequence(self.at, self.at + window)

    def sequence(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Hash of the words from a to b (exclusive)."""
        with np.errstate(over="ignore"):
            return mix64((self.prefix[b] - self.prefix[a]) * self.down[a] + (b - a).astype(np.uint64))

    def grams(self, k: int) -> np.ndarray:
        i = np.arange(max(self.n - k + 1, 0))
        return self.sequence(i, i + k)

    def minimizers(self) -> np.ndarray:
        """Smallest GRAM-word hash inside each window."""
        gram = min(GRAM, self.window)
        g, width = self.grams(gram), self.window - gram + 1
        have = 1
        low = g
        while 2 * have <= width:
            low = np.minimum(low[:-have], low[have:])
            have *= 2
        rest = width - have
        if rest:
            low = np.minimum(low[:-rest], low[rest:])
        return low[self.at] if len(self.at) else np.zeros(0, np.uint64)

    def blocks(self) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the extended content block of each window, and whether the
        window is the first of its block."""
        if len(self.at) == 0:
            return np.zeros(0, np.uint64), np.zeros(0, bool)
        k = min(4, self.window)
        cut = self.grams(k)[self.at] % np.uint64(BLOCK) == 0
        cut |= np.concatenate([[True], self.text[1:] != self.text[:-1]])
        lead = np.flatnonzero(cut)
        last = np.append(lead[1:], len(self.at)) - 1
        h = self.sequence(self.at[lead], self.at[last] + self.window)
        return np.repeat(h, last - lead + 1), cut

    def new_in_text(self) -> np.ndarray:
        """Windows that do not occur earlier in the same text."""
        order = np.argsort(self.hash, kind="stable")
        same = np.zeros(len(order), bool)
        h, t = self.hash[order], self.text[order]
        same[1:] = (h[1:] == h[:-1]) & (t[1:] == t[:-1])
        out = np.ones(len(order), bool)
        out[order[same]] = False
        return out


def _pair(text: np.ndarray, h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix64(h + mix64(text.astype(np.uint64) + np.uint64(0x51ED27)))


def _member(text: np.ndarray, h: np.ndarray, lists: pa.Array) -> np.ndarray:
    """Whether each ``(text, hash)`` is in that text's list."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    counts = np.array([0 if v is None else v for v in pa.compute.list_value_length(lists).to_pylist()], np.int64)
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    return np.isin(_pair(text, h), _pair(np.repeat(np.arange(len(counts)), counts), values))


def _index_entries(docs: DataFrame, window: int) -> DataFrame:
    """``h, doc``: content blocks (lowest bit 0) and minimizers (lowest bit 1)."""

    def run(batches):
        for b in batches:
            for x, y, data, off in byte_slices(b.column(1)):
                p = Parsed(data, off, window)
                doc = b.column(0).slice(x, y - x).to_numpy(zero_copy_only=False)
                block, lead = p.blocks()
                t = np.concatenate([p.text[lead], p.text])
                h = np.concatenate([block[lead] & ~np.uint64(1), p.minimizers() | np.uint64(1)])
                _, one = np.unique(_pair(t, h), return_index=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[one].view(np.int64)), pa.array(doc[t[one]])], ["h", "doc"])

    return docs.mapInArrow(run, "h long, doc long")


def _open_windows(p: Parsed, known: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Windows in copied blocks, and windows that the window index must decide.

    ``known`` lists a text's blocks that occur in no earlier document and its
    minimizers that occur in no other."""
    block, _ = p.blocks()
    copied = ~_member(p.text, block & ~np.uint64(1), known)
    shared = ~_member(p.text, p.minimizers() | np.uint64(1), known)
    return copied, ~copied & shared & p.new_in_text()


def _window_entries(listed: DataFrame, window: int) -> DataFrame:
    def run(batches):
        for b in batches:
            for x, y, data, off in byte_slices(b.column(1)):
                p = Parsed(data, off, window)
                doc = b.column(0).slice(x, y - x).to_numpy(zero_copy_only=False)
                _, ask = _open_windows(p, b.column(2).slice(x, y - x))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(p.hash[ask].view(np.int64)), pa.array(doc[p.text[ask]])], ["h", "doc"])

    return listed.mapInArrow(run, "h long, doc long")


def _factors(listed: DataFrame, window: int) -> DataFrame:
    """Cover each text: ``doc_id, n_words, spans, kept_text``."""
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for b in batches:
            for x, y, data, off in byte_slices(b.column(1)):
                p = Parsed(data, off, window)
                copied, ask = _open_windows(p, b.column(2).slice(x, y - x))
                first = _member(p.text, p.hash, b.column(3).slice(x, y - x))
                dup = copied | (ask & ~first) | ~p.new_in_text()
                # windows that occur earlier, each reaching window words
                cover = np.zeros(p.n + 1, np.int64)
                np.add.at(cover, p.at[dup], 1)
                np.add.at(cover, p.at[dup] + window, -1)
                gone = np.cumsum(cover)[:-1] > 0
                raw, keep = p.data.tobytes(), ~gone
                starts, ends = p.starts.tolist(), p.ends.tolist()
                spans, kept = [], []
                for i in range(y - x):
                    a, z = int(p.first[i]), int(p.first[i + 1])
                    edge = np.diff(np.concatenate([[0], gone[a:z].astype(np.int8), [0]]))
                    spans.append([{"start": s, "end": e} for s, e in
                                  zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist())])
                    kept.append(b" ".join([raw[starts[k]:ends[k]] for k in (np.flatnonzero(keep[a:z]) + a).tolist()]).decode("utf-8", "surrogatepass"))
                doc = b.column(4).slice(x, y - x)
                yield pa.RecordBatch.from_arrays(
                    [doc, pa.array(np.diff(p.first), pa.int64()), pa.array(spans, span), pa.array(kept, pa.string())],
                    ["doc_id", "n_words", "spans", "kept_text"])

    return listed.mapInArrow(run, "doc_id long, n_words long, spans array<struct<start:long,end:long>>, kept_text string")


def _keyed(docs: DataFrame) -> DataFrame:
    """``doc, doc_id, text``: ``doc`` is each row's own number, ascending with
    ``doc_id``.  Ids that no two rows share are such numbers already; otherwise
    the rows are sorted (many rows of one id spread over many tasks), numbered
    and written, so that every pass reads the same numbers."""
    order = F.coalesce(F.col("doc_id"), F.lit(NULL_ID))
    if docs.groupBy(order.alias("doc")).count().where("count > 1").isEmpty():
        return docs.withColumn("doc", order)
    rows = docs.withColumn("row", F.monotonically_increasing_id()).orderBy(F.col("doc_id").asc_nulls_first(), "row")
    return written(rows.select(F.monotonically_increasing_id().alias("doc"), "doc_id", "text"), "substring-rows")


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, spans, kept_text``: the word runs (end exclusive)
    covered by windows that start earlier in the corpus, and the rest."""
    if window < 1:
        raise ValueError("window must be at least 1")
    d = _keyed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")))
    entries = _index_entries(d.select("doc", "text"), window)
    index = (entries.groupBy("h").agg(F.min("doc").alias("doc"), F.max("doc").alias("last"))
             .where((F.expr("h & 1") == 0) | (F.col("doc") == F.col("last"))))
    known = index.groupBy("doc").agg(F.collect_list("h").alias("known"))
    listed = d.join(known, "doc", "left")
    ask = _window_entries(listed.select("doc", "text", "known", "doc_id"), window)  # columns as below: one exchange
    firsts = (ask.groupBy("h").agg(F.min("doc").alias("doc"))
              .groupBy("doc").agg(F.collect_list("h").alias("firsts")))
    # both passes over the texts read the same exchange
    return _factors(listed.join(firsts, "doc", "left").select("doc", "text", "known", "firsts", "doc_id"), window)
