"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The patterns are windows of consecutive words of the benchmark items.  Words
are numbered by the patterns' vocabulary, so a text becomes a sequence of word
numbers, and patterns of one length m form a Wu-Manber matcher:

* ``shift``: for each hashed block of two words, how far the window may move
  because no pattern has that block nearer to its end; most positions are
  never looked at;
* ``bucket``: for blocks that end a pattern (shift 0), the patterns with that
  suffix hash, each with the hash of its first block;
* a candidate whose first block agrees is compared word by word, and the
  matched words byte by byte with the vocabulary.

The search advances many stretches of text at once (NumPy lanes, each with its
own position), so the skips pay without a Python loop per word.

The benchmark is a stated query set: it is read in blocks of ``BLOCK_BYTES``,
each small enough to send to every task, and all documents are searched
against every block.

Defined cases: null or blank texts and items have no words; items with one id
count as one item, a null id as the item ``null``; repeated rows are searched
one by one; an empty benchmark hits nothing; further columns are carried.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import (
    arrow_schema, byte_slices, free_name, mix64, quoted, ranges, word_hashes, word_spans, written,
)

WINDOW = 10
BLOCK_BYTES = 8 << 20
TABLE_BITS = 18
STRETCH = 256

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[0x30:0x3A] = _WORD[0x61:0x7B] = _WORD[0x80:] = True


def _hash2(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (a.astype(np.uint64) << np.uint64(32)) | b.astype(np.uint64)
    return (mix64(x + np.uint64(1)) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


class Matcher:
    """Wu-Manber tables for patterns (rows of word numbers) of one length."""

    def __init__(self, patterns: np.ndarray):
        self.patterns = patterns
        n, m = patterns.shape
        self.m, self.block = m, min(2, m)
        # shift of each block: its least distance from a pattern's end
        self.shift = np.full(1 << TABLE_BITS, m - self.block + 1, np.int64)
        for end in range(self.block - 1, m):
            np.minimum.at(self.shift, self._at(patterns[:, end], patterns[:, end - 1] if self.block == 2 else None), m - 1 - end)
        last = self._at(patterns[:, -1], patterns[:, -2] if self.block == 2 else None)
        self.order = np.argsort(last, kind="stable")
        self.start = np.searchsorted(last[self.order], np.arange((1 << TABLE_BITS) + 1))
        self.prefix = self._at(patterns[:, self.block - 1], patterns[:, 0] if self.block == 2 else None)

    def _at(self, word: np.ndarray, before: np.ndarray | None) -> np.ndarray:
        return _hash2(np.zeros_like(word) if before is None else before, word)

    def _block(self, ids: np.ndarray, pos: np.ndarray) -> np.ndarray:
        return self._at(ids[pos], ids[pos - 1] if self.block == 2 else None)

    def find(self, ids: np.ndarray, text_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(end, pattern)`` of every occurrence; ``text_of`` has the first
        word of each text and the number of words."""
        counts = np.maximum(np.diff(text_of) - (self.m - 1), 0)
        pieces = -(-counts // STRETCH)
        piece = ranges(np.zeros(len(pieces), np.int64), pieces)
        pos = np.repeat(text_of[:-1] + self.m - 1, pieces) + piece * STRETCH
        stop = np.minimum(pos + STRETCH, np.repeat(text_of[1:], pieces))
        cand = []
        while len(pos):
            step = self.shift[self._block(ids, pos)]
            hit = step == 0
            if hit.any():
                cand.append(pos[hit])
            pos = pos + np.maximum(step, 1)
            live = pos < stop
            pos, stop = pos[live], stop[live]
        ends, pats = [], []
        for at in (c[i:i + 4096] for c in cand for i in range(0, len(c), 4096)):
            b = self._block(ids, at)
            many = self.start[b + 1] - self.start[b]
            end, pat = np.repeat(at, many), self.order[ranges(self.start[b], many)]
            first = end - (self.m - 1)
            same = self._block(ids, first + self.block - 1) == self.prefix[pat]
            end, pat, first = end[same], pat[same], first[same]
            same = (ids[first[:, None] + np.arange(self.m)] == self.patterns[pat]).all(axis=1)
            ends.append(end[same])
            pats.append(pat[same])
        if not ends:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(ends), np.concatenate(pats)


@dataclass
class Block:
    """One block of the benchmark: vocabulary, matchers, and each pattern's items."""

    hashes: np.ndarray
    spell: list[bytes]
    matchers: list[Matcher]
    owners: list[list[list[str]]]


def split_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes and the word spans of each text."""
    low = _LOWER[data]
    return (low, *word_spans(low, offsets, _WORD))


def build(items: list[tuple[str, str | None]], window: int = WINDOW) -> Block:
    """Matchers for ``(item id, text)`` pairs, one per pattern length."""
    col = pa.array([t for _, t in items], pa.large_string())
    vocab: dict[bytes, int] = {}
    windows: dict[int, dict[tuple[int, ...], set[str]]] = {}
    for a, b, data, off in byte_slices(col):
        low, s, e, first = split_words(data, off)
        raw = low.tobytes()
        ids = [vocab.setdefault(raw[x:y], len(vocab) + 1) for x, y in zip(s.tolist(), e.tolist())]
        for i in range(a, b):
            ws = ids[first[i - a]:first[i - a + 1]]
            m = min(window, len(ws))
            for k in range(len(ws) - m + 1 if m else 0):
                windows.setdefault(m, {}).setdefault(tuple(ws[k:k + m]), set()).add(items[i][0])
    spell = list(vocab)
    joined = np.frombuffer(b"".join(spell), np.uint8)
    edge = np.concatenate([[0], np.cumsum([len(w) for w in spell])]).astype(np.int64)
    hashes = word_hashes(joined, edge[:-1], edge[1:])
    order = np.argsort(hashes)
    renumber = np.zeros(len(spell) + 1, np.int64)
    renumber[order + 1] = np.arange(1, len(spell) + 1)
    lengths = sorted(windows)
    return Block(hashes[order], [spell[i] for i in order.tolist()],
                 [Matcher(renumber[np.array(list(windows[m]), np.int64).reshape(-1, m)]) for m in lengths],
                 [[sorted(o) for o in windows[m].values()] for m in lengths])


def search(block: Block, data: np.ndarray, off: np.ndarray):
    """For the texts of one slice: words per text, ``(text, start, end)`` of the
    maximal hit runs (in words of that text) and ``(text, item)`` pairs."""
    low, s, e, first = split_words(data, off)
    n_words = np.diff(first)
    cover = np.zeros(len(s) + 1, np.int64)
    found: set[tuple[int, str]] = set()
    if len(s) and len(block.hashes):
        h = word_hashes(low, s, e)
        at = np.minimum(np.searchsorted(block.hashes, h), len(block.hashes) - 1)
        ids = np.where(block.hashes[at] == h, at + 1, 0)
        raw, spelled = None, {}
        for matcher, owners in zip(block.matchers, block.owners):
            end, pat = matcher.find(ids, first)
            if len(end) == 0:
                continue
            if raw is None:
                raw = low.tobytes()
            begin = end - (matcher.m - 1)
            right = np.ones(len(end), bool)
            used = np.unique(begin[:, None] + np.arange(matcher.m))
            for w in used.tolist():
                if w not in spelled:
                    spelled[w] = raw[s[w]:e[w]] == block.spell[ids[w] - 1]
            if not all(spelled[w] for w in used.tolist()):
                right = np.array([all(spelled[w] for w in range(x, y + 1)) for x, y in zip(begin.tolist(), end.tolist())])
            end, pat, begin = end[right], pat[right], begin[right]
            np.add.at(cover, begin, 1)
            np.add.at(cover, end + 1, -1)
            doc = np.searchsorted(first, begin, "right") - 1
            for d, p in np.unique(np.stack([doc, pat], axis=1), axis=0).tolist():
                found.update((d, i) for i in owners[p])
    hit = np.cumsum(cover)[:-1] > 0
    edges = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    # a run of hits may go over the end of a text: cut it there
    cut = first[1:-1]
    cut = cut[(cut > 0) & (cut < len(hit))]
    cut = np.unique(cut[hit[cut] & hit[cut - 1]]) if len(cut) else cut
    starts, ends = np.sort(np.concatenate([starts, cut])), np.sort(np.concatenate([ends, cut]))
    doc = np.searchsorted(first, starts, "right") - 1
    return n_words, doc, starts - first[doc], ends - first[doc], found


def item_blocks(items: DataFrame, block_bytes: int = BLOCK_BYTES):
    """The benchmark as lists of ``(id, text)``, each of about ``block_bytes``."""
    rows = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("i"),
                        F.col("text").cast("string").alias("t"))
    total = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = -(-total // block_bytes) or 1
    for k in range(n):
        part = rows if n == 1 else rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k)
        yield [(r.i, r.t) for r in part.collect()]


def _scan(docs: DataFrame, block: Block, n_words: str, spans: str, items: str, first_pass: bool) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(block)
    extra = {n_words: "long", spans: "array<struct<start:long,end:long>>", items: "array<string>"}
    schema = arrow_schema(docs, extra) if first_pass else docs.schema
    text_at = docs.columns.index("text")

    def run(batches):
        for b in batches:
            for x, y, data, off in byte_slices(b.column(text_at)):
                part = b.slice(x, y - x)
                count, doc, s, e, found = search(sent.value, data, off)
                sp: list[list[dict]] = [[] for _ in range(y - x)]
                it: list[set[str]] = [set() for _ in range(y - x)]
                for d, p, q in zip(doc.tolist(), s.tolist(), e.tolist()):
                    sp[d].append({"start": p, "end": q})
                for d, i in found:
                    it[d].add(i)
                cols = list(part.columns)
                if not first_pass:
                    old_sp, old_it = cols[-2].to_pylist(), cols[-1].to_pylist()
                    sp = [merged(a + c) for a, c in zip(old_sp, sp)]
                    it = [a | set(c) for a, c in zip(it, old_it)]
                    cols = cols[:-3]
                cols += [pa.array(count, pa.int64()),
                         pa.array(sp, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                         pa.array([sorted(i) for i in it], pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(cols, schema.names)

    return docs.mapInArrow(run, schema)


def merged(spans: list[dict]) -> list[dict]:
    """Spans as maximal runs."""
    out: list[dict] = []
    for s in sorted(spans, key=lambda s: s["start"]):
        if out and s["start"] <= out[-1]["end"]:
            out[-1] = {"start": out[-1]["start"], "end": max(out[-1]["end"], s["end"])}
        else:
            out.append(s)
    return out


def find_items(docs: DataFrame, items: DataFrame, window: int = WINDOW,
               names: tuple[str, str, str] = ("n_words", "hits", "items"),
               block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` plus the word count, the hit word runs (end exclusive) and the
    sorted ids of the items with occurring windows."""
    out, first = docs, True
    for rows in item_blocks(items, block_bytes):
        if not first:
            out = written(out, "decontaminate")
        out = _scan(out, build(rows, window), *names, first)
        first = False
    return out


def remove_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without any hit, with the columns of ``docs``."""
    names = tuple(free_name(docs, n) for n in ("hit_words", "hit_runs", "hit_items"))
    return find_items(docs, items, window, names).where(F.size(quoted(names[1])) == 0) \
        .select(*[quoted(c) for c in docs.columns])
