"""Personal data: patterns, and a skip-chain conditional random field.

Patterns find e-mail addresses, IPv4 addresses, card and phone numbers.  The
field then carries their labels to other mentions in the same document: words
are its nodes, neighbours are linked in a chain, and distant words that repeat
or resemble each other (same last seven digits, or the local part of an
address) are linked by skip edges, which favour equal labels, to one node that
they share.  That node carries the label that the patterns gave any of them,
and its words then start from a fixed prior: neither the corpus' size nor the
number of mentions weakens the label.  Loopy message passing over all words of
many documents at once, until the messages settle, gives each word's label
probabilities; a word that is more likely some kind than not becomes a span.

The potentials are trained piecewise from all documents: counts of (word shape,
label) and of neighbouring labels, where the patterns give the labels.  Spark
counts every shape as a whole string, so no two shapes share counts; the model
holds the shapes that the patterns label anywhere, and one common row for all
shapes that they never label.

Defined cases: null or empty text has no spans; repeated rows are searched
alike; an empty table gives an empty result; offsets count code points, the end
is exclusive; patterns run in linear time on any text; further columns are
ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import byte_slices

# The kinds in their order, and their patterns.
KINDS = ("email", "ip", "card", "phone")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

LABELS = len(KINDS) + 1  # 0: none
SKIP_WEIGHT = 6.0
SHARED = 0.25
PRIOR = np.array([0.96] + [0.01] * (LABELS - 1))
SETTLED = 1e-6  # largest change of any message in the last round
ROUNDS = 1000   # only ever reached by messages that swing for good
KEY_DIGITS = 7
KEY_LETTERS = 5

_WORD = re.compile(r"\S+")
_DIGITS = re.compile(r"[^0-9]+")
_RUN = re.compile(r"[0-9]+|(?P<letters>[^\W\d_]+)|.")
_EDGE = "\"'()[]{}<>,.;:!?|#*$%&"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the pattern matches, sorted."""
    out = []
    done, at = 0, text.find("@")
    while at >= 0:
        a = at
        while a > done and text[a - 1] in LOCAL:
            a -= 1
        m = DOMAIN.match(text, at + 1) if a < at else None
        if m:
            out.append((a, 0, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        if 12 <= len(m[0]) <= 40:
            d = _DIGITS.sub("", m[0])
            if 12 <= len(d) <= 19 and luhn(d):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(_DIGITS.sub("", m[0])) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def shape(word: str) -> str:
    """A word's shape: runs of digits with their length, runs of letters, other
    characters as they are, and whether a number of a card's length or four
    dotted numbers are invalid; words without digit or ``@`` have shape ""."""
    out = []
    digits = _DIGITS.sub("", word)
    if 12 <= len(digits) <= 19 and not luhn(digits):
        out.append("no card ")
    if IP.fullmatch(word) and not all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in word.split(".")):
        out.append("no ip ")
    for m in _RUN.finditer(word):
        t = m[0]
        out.append(f"9{len(t)}" if "0" <= t[0] <= "9" else "a" if m.lastgroup else t)
    return "".join(out)


@dataclass
class Graph:
    """Words of several documents: spans, labels by pattern, shapes, chain edges
    between words, skip edges ``(word, key)``, and how often the patterns gave
    each label to a key."""

    doc: np.ndarray
    start: list[int]
    end: list[int]
    label: np.ndarray
    shape: list[str]
    chain: np.ndarray
    skip: np.ndarray
    keys: np.ndarray


def graph(texts: list[tuple[str, list[tuple[int, int, int]]]]) -> Graph:
    doc, start, end, label, cell, chain, skip, keys = [], [], [], [], [], [], [], []
    for d, (text, base) in enumerate(texts):
        spans, first = list(base), len(start)
        locals_ = {text[a:e].split("@")[0].lower() for a, k, e in base if k == 0}
        locals_ = {x for x in locals_ if len(x) >= KEY_LETTERS}
        said: dict[str, list[int]] = {}
        reach: list[tuple[int, int, int]] = []
        j = 0
        for m in _WORD.finditer(text):
            a, e, w, i = m.start(), m.end(), m[0], len(start)
            while j < len(spans) and spans[j][0] < e:
                reach.append(spans[j])
                j += 1
            reach = [s for s in reach if s[2] > a]
            doc.append(d)
            start.append(a)
            end.append(e)
            label.append(reach[0][1] + 1 if reach else 0)
            plain = not any(c in "@0123456789" for c in w)
            cell.append("" if plain else shape(w.strip(_EDGE)))
            if i > first:
                chain.append((i - 1, i))
            key = None
            if not plain:
                digits = _DIGITS.sub("", w)
                if "@" in w:
                    key = w.strip(_EDGE).split("@")[0].lower()
                    key = key if key in locals_ else None
                elif len(digits) >= KEY_DIGITS:
                    key = digits[-KEY_DIGITS:]
            if key is None and locals_:
                bare = w.strip(_EDGE).lower()
                key = bare if bare in locals_ else None
            if key is not None:
                said.setdefault(key, []).append(i)
        for key, at in said.items():
            given = [0] * LABELS
            for i in at:
                given[label[i]] += 1
            given[0] = 0
            given[1] += key in locals_
            if len(at) > 1 or any(given):
                skip += [(i, len(keys)) for i in at]
                keys.append(given)
    edges = lambda e: np.array(e, np.int64).reshape(-1, 2)
    return Graph(np.array(doc, np.int64), start, end, np.array(label, np.int64), cell, edges(chain), edges(skip),
                 np.array(keys, np.int64).reshape(-1, LABELS))


@dataclass(frozen=True)
class Field:
    """Potentials: the row of each shape that the patterns label anywhere (row 0
    is all others'), per row and label, and per pair of chain labels."""

    rows: dict[str, int]
    unary: np.ndarray
    pair: np.ndarray


def beliefs(g: Graph, f: Field, rounds: int = ROUNDS, skip_weight: float = SKIP_WEIGHT) -> np.ndarray:
    """Label probabilities of every word, by loopy message passing (all
    messages at once).  A word inside a pattern match keeps that label."""
    n = len(g.label) + len(g.keys)
    own = np.full((n, LABELS), 1.0 / LABELS)
    own[:len(g.label)] = f.unary[[f.rows.get(x, 0) for x in g.shape]]
    # linked words share their potentials: what a word's own shape says counts
    # less, and nothing at all once the patterns have labelled its key
    known = g.keys.sum(axis=1) > 0
    own[g.skip[:, 0]] = np.where(known[g.skip[:, 1], None], PRIOR, own[g.skip[:, 0]]) ** SHARED
    own[len(g.label):][known] = np.maximum(g.keys[known] / g.keys[known].sum(axis=1, keepdims=True), 1e-9)
    fixed = np.flatnonzero(g.label > 0)
    own[fixed] = 1e-9
    own[fixed, g.label[fixed]] = 1.0
    key = g.skip[:, 1] + len(g.label)
    a = np.concatenate([g.chain[:, 0], g.chain[:, 1], g.skip[:, 0], key])
    b = np.concatenate([g.chain[:, 1], g.chain[:, 0], key, g.skip[:, 0]])
    c, s = len(g.chain), len(g.skip)
    back = np.concatenate([np.arange(c, 2 * c), np.arange(c), np.arange(2 * c + s, 2 * c + 2 * s), np.arange(2 * c, 2 * c + s)])
    same = np.ones((LABELS, LABELS)) + np.eye(LABELS) * (np.exp(skip_weight) - 1)
    msg = np.full((len(a), LABELS), 1.0 / LABELS)
    order = np.argsort(b, kind="stable")
    bounds = np.searchsorted(b[order], np.arange(n + 1))
    busy = bounds[1:] > bounds[:-1]

    def product() -> np.ndarray:
        total = np.zeros((n, LABELS))
        if len(a):
            total[busy] = np.add.reduceat(np.log(msg[order]), bounds[:-1][busy], axis=0)
        total += np.log(own)
        return total

    for k in range(rounds if len(a) else 0):
        out = product()[a] - np.log(msg[back])
        out = np.exp(out - out.max(axis=1, keepdims=True))
        new = np.empty_like(msg)
        new[:c] = out[:c] @ f.pair
        new[c:2 * c] = out[c:2 * c] @ f.pair.T
        new[2 * c:] = out[2 * c:] @ same
        new = np.maximum(new / new.sum(axis=1, keepdims=True), 1e-12)
        if k >= 50:  # calms messages that swing
            new = (new + msg) / 2
        moved = np.abs(new - msg).max()
        msg = new
        if moved < SETTLED:
            break
    p = product()[:len(g.label)]
    p = np.exp(p - p.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def _evident(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Texts with a digit or an ``@``: all others have no span of any kind."""
    mark = np.concatenate([[0], np.cumsum(((data >= 48) & (data <= 57)) | (data == 64))])
    return np.flatnonzero(mark[off[1:]] > mark[off[:-1]])


def _texts(col: pa.Array):
    """Slices of a text column: ``(first row, rows, [(row, text, base spans)])``."""
    for x, y, data, off in byte_slices(col):
        raw = data.tobytes()
        found = []
        for i in _evident(data, off).tolist():
            t = raw[off[i]:off[i + 1]].decode("utf-8", "surrogatepass")
            found.append((i, t, base_spans(t)))
        yield x, y - x, found


def train(docs: DataFrame) -> Field:
    """Piecewise training: label counts per shape and per neighbouring pair,
    summed over all documents that have evidence."""

    def run(batches):
        for b in batches:
            for _, _, found in _texts(b.column(0)):
                g = graph([(t, s) for _, t, s in found])
                both = Counter(zip(g.shape, g.label.tolist()))
                pairs = zip(g.label[g.chain[:, 0]].tolist(), g.label[g.chain[:, 1]].tolist())
                for (x, y), n in Counter(pairs).items():
                    both[f" {x}", y] = n  # no shape starts with a space
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k.encode("utf-8", "surrogatepass") for k, _ in both], pa.binary()),
                     pa.array([y for _, y in both], pa.int32()), pa.array(list(both.values()), pa.int64())], ["shape", "label", "n"])

    counts = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "shape binary, label int, n long")
    names = [f"n{y}" for y in range(LABELS)]
    each = counts.groupBy("shape").agg(*[F.sum(F.when(F.col("label") == y, F.col("n")).otherwise(0)).alias(c) for y, c in enumerate(names)])
    labelled = sum((F.col(c) for c in names[1:]), F.lit(0)) > 0
    each = each.withColumn("shape", F.when(labelled | F.col("shape").startswith(F.lit(b" ")), F.col("shape")))
    rows: dict[str, int] = {}
    cells, pairs = [np.zeros(LABELS)], np.zeros((LABELS, LABELS))
    for r in each.groupBy("shape").agg(*[F.sum(c).alias(c) for c in names]).collect():  # labelled shapes only
        n = [r[c] for c in names]
        key = None if r["shape"] is None else bytes(r["shape"]).decode("utf-8", "surrogatepass")
        if key is None:
            cells[0] += n
        elif key.startswith(" "):
            pairs[int(key)] += n
        else:
            rows[key] = len(cells)
            cells.append(np.array(n, float))
    table = np.array(cells)
    pairs += 0.1
    unary = (table + PRIOR) / (table.sum(axis=1, keepdims=True) + 1)
    joint = pairs / pairs.sum()
    pair = joint / np.outer(joint.sum(axis=1), joint.sum(axis=0))
    return Field(rows, unary, np.clip(pair, 0.05, 20.0))


def find_spans(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """``doc_id, spans``: sorted ``(kind, start, end, base)``; ``base`` tells the
    patterns' spans from those that the field added."""
    model = docs.sparkSession.sparkContext.broadcast(field or train(docs))
    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])

    def added(found) -> dict[int, list[tuple[int, int, int]]]:
        out: dict[int, list[tuple[int, int, int]]] = {}
        if not found:
            return out
        g = graph([(t, s) for _, t, s in found])
        p = beliefs(g, model.value)
        best = p.argmax(axis=1)
        for w in np.flatnonzero((best > 0) & (g.label == 0)).tolist():
            i, t, _ = found[int(g.doc[w])]
            word = t[g.start[w]:g.end[w]]
            a = g.start[w] + len(word) - len(word.lstrip(_EDGE))
            e = a + len(word.strip(_EDGE))
            if e > a:
                out.setdefault(i, []).append((a, int(best[w]) - 1, e))
        return out

    def run(batches):
        for b in batches:
            for x, n, found in _texts(b.column(1)):
                more = added(found)
                spans: list[list[dict]] = [[] for _ in range(n)]
                for i, _, base in found:
                    every = [(*s, True) for s in base] + [(*s, False) for s in more.get(i, [])]
                    spans[i] = [{"kind": KINDS[k], "start": a, "end": e, "base": own}
                                for a, k, e, own in sorted(every, key=lambda s: s[:2])]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(x, n), pa.array(spans, pa.list_(kind))], ["doc_id", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, "doc_id long, spans array<struct<kind:string,start:long,end:long,base:boolean>>")
