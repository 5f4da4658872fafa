"""Token-id files by an adaptive context-mixing range coder.

Ids are coded in blocks; each block starts from an empty model and carries
checksums, so any block is read without the others.  Inside a block an id is
one of three cases: what the order-2 context (the two ids before) predicts,
what the order-1 context predicts, or a literal.  Three adaptive estimates of
the case -- by the order-2 prediction's confidence, by the order-1
prediction's, and by the last case -- are mixed with weights that follow how
well each has done; the mixture drives the range coder.  Literals are coded by
the order-0 model: an adaptive distribution over groups of 256 ids, then the id
within its group.

The coder is a carry-less range coder with 64-bit registers and 16-bit output.
Blocks do not depend on each other, so a task codes many at once: lane i of
every NumPy array belongs to block i, and one step codes one id of every block.

Files: a Parquet table of blocks in document order, one row per block with its
place, the documents' pieces in it, and the coded bytes (header: magic,
version, id count, checksum of ids, checksum of code).

Defined cases: null text has no ids but the end id; rows that share an id are
ordered by their text's hash and kept apart; null ids come first; an empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import re
import struct
import zlib
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import byte_slices, ranges, scratch, written

END_ID = 1
BLOCK_IDS = 2048
LANES = 4096
TOKENIZER = "word_bpe_49k.json"

MAGIC = b"ACMR"
VERSION = 2
HEADER = struct.Struct("<4sBIII")

_SLOTS = 1024
_GROUPS = 256
_NEAR = 64
_ROW = _GROUPS + 16
_EACH = np.arange(1, _GROUPS + 1, dtype=np.int32)[:, None]
_ONE = 4096            # scale of the case estimates
_ROOM = 4170           # a little above it: every case keeps a frequency
_FIELD = (1 << 27) - 1 | ((1 << 27) - 1) << 32
_GAIN = np.array([1 << 39, 1 << 7, 0])  # what a case adds to an estimate
_TOP, _LOW32 = np.uint64(1 << 48), np.uint64((1 << 32) - 1)
_U4, _U16, _U32, _U48 = np.uint64(4), np.uint64(16), np.uint64(32), np.uint64(48)


def _pick(first: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``np.where`` of integers by bits: it does not slow down on masks that no
    processor can foretell, and the cases of ids are such masks."""
    mask = first.view(np.int8).astype(a.dtype)
    np.negative(mask, out=mask)
    x = a ^ b
    x &= mask
    x ^= b
    return x


def _at_or_below(rows: np.ndarray, want: np.ndarray) -> np.ndarray:
    """How many of each row's 16 numbers are at or below the wanted one."""
    ones = (rows <= want[:, None]).view(np.uint64)
    n = ones[:, 0] + ones[:, 1]
    n *= np.uint64(0x0101010101010101)  # adds the bytes up
    n >>= np.uint64(56)
    return n.view(np.int64)


class Model:
    """Adaptive state of many blocks (lanes), advanced together.

    ``ids`` holds the blocks' ids by step and lane, as far as they are known.  A
    prediction slot holds ``id << 2 | confidence``; a case estimate holds the
    shares of case 0 and case 1 as ``a << 32 | b``, so that one multiplication
    weighs both.  Rows of an array: order 1 and order 2; estimates by the last
    case, by order 1 and by order 2; cases 0 and 1."""

    def __init__(self, ids: np.ndarray):
        lanes, self.ids = ids.shape[1], ids
        lane = np.arange(lanes, dtype=np.int64)
        self.base = (lane * (2 * _SLOTS) + [[0], [_SLOTS]]).astype(np.int32)
        self.lane15, self.lane_cdf = lane * 15 + [[0], [3], [7]], lane * _ROW
        self.pred = np.zeros(lanes * 2 * _SLOTS, np.int32)
        third = (_ONE // 3) << 32 | (_ONE // 3)
        self.by = np.full(lanes * 15, third, np.int64)
        self.w = np.full((3, lanes), 4 * _ONE, np.int64)
        self.scale = (65533.0 / _ROOM) / self.w.sum(axis=0)
        self.case = np.full(lanes, 2, np.int64)
        self.prev = np.zeros(lanes, np.int32)
        self.before = np.zeros(lanes, np.int32)
        self.count = np.zeros((-(-lanes // _NEAR), _GROUPS, _NEAR), np.int64)
        self.cdf = np.full(lanes * _ROW, 65536, np.int32)  # a lane's borders in rows of 16, the last ones beyond its groups
        self.cdf[::_ROW] = 0
        self.coarse = np.zeros((lanes, 16), np.int32)  # the first border of each row
        self.steps = self.refresh = self.counted = 0

    def learn_groups(self, n: int) -> None:
        """Order-0 distribution of the first ``n`` lanes from the ids so far."""
        for x in range(0, n, _NEAR):  # few lanes at once stay in the processor's cache
            y = min(x + _NEAR, n)
            at = (self.ids[self.counted:self.steps, x:y] >> 8) * _NEAR + np.arange(y - x)
            count = self.count[x // _NEAR]
            count += np.bincount(at.ravel(), minlength=_GROUPS * _NEAR).reshape(count.shape)
            c = np.cumsum(count[:, :y - x], axis=0)
            c *= 24
            c += _EACH
            cdf = self.cdf[x * _ROW:y * _ROW].reshape(y - x, _ROW)
            part = (c * ((65536 - _GROUPS) / c[-1])).astype(np.int32)
            part += _EACH
            cdf[:, 1:_GROUPS] = part[:-1].T
            self.coarse[x:y] = cdf[:, :_GROUPS:16]
        self.counted = self.steps

    def predict(self, n: int) -> np.ndarray:
        """Sets the predictions of the first ``n`` lanes and returns the mixed
        frequencies of cases 0 and 1 (all three sum to 65536)."""
        if self.steps == self.refresh:
            self.learn_groups(n)
            self.refresh += 32 + (self.steps >> 2)  # the more is known, the later
        h = np.empty((2, n), np.int32)
        np.multiply(self.prev[:n], 40503, out=h[0])
        np.multiply(self.before[:n], 30011, out=h[1])
        h[1] >>= 3
        h[1] ^= h[0]
        h &= _SLOTS - 1
        h += self.base[:, :n]
        self.at = h.astype(np.int64)
        self.old = self.pred.take(self.at)
        self.id, self.conf = self.old >> 2, self.old & 3
        r = np.empty((3, n), np.int64)
        r[0] = self.case[:n]
        r[1:] = self.conf
        r[2] <<= 1
        r[2] += self.id[0] == self.id[1]
        r += self.lane15[:, :n]
        self.r, self.g = r, self.by.take(r)
        mixed = (self.w[:, :n] * self.g).sum(axis=0)
        both = np.empty((2, n), np.int64)
        np.right_shift(mixed, 32, out=both[0])
        np.bitwise_and(mixed, 0xFFFFFFFF, out=both[1])
        f = (both * self.scale[:n]).astype(np.int64)
        f += 1
        return f

    def update(self, n: int, ids: np.ndarray, case: np.ndarray, missed: np.ndarray) -> None:
        """Learn the ids just coded (``missed``: by order 1, by order 2, whether
        or not their predictions were used)."""
        g = self.g
        if self.steps % 8 == 0:
            w = self.w[:, :n]
            a, b = g >> 32, g & 0xFFFFFFFF
            w -= w >> 3
            w += _pick(case == 2, _ROOM - a - b, _pick(case == 1, b, a))
            self.scale[:n] = (65533.0 / _ROOM) / w.sum(axis=0)
        less = g >> 5
        less &= _FIELD
        g -= less
        g += _GAIN.take(case)
        self.by[self.r] = g
        self.case[:n] = case
        fresh = ids << 2
        fresh += 1
        old = self.old
        right = old | 3
        wrong = _pick(self.conf == 0, fresh, old - 1)
        old += 1
        self.pred[self.at] = _pick(missed, wrong, np.minimum(old, right, out=right))
        self.before[:n] = self.prev[:n]
        self.prev[:n] = ids
        self.steps += 1


def _due(low: np.ndarray, span: np.ndarray) -> np.ndarray:
    """Which lanes give out their top 16 bits; a lane whose range got too small
    is cut at the next 32-bit border first."""
    high = low + span
    high ^= low
    ready, small = high < _TOP, span <= _LOW32
    cut = (small > ready).nonzero()[0]
    if len(cut):
        span[cut] = (~low[cut] + np.uint64(1)) & _LOW32
        ready |= small
    return ready


class Encoder:
    def __init__(self, lanes: int, longest: int):
        self.low = np.zeros(lanes, np.uint64)
        self.span = np.full(lanes, np.uint64(2**64 - 1), np.uint64)
        self.width = 3 * longest + 16
        self.out = np.zeros(lanes * self.width, np.uint16)
        self.n = np.arange(lanes, dtype=np.int64) * self.width

    def put(self, n: int, cum: np.ndarray, freq: np.ndarray) -> None:
        """Code one of 2**32 parts in each of the first ``n`` lanes."""
        low, span, at = self.low[:n], self.span[:n], self.n[:n]
        r = span >> _U32
        np.multiply(r, freq.view(np.uint64), out=span)
        r *= cum.view(np.uint64)
        low += r
        step = _due(low, span).view(np.uint8).astype(np.int64)
        self.out[at] = (low >> _U48).astype(np.uint16)  # lanes that are not due write it again later
        at += step
        step <<= 4
        low <<= step.view(np.uint64)
        span <<= step.view(np.uint64)
        i = _due(low, span).nonzero()[0]
        while len(i):
            x, y, to = low[i], span[i], at[i]
            self.out[to] = x >> _U48
            at[i] = to + 1
            x <<= _U16
            y <<= _U16
            due = _due(x, y)
            low[i], span[i] = x, y
            i = i[due]

    def finish(self) -> list[bytes]:
        for shift in (48, 32, 16, 0):
            self.out[self.n] = (self.low >> np.uint64(shift)) & np.uint64(0xFFFF)
            self.n += 1
        return [self.out[i * self.width:k].astype("<u2").tobytes() for i, k in enumerate(self.n.tolist())]


class Decoder:
    def __init__(self, codes: list[bytes]):
        lanes, width = len(codes), max(len(c) for c in codes) // 2 + 8
        self.code = np.zeros(lanes * width, np.uint16)
        for i, c in enumerate(codes):
            self.code[i * width:i * width + len(c) // 2] = np.frombuffer(c, "<u2")
        self.low = np.zeros(lanes, np.uint64)
        self.span = np.full(lanes, np.uint64(2**64 - 1), np.uint64)
        self.now = np.zeros(lanes, np.uint64)
        self.n = np.arange(lanes, dtype=np.int64) * width
        for _ in range(4):
            self.now = (self.now << _U16) | self.code[self.n]
            self.n += 1

    def peek(self, n: int) -> np.ndarray:
        """The part of 2**32 that the code points at in each lane."""
        self.r = self.span[:n] >> _U32
        v = self.now[:n] - self.low[:n]
        v //= self.r
        return np.minimum(v, _LOW32, out=v).view(np.int64)

    def take(self, n: int, cum: np.ndarray, freq: np.ndarray) -> None:
        low, span, now, at = self.low[:n], self.span[:n], self.now[:n], self.n[:n]
        np.multiply(self.r, freq.view(np.uint64), out=span)
        self.r *= cum.view(np.uint64)
        low += self.r
        step = _due(low, span).view(np.uint8).astype(np.int64)
        read = self.code.take(at).astype(np.uint64)
        read *= step.view(np.uint64)
        at += step
        step <<= 4
        now <<= step.view(np.uint64)
        now |= read
        low <<= step.view(np.uint64)
        span <<= step.view(np.uint64)
        i = _due(low, span).nonzero()[0]
        while len(i):
            x, y, to = low[i], span[i], at[i]
            now[i] = (now[i] << _U16) | self.code[to]
            at[i] = to + 1
            x <<= _U16
            y <<= _U16
            due = _due(x, y)
            low[i], span[i] = x, y
            i = i[due]


def encode_blocks(blocks: list[np.ndarray]) -> list[bytes]:
    """Coded bytes (with header) of each block of ids below 65536."""
    order = sorted(range(len(blocks)), key=lambda i: -len(blocks[i]))
    sizes = np.array([len(blocks[i]) for i in order], np.int64)
    longest = int(sizes[0]) if len(sizes) else 0
    ids = np.zeros((longest, len(blocks)), np.uint16)
    for a in range(0, len(order), _NEAR):
        some = np.zeros((len(order[a:a + _NEAR]), longest), np.uint16)
        for row, i in zip(some, order[a:a + _NEAR]):
            row[:len(blocks[i])] = blocks[i]
        ids[:, a:a + _NEAR] = some.T
    model, enc = Model(ids), Encoder(len(blocks), longest)
    live = np.searchsorted(-sizes, -np.arange(longest), "left")  # lanes longer than each step
    with np.errstate(over="ignore"):
        for t in range(longest):
            n = int(live[t])
            x = ids[t, :n].astype(np.int32)
            f = model.predict(n)
            missed = model.id != x
            literal = missed[0] & missed[1]
            case = (literal.view(np.int8) + missed[1].view(np.int8)).astype(np.int64)
            lit = literal.nonzero()[0]
            cum, freq = f[0] * case, _pick(missed[1], f[1], f[0])
            cum <<= 16
            freq <<= 16
            if len(lit):
                y, f01 = x.take(lit), (f[0] + f[1]).take(lit)
                at = model.lane_cdf.take(lit) + (y >> 8)
                a = model.cdf.take(at).astype(np.int64)
                at += 1
                room = 65536 - f01
                each = room * (model.cdf.take(at) - a)
                each >>= 8
                f01 <<= 16
                a *= room
                a += f01
                a += (y & 255) * each
                cum[lit], freq[lit] = a, each
            enc.put(n, cum, freq)
            model.update(n, x, case, missed)
        codes = enc.finish()
    out: list[bytes] = [b""] * len(blocks)
    for lane, i in enumerate(order):
        raw = np.asarray(blocks[i]).astype("<u4").tobytes()
        out[i] = HEADER.pack(MAGIC, VERSION, len(blocks[i]), zlib.crc32(raw), zlib.crc32(codes[lane])) + codes[lane]
    return out


def decode_blocks(data: list[bytes]) -> list[np.ndarray]:
    """The ids of each block; a damaged block raises ``ValueError``."""
    if not data:
        return []
    heads = []
    for d in data:
        if len(d) < HEADER.size:
            raise ValueError("a block is cut off")
        magic, version, n, ids_crc, code_crc = HEADER.unpack_from(d)
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a block of this format")
        if zlib.crc32(d[HEADER.size:]) != code_crc:
            raise ValueError("a block's code is damaged")
        heads.append((n, ids_crc))
    order = sorted(range(len(data)), key=lambda i: -heads[i][0])
    sizes = np.array([heads[i][0] for i in order], np.int64)
    longest = int(sizes[0])
    ids = np.zeros((longest, len(data)), np.uint16)
    model, dec = Model(ids), Decoder([data[i][HEADER.size:] for i in order])
    live = np.searchsorted(-sizes, -np.arange(longest), "left")
    with np.errstate(over="ignore"):
        for t in range(longest):
            n = int(live[t])
            f = model.predict(n)
            v = dec.peek(n)
            part, f01 = v >> 16, f[0] + f[1]
            not0, literal = part >= f[0], part >= f01
            case = (literal.view(np.int8) + not0.view(np.int8)).astype(np.int64)
            lit = literal.nonzero()[0]
            cum, freq = f[0] * case, _pick(not0, f[1], f[0])
            cum <<= 16
            freq <<= 16
            x = _pick(not0, model.id[0], model.id[1])
            if len(lit):
                f01 = f01.take(lit)
                room = 65536 - f01
                f01 <<= 16
                rest = v.take(lit)
                rest -= f01
                at = model.lane_cdf.take(lit)
                want = (rest.view(np.uint64) // room.view(np.uint64)).astype(np.int32)
                row = _at_or_below(model.coarse.take(lit, axis=0), want)  # last group that starts at or below
                row -= 1
                g = at >> 4
                g += row
                g = _at_or_below(model.cdf.reshape(-1, 16).take(g, axis=0), want)
                row <<= 4
                row -= 1
                g += row
                g += at
                a = model.cdf.take(g).astype(np.int64)
                each = room * (model.cdf.take(g + 1) - a)
                each >>= 8
                a *= room
                rest -= a
                low = (rest.view(np.uint64) // each.view(np.uint64)).view(np.int64)
                np.minimum(low, 255, out=low)
                a += f01
                a += low * each
                cum[lit], freq[lit] = a, each
                g -= at
                g <<= 8
                g += low
                x[lit] = g
            dec.take(n, cum, freq)
            ids[t, :n] = x
            model.update(n, x, case, model.id != x)
    out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(data)
    for a in range(0, len(order), _NEAR):
        some = np.ascontiguousarray(ids[:, a:a + _NEAR].T)
        for row, i in zip(some, order[a:a + _NEAR]):
            n, crc = heads[i]
            out[i] = row[:n].astype(np.int32)
            if zlib.crc32(out[i].astype("<u4").tobytes()) != crc:
                raise ValueError("a block's ids are damaged")
    return out


# ---------------------------------------------------------------- tokenizing

_SPACES = b" \t\n\x0b\x0c\r"
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
# Kinds of bytes: 0 white space, 1 ASCII letter, 2 ASCII mark, 3 any other.
_KIND = bytes(0 if c in _SPACES else 1 if chr(c).isascii() and chr(c).isalpha() else
              2 if chr(c) in ",.!?;:#*$%&|()\"-" else 3 for c in range(256))
# Byte-level alphabet: printable Latin-1 stands for itself, the rest follows from U+0100 on.
_PLAIN = [c for c in range(256) if 33 <= c <= 126 or 161 <= c <= 172 or c >= 174]
_BYTE_CHARS = dict(zip(_PLAIN, _PLAIN)) | {c: 256 + k for k, c in enumerate(sorted(set(range(256)) - set(_PLAIN)))}

TOKENIZE_BYTES = 8 << 20
MEMO_WORDS = 1_000_000
_MEMO: dict[str, dict[bytes, bytes]] = {}
_LOADED: dict[str, object] = {}


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def _tokenizer(path: str):
    if path not in _LOADED:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        # token_ids has cut the added tokens out; lower-cased pieces that look like them are text
        t.encode_special_tokens = True
        _LOADED[path] = t
    return _LOADED[path]


def _one_word(piece: bytes) -> str | None:
    """The model's spelling of a piece made of Latin letters only (not all of
    them ASCII), which the normalizer merely lower-cases and the splitter leaves
    whole; else none."""
    word = piece.decode("utf-8", "replace")
    if not word.isalpha() or max(word) >= "\u0250":
        return None
    word = word.lower()
    return word.encode().decode("latin-1").translate(_BYTE_CHARS) if word.isalpha() else None


def tokenize(data: np.ndarray, off: np.ndarray, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts of a slice, one after the other, and their counts; the
    strings of added tokens count as ordinary text.

    This vocabulary drops white space, ignores ASCII case and never joins an
    ASCII letter with the ASCII punctuation after it, so a text is the sequence
    of such pieces; each distinct piece is encoded once and remembered."""
    raw = data.tobytes()
    kind = np.frombuffer(raw.translate(_KIND), np.uint8)
    n = len(kind)
    solid = kind > 0
    begin, last = solid.copy(), solid.copy()
    if n:
        np.greater(solid[1:], solid[:-1], out=begin[1:])
        begin[1:] |= (kind[:-1] == 1) & (kind[1:] == 2)
        edges = off[:-1][off[:-1] < n]
        begin[edges] = solid[edges]
        last[:-1] &= solid[1:] <= begin[1:]
    at = np.flatnonzero(begin)
    cuts = np.zeros(len(at) + 1, np.int64)
    np.cumsum(np.flatnonzero(last) + 1 - at, out=cuts[1:])
    body = raw.translate(_LOWER, _SPACES)
    pieces = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(cuts), pa.py_buffer(body)])
    coded = pieces.dictionary_encode()
    names = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
    memo = _MEMO.setdefault(path, {})
    if len(memo) > MEMO_WORDS:
        memo.clear()
    each = list(map(memo.get, names))
    new = [i for i, e in enumerate(each) if e is None]
    if new:
        t = _tokenizer(path)
        encode, rest = t.model.tokenize, []
        for i in new:
            w = names[i]
            word = w.decode() if w.isalpha() else _one_word(w)
            if word is None:
                rest.append(i)
            else:
                each[i] = memo[w] = array("H", [x.id for x in encode(word)]).tobytes()
        batch = getattr(t, "encode_batch_fast", t.encode_batch)
        for a in range(0, len(rest), 4096):
            part = rest[a:a + 4096]
            for i, e in zip(part, batch([names[i].decode("utf-8", "replace") for i in part], add_special_tokens=False)):
                each[i] = memo[names[i]] = array("H", e.ids).tobytes()
    joined = pa.array(each, pa.large_binary()).take(coded.indices)
    upto = np.frombuffer(joined.buffers()[1], np.int64, len(at) + 1, 8 * joined.offset) >> 1 if len(at) else cuts
    ids = np.frombuffer(joined.buffers()[2] or b"", np.uint16, int(upto[-1]))
    return ids, np.diff(upto[np.searchsorted(at, off, "left")])


@lru_cache(maxsize=8)
def _added(path: str) -> tuple[re.Pattern[bytes], dict[bytes, int]]:
    """The added tokens' strings, longest first, and their ids."""
    ids = {a.content.encode(): i for i, a in _tokenizer(path).get_added_tokens_decoder().items()}
    return re.compile(b"|".join(re.escape(x) for x in sorted(ids, key=len, reverse=True)) or rb"(?!)"), ids


def token_ids(data: np.ndarray, off: np.ndarray, path: str) -> tuple[np.ndarray, np.ndarray]:
    """As ``tokenize``, with the added tokens (``<|endoftext|>``) found in the
    texts as they stand, before any other cut, as the library does."""
    pattern, special = _added(path)
    found = [(m.start(), m.end(), special[m[0]]) for m in pattern.finditer(data.tobytes())]
    # texts lie side by side: a string that crosses from one into the next is none
    found = [f for f in found if off[np.searchsorted(off, f[0], "right")] >= f[1]]
    if not found:
        return tokenize(data, off, path)
    at, end, new = np.array(found, np.int64).T
    cuts = np.sort(np.concatenate([off, at, end]))
    ids, counts = tokenize(data, cuts, path)
    part = np.searchsorted(cuts, at, "right") - 1
    first = np.cumsum(counts) - counts
    keep = np.ones(len(ids), bool)
    keep[ranges(first[part], counts[part])] = False
    keep[first[part]] = True  # one place for each; its string has at least one id
    ids = ids.copy()
    ids[first[part]] = new
    counts[part] = 1
    upto = np.concatenate([[0], np.cumsum(counts)])
    return ids[keep], np.diff(upto[np.searchsorted(cuts, off, "left")])


# -------------------------------------------------------------------- files

BLOCK_SCHEMA = ("part int, block long, start long, doc_seq array<long>, doc_id array<long>, piece array<int>, "
                "pieces array<int>, n array<long>, data binary")


class _Packer:
    """Cuts a part's documents into blocks of at most ``BLOCK_IDS`` ids."""

    def __init__(self, part: int, block_ids: int):
        self.part, self.size = part, block_ids
        self.block = self.start = self.doc = 0
        self.rows: list[dict] = []
        self.fresh()

    def fresh(self) -> None:
        self.ids: list[np.ndarray] = []
        self.held = 0
        self.meta: list[tuple[int, int | None, int, int, int]] = []

    def close(self) -> None:
        if self.meta:
            self.rows.append({"part": self.part, "block": self.block, "start": self.start, "meta": self.meta,
                              "ids": np.concatenate(self.ids)})
            self.block += 1
            self.start += self.held
            self.fresh()

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        pieces = -(-len(ids) // self.size)
        for p in range(pieces):
            part = ids[p * self.size:(p + 1) * self.size]
            if self.held + len(part) > self.size:
                self.close()
            self.ids.append(part)
            self.held += len(part)
            self.meta.append((self.doc, doc_id, p, pieces, len(part)))
        self.doc += 1

    def batch(self, rows: list[dict]) -> pa.RecordBatch:
        codes = encode_blocks([r["ids"] for r in rows])
        col = lambda k, t: pa.array([[m[k] for m in r["meta"]] for r in rows], pa.list_(t))
        return pa.RecordBatch.from_arrays(
            [pa.array([r["part"] for r in rows], pa.int32()), pa.array([r["block"] for r in rows], pa.int64()),
             pa.array([r["start"] for r in rows], pa.int64()), col(0, pa.int64()), col(1, pa.int64()), col(2, pa.int32()),
             col(3, pa.int32()), col(4, pa.int64()), pa.array(codes, pa.binary())],
            ["part", "block", "start", "doc_seq", "doc_id", "piece", "pieces", "n", "data"])


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID,
                 block_ids: int = BLOCK_IDS, lanes: int = LANES) -> None:
    """Tokenize and write ``docs`` in ascending ``doc_id`` order."""
    tok = tokenizer or tokenizer_path()

    def run(batches):
        pack = _Packer(TaskContext.get().partitionId(), block_ids)
        end = np.array([end_id], np.uint16)
        for b in batches:
            for x, y, data, off in byte_slices(b.column(1), TOKENIZE_BYTES):
                ids, counts = token_ids(data, off, tok)
                at = 0
                for d, c in zip(b.column(0).slice(x, y - x).to_pylist(), counts.tolist()):
                    pack.add(d, np.concatenate([ids[at:at + c], end]))
                    at += c
                while len(pack.rows) >= lanes:
                    yield pack.batch(pack.rows[:lanes])
                    del pack.rows[:lanes]
        pack.close()
        for a in range(0, len(pack.rows), lanes):
            yield pack.batch(pack.rows[a:a + lanes])

    width = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    d = d.repartitionByRange(width, "doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    d.mapInArrow(run, BLOCK_SCHEMA).write.parquet(path)


def _times(m: tuple[int, ...], v: int) -> int:
    s = 0
    for row in m:
        if v & 1:
            s ^= row
        v >>= 1
    return s


@lru_cache(maxsize=BLOCK_IDS + 1)
def _shift(length: int) -> tuple[int, ...]:
    """Matrix that moves a checksum over ``length`` bytes: multiplication by
    x^(8 length) modulo the CRC polynomial, by squaring."""
    step = (0xEDB88320, *(1 << i for i in range(31)))
    out = tuple(1 << i for i in range(32))
    for _ in range(3):
        step = tuple(_times(step, r) for r in step)
    while length:
        if length & 1:
            out = tuple(_times(step, r) for r in out)
        step = tuple(_times(step, r) for r in step)
        length >>= 1
    return out


def _combine(crc1: int, crc2: int, length: int) -> int:
    """Checksum of two runs of bytes from theirs (the second is ``length`` long)."""
    return _times(_shift(length), crc1) ^ crc2


def read_documents(spark, path: str, lanes: int = LANES) -> DataFrame:
    """Decode every block: ``doc_id, start, n_tokens, ids_crc32`` per document,
    ``start`` being the ids of all documents before it."""
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(path)

    def run(batches):
        held: list[dict] = []

        def emit(rows):
            ids = decode_blocks([r["data"] for r in rows])
            cols: list[list] = [[] for _ in range(8)]
            for r, x in zip(rows, ids):
                raw, at = x.astype("<u4").tobytes(), 0
                for seq, doc, p, ps, n in zip(r["doc_seq"], r["doc_id"], r["piece"], r["pieces"], r["n"]):
                    for c, v in zip(cols, (r["part"], seq, doc, p, ps, r["start"] + at, n, zlib.crc32(raw[4 * at:4 * (at + n)]))):
                        c.append(v)
                    at += n
            types = (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                              ["part", "doc_seq", "doc_id", "piece", "pieces", "at", "n", "crc"])

        for b in batches:
            for a in range(0, b.num_rows, 256):
                held += b.slice(a, 256).to_pylist()
                if len(held) >= lanes:
                    yield emit(held)
                    held = []
        if held:
            yield emit(held)

    pieces = blocks.mapInArrow(run, "part int, doc_seq long, doc_id long, piece int, pieces int, at long, n long, crc long")

    def join_crc(batches):
        for b in batches:
            out = []
            for ps in b.column("ps").to_pylist():
                ps.sort(key=lambda p: p["piece"])
                crc = ps[0]["crc"]
                for p in ps[1:]:
                    crc = _combine(crc, p["crc"], 4 * p["n"])
                out.append(crc)
            keep = ["part", "doc_id", "at", "n"]
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in keep), pa.array(out, pa.int64())], [*keep, "crc"])

    cols = ["part", "doc_id", "at", "n", "crc"]
    found = written(pieces, "token-pieces")
    long_docs = (found.where("pieces > 1").groupBy("part", "doc_seq").agg(
        F.first("doc_id").alias("doc_id"), F.min("at").alias("at"), F.sum("n").alias("n"),
        F.collect_list(F.struct("piece", "n", "crc")).alias("ps"))
        .drop("doc_seq").mapInArrow(join_crc, "part int, doc_id long, at long, n long, crc long"))
    every = found.where("pieces = 1").select(*cols).unionByName(long_docs.select(*cols))
    # ids of the earlier parts: one row per part
    sums = found.groupBy("part").agg(F.sum("n").alias("m"))
    upto = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("part", F.coalesce(F.sum("m").over(upto), F.lit(0)).alias("first"))
    return every.join(sums, "part").select(
        "doc_id", (F.col("first") + F.col("at")).cast("long").alias("start"),
        F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32"))


def token_documents(docs: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Write the files (to a new folder by default) and read them back."""
    path = path or scratch(docs.sparkSession, "tokens")
    write_tokens(docs, path, **options)
    return read_documents(docs.sparkSession, path)
