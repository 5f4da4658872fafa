"""Conversation structure repair as a run-length min-plus program.

The rows of a conversation become symbols: the class of the role's first letter
(``s``, ``u``, ``a`` or another) and whether the row is sound, truncated or has to
go (blank, or a copy of an earlier row).  Repairing is the cheapest walk through a
four-state machine for ``(s?(ua)+)?`` whose steps keep, rerole, delete or insert.
One symbol's step is a 4x4 matrix over (min, +).

* Equal consecutive symbols collapse to runs; a run of n advances the cost vector
  by the binary powers of its symbol's matrix, which are cached, so it takes
  log n steps.  The vectors at the runs' ends then decide the edits in order:
  at each place the ASCII-least edit that still reaches the least cost.
* Min-plus products are associative, so a conversation needs no single task.
  Rows are written once in the order (conversation, turn), dealt by range; the
  rows of one conversation in one range partition are a *segment*.  Only the
  first and the last conversation of a partition can go on in another one: their
  segments' matrices give the cost vector after each segment, then the state
  that each segment ends in for each state it may start in, and at last every
  segment is unrolled by itself.

``repair`` returns one row per given row with its fault and its edit.  ``digest``
turns these into one row per conversation; it streams a conversation in order
through one task, because a hash of its text can only be taken in order, and
holds nothing of it but the audit letters.

Defined cases: a null role or text is one space, a null conversation id is a
conversation of its own, rows without a turn come first; rows of the same turn
follow each other by a hash of role and text, then by input order (copies stay
neighbours); every input row is a row of its own; an empty table gives an empty
result; further columns are ignored.  Copies are told apart by the MD5 of role
and text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import quoted, written

# Costs of the edits and the surcharge for truncated rows that stay.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
# States are nothing yet, after the system row, after a user row, after an assistant row.
STATES = range(4)
ACCEPTING = (0, 3)
#: Where a row of class s, u, a leads to from each state.
MOVES = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
CLASSES = "suao"
MUST_GO = 8  # symbol of a row that has to be deleted; others are 2 * class + truncated
FAULTS = ("", "blank", "duplicate", "truncated")
LEGAL = {"su", "ua", "au"}
ROLE = {"u": "user", "a": "assistant"}
INF = float("inf")

Vector = tuple
Matrix = tuple


# ------------------------------------------------------------ min-plus program

def times(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(x + b[k][t] for k, x in enumerate(row)) for t in STATES) for row in a)


def before(m: Matrix, v: Vector) -> Vector:
    """Least costs before a step, from those after it."""
    a, b, c, d = v
    return tuple(min(r[0] + a, r[1] + b, r[2] + c, r[3] + d) for r in m)


UNIT = tuple(tuple(0 if s == t else INF for t in STATES) for s in STATES)


def inserted(state: int) -> tuple[str, int]:
    """The only row that can be inserted in ``state``, and where it leads."""
    kind = "a" if state == 2 else "u"
    return kind, MOVES[state][kind]


def _insertions() -> Matrix:
    one = tuple(tuple(0 if s == t else INSERT if inserted(s)[1] == t else INF for t in STATES) for s in STATES)
    return times(times(one, one), times(one, one))


INSERTIONS = _insertions()
#: Least cost from each state once all rows are done.
FINAL = tuple(min(INSERTIONS[s][t] for t in ACCEPTING) for s in STATES)


@lru_cache(maxsize=None)
def step(symbol: int) -> Matrix:
    """One row of ``symbol``, with any insertions before it."""
    rows = []
    for s in STATES:
        to = [INF] * 4
        to[s] = DELETE
        if symbol != MUST_GO:
            kind, extra = CLASSES[symbol // 2], TRUNCATED * (symbol % 2)
            for c, t in MOVES[s].items():
                if c == kind:
                    to[t] = min(to[t], extra)
                if c != "s":
                    to[t] = min(to[t], REROLE + extra)
        rows.append(tuple(to))
    return times(INSERTIONS, tuple(rows))


@lru_cache(maxsize=None)
def power(symbol: int, k: int) -> Matrix:
    """``step(symbol)`` repeated ``2**k`` times."""
    return step(symbol) if k == 0 else times(power(symbol, k - 1), power(symbol, k - 1))


def advance(symbol: int, n: int, v: Vector) -> Vector:
    """Least costs before a run of ``n`` equal symbols, from those after it."""
    k = 0
    while n:
        if n & 1:
            v = before(power(symbol, k), v)
        n >>= 1
        k += 1
    return v


def run_matrix(symbol: int, n: int) -> Matrix:
    m, k = UNIT, 0
    while n:
        if n & 1:
            m = times(m, power(symbol, k))
        n >>= 1
        k += 1
    return m


def runs(symbols: bytes) -> list[tuple[int, int]]:
    a = np.frombuffer(symbols, np.uint8)
    if not len(a):
        return []
    cut = np.flatnonzero(a[1:] != a[:-1]) + 1
    at = np.concatenate([[0], cut])
    return list(zip(a[at].tolist(), np.diff(np.concatenate([at, [len(a)]])).tolist()))


def unroll(symbols: bytes, start: int, after: Vector, last: bool) -> tuple[list[tuple[str, str, str]], str, int]:
    """Edits of a segment: per row ``(roles inserted before it, edit, new role)``,
    the roles inserted behind the last row, and the state at the end."""
    parts = runs(symbols)
    ends = [after]
    for symbol, n in reversed(parts):
        ends.append(advance(symbol, n, ends[-1]))
    ends.reverse()
    state, edits = start, []
    for k, (symbol, n) in enumerate(parts):
        costs = [ends[k + 1]]  # inside the run, from its end
        m = step(symbol)
        for _ in range(n):
            costs.append(before(m, costs[-1]))
        kind, extra = (None, 0) if symbol == MUST_GO else (CLASSES[symbol // 2], TRUNCATED * (symbol % 2))
        for i in range(n, 0, -1):
            now, then, put = costs[i], costs[i - 1], ""
            while True:
                want = now[state]
                if DELETE + then[state] == want:
                    edits.append((put, "D", ""))
                    break
                c, t = inserted(state)
                if INSERT + now[t] == want:
                    put, state = put + c, t
                    continue
                if kind in MOVES[state] and extra + then[MOVES[state][kind]] == want:
                    edits.append((put, "K", ""))
                    state = MOVES[state][kind]
                    break
                edits.append((put, "R", c))  # what can be inserted is what a row can be reroled to
                state = t
                break
    behind = ""
    while last and FINAL[state]:
        c, state = inserted(state)
        behind += c
    return edits, behind, state


@lru_cache(maxsize=1 << 14)
def _short(symbols: bytes, start: int, after: Vector, last: bool):
    return unroll(symbols, start, after, last)


def solve(symbols: bytes, start: int, after: Vector, last: bool):
    return (_short if len(symbols) <= 64 else unroll)(symbols, start, after, last)


# ------------------------------------------------------------------- segments

def _segments(batches: Iterable[pa.RecordBatch], *names: str) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows of each (segment, conversation) in order, piece by piece: a piece ends
    with its batch.  Yields ``((seg, conv), rows)``."""
    for batch in batches:
        rows = zip(batch["seg"].to_pylist(), batch["conv_id"].to_pylist(), *[batch[n].to_pylist() for n in names])
        for key, piece in groupby(rows, key=lambda r: r[:2]):
            yield key, [r[2:] for r in piece]


def _joined(batches: Iterable[pa.RecordBatch], *names: str) -> Iterator[tuple[tuple, list[tuple]]]:
    """As ``_segments``, with the pieces of a segment put together."""
    for key, pieces in groupby(_segments(batches, *names), key=lambda p: p[0]):
        yield key, [r for _, piece in pieces for r in piece]


def _arrow(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(cols, schema)], schema=schema)


def _edges(conv: pa.DataType):
    """Matrices of the segments that begin or end a partition."""
    schema = pa.schema([("conv_id", conv), ("seg", pa.int64()), ("matrix", pa.list_(pa.float64()))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # (seg, conv, matrix, whether it begins its partition)
        last_seg = None
        for key, pieces in groupby(_segments(batches, "sym"), key=lambda p: p[0]):
            m = UNIT
            for _, rows in pieces:
                for symbol, n in runs(bytes(r[0] for r in rows)):
                    m = times(m, run_matrix(symbol, n))
            seg, c = key
            if held is not None and (held[3] or held[0] != seg):
                yield _arrow([(held[1], held[0], [x for r in held[2] for x in r])], schema)
            held = (seg, c, m, seg != last_seg)
            last_seg = seg
        if held is not None:
            yield _arrow([(held[1], held[0], [x for r in held[2] for x in r])], schema)

    return run


def _links(conv: pa.DataType):
    """Costs after each of these segments; rows come from the last segment on."""
    schema = pa.schema([("conv_id", conv), ("seg", pa.int64()), ("after", pa.list_(pa.float64())), ("last", pa.bool_())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, v = object(), FINAL
        for batch in batches:
            out = []
            for c, seg, flat in zip(*[batch[n].to_pylist() for n in ("conv_id", "seg", "matrix")]):
                last = c != now
                now, v = c, FINAL if last else v
                out.append((c, seg, list(v), last))
                v = before(tuple(tuple(flat[4 * s:4 * s + 4]) for s in STATES), v)
            yield _arrow(out, schema)

    return run


def _ends(conv: pa.DataType):
    """The state that each of these segments ends in, for every start."""
    schema = pa.schema([("conv_id", conv), ("seg", pa.int64()), ("ends", pa.list_(pa.int32()))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (seg, c), rows in _joined(batches, "sym", "after", "last"):
            symbols, after, last = bytes(r[0] for r in rows), tuple(rows[0][1]), rows[0][2]
            yield _arrow([(c, seg, [solve(symbols, s, after, last)[2] for s in STATES])], schema)

    return run


def _starts(conv: pa.DataType):
    schema = pa.schema([("conv_id", conv), ("seg", pa.int64()), ("start", pa.int32())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = object(), 0
        for batch in batches:
            out = []
            for c, seg, ends in zip(*[batch[n].to_pylist() for n in ("conv_id", "seg", "ends")]):
                state = 0 if c != now else state
                now = c
                out.append((c, seg, state))
                state = ends[state]
            yield _arrow(out, schema)

    return run


_EDITS = pa.schema([("pos", pa.int64()), ("before", pa.string()), ("edit", pa.string()), ("to", pa.string()),
                    ("behind", pa.string())])


def _edits(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (_, _), rows in _joined(batches, "pos", "sym", "start", "after", "last"):
        _, _, start, after, last = rows[0]
        symbols = bytes(r[1] for r in rows)
        if start is None:  # a conversation within one partition
            start, after, last = 0, FINAL, True
        edits, behind, _ = solve(symbols, start, tuple(after), last)
        n = len(rows) - 1
        yield _arrow([(r[0], *e, behind if k == n else "") for k, (r, e) in enumerate(zip(rows, edits))], _EDITS)


# ------------------------------------------------------------------- operator

def _fault_columns() -> tuple[Column, Column, Column]:
    space = " \t\n\x0b\f\r"
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    last = F.substring(F.rtrim(F.col("text"), F.lit(space)), -1, 1)
    kind = F.substring("role", 1, 1)
    of_class = F.when(kind == "s", 0).when(kind == "u", 1).when(kind == "a", 2).otherwise(3)
    return blank, ~last.isin(".", "!", "?"), of_class


def ordered(rows: DataFrame) -> DataFrame:
    """``rows`` written once in their order, each with its place ``pos`` and the
    partition ``seg`` it stands in."""
    some = lambda c: F.coalesce(quoted(c), F.lit(" "))
    r = rows.select(quoted("conv_id").alias("conv_id"), quoted("turn").alias("turn"), some("role").alias("role"),
                    some("text").alias("text"))
    r = r.withColumn("tie", F.xxhash64("role", "text")).withColumn("rid", F.monotonically_increasing_id())
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "tie", "rid"]
    r = r.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("pos", F.monotonically_increasing_id())
    return written(r.select("conv_id", "turn", "role", "text", "pos", F.shiftright("pos", 33).alias("seg")), "turns")


def repair(rows: DataFrame) -> DataFrame:
    """One row per row of ``rows`` (``conv_id``, ``turn``, ``role``, ``text``) with its
    place ``pos``, its ``fault`` (empty, blank, duplicate or truncated), its ``edit``
    (K, R or D), the role ``to`` (``u`` or ``a``) it is changed to, and the roles
    (letters) of rows inserted ``before`` it and ``behind`` it."""
    t = ordered(rows)
    blank, cut, of_class = _fault_columns()
    print_ = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"))
    slim = t.select("conv_id", "seg", "pos", blank.alias("blank"), cut.alias("cut"), of_class.alias("class"), print_.alias("print"))
    first = slim.groupBy("conv_id", "print").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("first"))
    fault = (F.when(F.col("blank"), 1).when(F.col("first").isNull(), 2).when(F.col("cut"), 3).otherwise(0))
    s = slim.join(first, "pos", "left").select("conv_id", "seg", "pos", fault.alias("fault"), "class")
    s = s.withColumn("sym", F.when(F.col("fault").isin(1, 2), MUST_GO)
                     .otherwise(2 * F.col("class") + (F.col("fault") == 3).cast("int")))
    s = written(s.select("conv_id", "seg", "pos", "fault", "sym"), "symbols")

    kind = s.schema["conv_id"].dataType
    ddl = kind.simpleString()
    from pyspark.sql.pandas.types import to_arrow_type
    conv = to_arrow_type(kind)
    in_order = lambda df: df.repartition("seg").sortWithinPartitions("pos")
    edges = in_order(s.select("conv_id", "seg", "pos", "sym")).mapInArrow(_edges(conv), f"conv_id {ddl}, seg long, matrix array<double>")
    links = written(edges.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("seg"))
                    .mapInArrow(_links(conv), f"conv_id {ddl}, seg long, after array<double>, last boolean"), "links")
    both = lambda a, b, how: a.join(
        b.withColumnsRenamed({"conv_id": "c_", "seg": "s_"}),
        a["conv_id"].eqNullSafe(F.col("c_")) & (a["seg"] == F.col("s_")), how).drop("c_", "s_")
    ends = (in_order(both(s, links, "inner")).mapInArrow(_ends(conv), f"conv_id {ddl}, seg long, ends array<int>"))
    starts = (ends.repartition("conv_id").sortWithinPartitions("conv_id", "seg")
              .mapInArrow(_starts(conv), f"conv_id {ddl}, seg long, start int"))
    known = written(both(links, starts, "inner"), "starts")
    edits = in_order(both(s.select("conv_id", "seg", "pos", "sym"), known, "left")).mapInArrow(
        _edits, "pos long, before string, edit string, to string, behind string")
    named = F.element_at(F.array(*map(F.lit, FAULTS)), F.col("fault") + 1)
    return (t.drop("seg").join(s.select("pos", named.alias("fault")), "pos").join(edits, "pos")
            .select("conv_id", "pos", "turn", "role", "text", "fault", "edit", "to", "before", "behind"))


class Digest:
    """What a conversation's row of the result needs, row by row."""

    def __init__(self):
        self.turns: list[int] = []  # first and last
        self.distinct = 0
        self.faults = dict.fromkeys(FAULTS, 0)
        self.illegal = self.cost = 0
        self.initial = None
        self.audit = bytearray()
        self.hash = hashlib.sha256()
        self.any = False

    def put(self, role: str, text: str) -> None:
        self.hash.update((b"\n" if self.any else b"") + f"{role}:{text}".encode())
        self.any = True

    def insert(self, kinds: str) -> None:
        for k in kinds:
            self.put(ROLE[k], "")
            self.cost += INSERT
        self.audit += b"I" * len(kinds)

    def row(self, turn, role: str, text: str, fault: str, edit: str, to: str, ahead: str, behind: str) -> None:
        if turn is not None and (not self.turns or turn != self.turns[1]):
            self.turns = [self.turns[0] if self.turns else turn, turn]
            self.distinct += 1
        self.faults[fault] += 1
        if self.initial is not None and self.initial + role[:1] not in LEGAL:
            self.illegal += 1
        self.initial = role[:1]
        self.insert(ahead)
        self.audit += edit.encode()
        if edit == "D":
            self.cost += DELETE
        else:
            self.cost += (edit == "R") * REROLE + (fault == "truncated") * TRUNCATED
            self.put(ROLE.get(to, role), text)
        self.insert(behind)

    def result(self, conv) -> tuple:
        gaps = self.turns[1] - self.turns[0] + 1 - self.distinct if self.turns else 0
        return (conv, gaps, self.faults["blank"], self.faults["duplicate"], self.faults["truncated"], self.illegal,
                self.cost, self.audit.decode(), self.hash.hexdigest())


def digest(repaired: DataFrame) -> DataFrame:
    """One row per conversation of ``repair``'s result."""
    kind = repaired.schema["conv_id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    schema = pa.schema([("conv_id", to_arrow_type(kind)), *[(c, pa.int64()) for c in counts],
                        ("audit", pa.string()), ("repaired_sha256", pa.string())])
    out = T.StructType([T.StructField("conv_id", kind), *[T.StructField(c, T.LongType()) for c in counts],
                        T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])
    names = ("conv_id", "turn", "role", "text", "fault", "edit", "to", "before", "behind")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, d = None, None
        for batch in batches:
            done = []
            for conv, *row in zip(*[batch[n].to_pylist() for n in names]):
                if d is None or conv != now:
                    if d is not None:
                        done.append(d.result(now))
                    now, d = conv, Digest()
                d.row(*row)
            yield _arrow(done, schema)
        if d is not None:
            yield _arrow([d.result(now)], schema)

    return (repaired.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "pos")
            .mapInArrow(run, out))


# ------------------------------------------------------------------- damage

def damaged(table: DataFrame) -> DataFrame:
    """A ``conversations`` table with faults put in, chosen by the CRC-32 of
    ``conv_id:turn`` (nulls are one space): a twentieth of the rows each is dropped,
    emptied, stripped of ``.!?``, repeated, or made the user's."""
    some = lambda c: F.coalesce(quoted(c).cast("string"), F.lit(" "))
    pick = F.crc32(F.concat(some("conv_id"), F.lit(":"), some("turn")).cast("binary")) % 20
    text = (F.when(pick == 1, F.lit("")).when(pick == 2, F.regexp_replace(some("text"), "[.!?]", ""))
            .otherwise(some("text")))
    role = F.when(pick == 4, F.lit("user")).otherwise(some("role"))
    kept = table.where(pick != 0)
    return kept.select(quoted("conv_id").alias("conv_id"), quoted("turn").alias("turn"), role.alias("role"),
                       text.alias("text"), F.explode(F.array_repeat(F.lit(0), F.when(pick == 3, 2).otherwise(1))).alias("copy")
                       ).drop("copy")


def repaired_conversations(table: DataFrame) -> DataFrame:
    """One row per conversation of ``table``, damaged and repaired; conversations
    that lost all rows have zeros, an empty audit and the hash of nothing."""
    found = digest(repair(damaged(table))).withColumnsRenamed({"conv_id": "c_"})
    every = table.select(quoted("conv_id").alias("conv_id")).distinct()
    zero = {c: F.coalesce(F.col(c), F.lit(0).cast("long")) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    return (every.join(found, every["conv_id"].eqNullSafe(F.col("c_")), "left").drop("c_")
            .withColumns({**zero, "audit": F.coalesce("audit", F.lit("")),
                          "repaired_sha256": F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256))}))
