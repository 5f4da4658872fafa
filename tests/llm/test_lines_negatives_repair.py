"""Line dedup, hard negatives and conversation repair against brute force."""

import hashlib
import heapq
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strata.llm import conversation_repair as cr
from strata.llm import hard_negatives as hn
from strata.llm import line_dedup as ld
from strata.llm import queries
from tests.conftest import SF001
from tests.llm.test_operators import empty_docs, odd_docs

SPACE = " \t\n\x0b\f\r"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# ---------------------------------------------------------------- line dedup

def brute_lines(rows, least_chars=20, least_documents=3):
    key = lambda line: re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(SPACE))
    order = lambda i: -math.inf if i is None else i
    held = {}
    for i, t in rows:
        for k in {key(x) for x in (t or "").split("\n")}:
            if len(k) >= least_chars:
                held.setdefault(k, []).append(order(i))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if len(held.get(key(x), [])) < least_documents or max(held[key(x)]) == order(i)]
        out.append((i, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out, key=repr)


def kept_lines(docs, **kw):
    return rows_of(ld.drop_repeated_lines(docs, **kw).select("doc_id", "n_lines", "n_dropped", "kept_text"))


def test_lines_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = kept_lines(docs)
    assert got == brute_lines(rows) and sum(r[2] for r in got) > 50


@pytest.mark.parametrize("parts", [1, 7])
def test_lines_edge_cases(spark, parts):
    """Strips, case, code points, blank lines, ids that repeat or are null."""
    rng = random.Random(parts)
    lines = ["A line that is long enough", " \ta Line that is LONG enough\x0b\f", "çççççççççççççççççççç", "ççççççççççççççççççç",
             "", "short", " " * 40, "İ line that is long enough", "\U0001f600" * 20, "nul\x00 in a line that is long"]
    rows = [(rng.choice([None, 1, 2, 3, *range(10, 40)]), "\n".join(rng.choices(lines, k=rng.randrange(6))))
            for _ in range(120)] + [(5, None), (None, None), (7, "\n"), (8, "")]
    rows += [(None, "only null ids hold this line")] * 3 + [(9, "said twice in one row, though\n" * 3)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    assert kept_lines(docs) == brute_lines(rows)
    assert kept_lines(docs, least_chars=1, least_documents=1) == brute_lines(rows, 1, 1)


def test_lines_odd_and_empty_input(spark):
    docs = odd_docs(spark).withColumn("n_lines", F.lit(1)).withColumn("GRP", F.lit(2))
    got = ld.drop_repeated_lines(docs)
    assert got.columns == [*docs.columns, "n_lines_", "n_dropped", "kept_text"]
    want = brute_lines([(r.doc_id, r.text) for r in docs.collect()])
    assert rows_of(got.select("doc_id", "n_lines_", "n_dropped", "kept_text")) == want
    assert rows_of(got.select(*docs.columns)) == rows_of(docs)
    assert ld.drop_repeated_lines(empty_docs(spark)).count() == 0


def test_hot_line_is_a_row_per_group(spark):
    """A line in every document gives one row per group of documents, in one shard of many."""
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(
        F.lit("a line that everyone has\n"), F.lit("own line of the document "), F.col("id").cast("string")).alias("text"))
    got = ld.drop_repeated_lines(docs)
    assert rows_of(got.groupBy("n_dropped").count()) == [(0, 1), (1, 2999)]


def test_perfect_hash_is_minimal_and_perfect():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 1000, 50_000):
        keys = rng.integers(0, 2**63, (n, 2), dtype=np.uint64)
        h = ld.PerfectHash.build(keys)
        again = ld.PerfectHash(h.levels, h.bits)
        assert sorted(again.numbers(keys).tolist()) == list(range(n))
        assert len(h.bits) * 8 <= 8 * 10 + 5 * n


def test_shard_tells_strange_keys_apart():
    rng = np.random.default_rng(2)
    keys = rng.integers(0, 2**63, (4000, 2), dtype=np.int64)
    docs, top = rng.integers(1, 9, 4000), rng.integers(0, 10**12, 4000)
    row = ld.build_shard(pa.table({"shard": np.full(4000, 3, np.int32), "h": keys[:, 0], "g": keys[:, 1], "docs": docs, "top": top})
                         ).to_pylist()[0]
    shard = ld.Shard(row["levels"], row["bits"], row["prints"], row["counts"], row["tops"])
    counts, tops = shard.probe(keys.view(np.uint64))
    assert counts.tolist() == docs.tolist() and tops.tolist() == top.tolist()
    assert not shard.probe(rng.integers(0, 2**63, (20_000, 2), dtype=np.uint64))[0].any()


# ------------------------------------------------------------ hard negatives

def brute_negatives(rows):
    sound = []
    for k, (i, label, v) in enumerate(rows):
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i is not None and i % 7 == 0 else label
        sound.append((k, i, label, [math.floor(256 * float(x)) for x in v]))
    order = lambda t: (-t[0], t[1] is None, t[1] or 0, t[2])
    out = []
    for k, i, label, v in sound:
        if i is None or i % 50:
            continue
        scores = [(sum(a * b for a, b in zip(v, w)), j, kk, other) for kk, j, other, w in sound if kk != k and len(w) == len(v)]
        negatives = sorted((t for t in scores if t[3] != label), key=order)
        for p in sorted((t for t in scores if t[3] == label), key=order)[:5]:
            fit = [n for n in negatives if 50 * p[0] <= 100 * n[0] <= 95 * p[0]][:3]
            out += [(i, p[1], r, n[1], p[0], n[0]) for r, n in enumerate(fit, 1)]
    return sorted(out, key=repr)


VEC = "vec_id long, embedding array<float>, label int"


def test_negatives_match_brute_force(spark):
    e = spark.read.parquet(f"{SF001}/embeddings.parquet")
    got = rows_of(hn.mine_embeddings(e).drop("anchor"))
    assert got == brute_negatives([(r.vec_id, r.label, r.embedding) for r in e.collect()]) and got


@pytest.mark.parametrize("block", [(50, 50), (1000, 3), (7, 1000)])
def test_negatives_ties_nulls_and_repeats(spark, block):
    """Small whole scores: many ties, zeros and negatives; null, repeated and odd rows."""
    rng = np.random.default_rng(block[0])
    pick = lambda p, x: x if rng.random() > p else None
    rows = [(pick(.1, int(rng.integers(0, 12)) * 25), pick(.05, [float(x) / 256 for x in rng.integers(-2, 3, 3)]),
             pick(.05, int(rng.integers(0, 3)))) for _ in range(250)]
    rows += [(50, [], 1), (100, [], 1), (3, [], 2), (50, [math.nan, 1.0, 1.0], 1), (50, [None, 1.0, 1.0], 1),
             (100, [math.inf, 1.0, 1.0], 1), (150, [1.0, 2.0], 0)]
    e = spark.createDataFrame(rows, VEC).coalesce(1)
    r = e.select(F.col("vec_id").alias("id"), F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10)
                 .otherwise(F.col("label")).alias("label"), hn.quantised(F.col("embedding")).alias("v"))
    got = rows_of(hn.mine(r, F.col("id") % 50 == 0, block=block).drop("anchor"))
    assert got == brute_negatives([(i, label, v) for i, v, label in rows]) and len(got) > 500


def test_negatives_empty_table_and_extra_columns(spark):
    none = spark.createDataFrame([], VEC)
    assert hn.mine_embeddings(none).count() == 0
    e = spark.read.parquet(f"{SF001}/embeddings.parquet")
    more = e.select("*", *[F.lit("x").alias(c) for c in ("id", "v", "rid", "anchor", "a", "r")])
    assert rows_of(hn.mine_embeddings(more)) == rows_of(hn.mine_embeddings(e))


def test_windows_stream_over_small_batches():
    """The stream's result does not depend on where batches end."""
    rng = np.random.default_rng(3)
    anchor = np.sort(rng.integers(0, 4, 400))
    score = np.concatenate([np.sort(rng.integers(-20, 60, (anchor == a).sum()))[::-1] for a in range(4)])
    whole = pa.record_batch({"anchor": anchor, "falling": -score, "id": np.arange(400), "rid": np.arange(400),
                             "positive": rng.random(400) < .1})
    run = lambda step: sorted(r for b in hn._streamed(5, 3, 50, 95)(
        whole.slice(i, step) for i in range(0, 400, step)) for r in map(tuple, (x.values() for x in b.to_pylist())))
    assert run(400) == run(1) == run(7) and run(400)


def test_large_components_stay_exact():
    big = np.array([[2**27 + 1, 3], [5, 7]], np.int64)
    assert hn._scores(big, big).tolist() == [[(2**27 + 1) ** 2 + 9, 5 * (2**27 + 1) + 21], [5 * (2**27 + 1) + 21, 74]]
    with pytest.raises(ValueError):
        hn._scores(big << 8, big << 8)


# -------------------------------------------------------- conversation repair

def brute_edits(rows):
    """Cheapest, then ASCII-least edits by best-first search over (row, state)."""
    heap, seen = [(0, "", 0, 0, ())], set()
    while heap:
        cost, audit, i, s, out = heapq.heappop(heap)
        if i == len(rows) and s in (0, 3):
            return cost, audit, out
        if (i, s) in seen:
            continue
        seen.add((i, s))
        moves = {0: "su", 1: "u", 2: "a", 3: "u"}[s]
        to = {"s": 1, "u": 2, "a": 3}
        for c in moves.strip("s"):
            heapq.heappush(heap, (cost + 5, audit + "I", i, to[c], (*out, (None, c))))
        if i < len(rows):
            initial, fault = rows[i]
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, s, out))
            if fault not in ("blank", "duplicate"):
                more = 5 * (fault == "truncated")
                if initial and initial in moves:
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, to[initial], (*out, (i, None))))
                for c in moves.strip("s"):
                    heapq.heappush(heap, (cost + 1 + more, audit + "R", i + 1, to[c], (*out, (i, c))))


def brute_repair(table, damage=True):
    blank = lambda x: " " if x is None else x
    convs = {}
    for c, t, role, text in table:
        rows, role, text = convs.setdefault(c, []), blank(role), blank(text)
        k = zlib.crc32(f"{blank(c)}:{blank(t)}".encode()) % 20 if damage else 9
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        rows += [(t, "user" if k == 4 else role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    out = []
    for c, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0))
        seen, faults = set(), []
        for _, role, text in rows:
            body = text.strip(SPACE)
            faults.append("blank" if not body else "duplicate" if (role, text) in seen
                          else "truncated" if body[-1] not in ".!?" else "")
            seen.add((role, text))
        cost, audit, edits = brute_edits([(r[1][:1], f) for r, f in zip(rows, faults)])
        text = "\n".join(({"u": "user", "a": "assistant"}[c2] if c2 else rows[i][1]) + ":" + ("" if i is None else rows[i][2])
                         for i, c2 in edits)
        turns = [t for t, _, _ in rows if t is not None]
        out.append((c, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *map(faults.count, cr.FAULTS[1:]),
                    sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:])), cost, audit,
                    hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


CONV = "conv_id long, turn long, role string, text string"


def test_repair_matches_brute_force(spark):
    t = spark.read.parquet(f"{SF001}/conversations.parquet")
    got = rows_of(queries.queries()["op11_conversation_repair"](spark, SF001))
    assert got == brute_repair([(r.conv_id, r.turn, r.role, r.text) for r in t.collect()])


def long_conversations(sizes, seed):
    rng, rows = random.Random(seed), []
    for c, n in sizes.items():
        rows += [(c, t if t else None, rng.choice(["user", "assistant", "system", "s", "tool", "", None, "user"]),
                  rng.choice([f"x{t}.", f"y{t}", "", " \n", "hi.", "z!", None, f"long {t}?", "é."])) for t in range(n)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_conversations_that_span_partitions(spark, seed):
    """One conversation holds most rows, so it lies in several range partitions."""
    rows = long_conversations({None: 150, 1: 700, 2: 1, 3: 40}, seed)
    t = spark.createDataFrame(rows, CONV).repartition(5)
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        done = cr.repair(cr.damaged(t))
        assert done.where("conv_id = 1").select(F.shiftright("pos", 33)).distinct().count() > 3
        assert rows_of(cr.repaired_conversations(t)) == brute_repair(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


def test_unrolling_matches_search_on_random_symbols():
    rng = random.Random(4)
    for n in [*range(7), 30, 200]:
        for _ in range(60):
            weights = [rng.random() ** 4 for _ in range(9)]
            symbols = []
            while len(symbols) < n:
                symbols += rng.choices(range(9), weights) * rng.choice([1, 1, 5, 70])
            symbols = symbols[:n]
            rows = [("", "blank") if s == 8 else ("suao"[s // 2], ("", "truncated")[s % 2]) for s in symbols]
            edits, behind, state = cr.unroll(bytes(symbols), 0, cr.FINAL, True)
            audit = "".join("I" * len(a) + e for a, e, _ in edits) + "I" * len(behind)
            cost, want, _ = brute_edits(rows)
            assert audit == want and state in cr.ACCEPTING
            v = cr.FINAL
            for s, k in reversed(cr.runs(bytes(symbols))):
                v = cr.advance(s, k, v)
            assert v[0] == cost


def test_run_powers_equal_single_steps():
    for s in range(9):
        m = cr.UNIT
        for n in range(1, 20):
            m = cr.times(m, cr.step(s))
            assert cr.run_matrix(s, n) == m
    assert cr.advance(0, 10**12, cr.FINAL)[0] == 10**12  # all system rows reroled in pairs


def test_repair_odd_and_empty_input(spark):
    rows = [(1, None, None, None), (1, None, None, None), (None, 3, "user", "a."), (None, None, "assistant", "b."),
            (2, 5, "user", "x" * 200_000 + "."), (2, 9, "assistant", "y.")]
    t = spark.createDataFrame(rows, CONV).select("*", *[F.lit(1).alias(c) for c in ("pos", "seg", "edit", "copy", "tie")])
    assert rows_of(cr.digest(cr.repair(t))) == brute_repair(rows, damage=False)
    none = spark.createDataFrame([], CONV)
    assert cr.repaired_conversations(none).count() == 0 and cr.repair(none).count() == 0


def test_conversations_without_rows_left(spark):
    gone = [(c, t, "user", "a.") for c in range(100, 300) for t in (1,) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0][:3]
    got = rows_of(cr.repaired_conversations(spark.createDataFrame(gone, CONV)))
    assert got == [(c, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c, *_ in gone] and gone
