"""The operators against brute force, round trips and edge cases."""

import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from strata.llm import (
    decontaminate, mixing, pii, quality, sharding, simhash, substring, token_files, url_rules, warc,
)
from strata.llm.common import ship, written
from tests.conftest import SF001

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    ship(spark)
    return spark.read.parquet(f"{SF001}/documents.parquet")


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text) for r in docs.orderBy("doc_id").collect()]


def odd_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, and
    further columns whose names the operators use themselves."""
    ship(spark)
    long_text = " ".join(f"w{i % 977}" for i in range(30_000))
    data = [(1, "one two three four five", "en", "a", 23), (1, "one two three four five", "en", "a", 23),
            (2, None, None, None, None), (None, "one two three four five", "en", "b", 23), (3, "", "en", "b", 0),
            (4, " \t\n ", "en", "b", 4), (5, long_text, "en", "a", len(long_text)), (6, long_text, "en", None, 1),
            (None, None, None, None, None), (7, "éé ßß 漢字 \U0001f600 x\x00y", "de", "a", 5)]
    d = spark.createDataFrame(data, DOC)
    for c in ("fp", "shard", "size", "hits", "n_words", "row", "taken", "spans", "kept", "near_fp", "k"):
        d = d.withColumn(c, F.lit("x"))
    return d


def empty_docs(spark):
    ship(spark)
    return spark.createDataFrame([], DOC)


# ------------------------------------------------------------------ sharding

def test_shards_have_near_equal_bytes_and_gapless_slots(docs, rows):
    got = sharding.shard_documents(docs, shards=6).collect()
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in got) == [
        (i, len(t.encode()) + 8, zlib.crc32(t.encode())) for i, t in rows]
    load = {}
    for r in got:
        load.setdefault(r.shard, []).append(r)
    total, largest = sum(r.size for r in got), max(r.size for r in got)
    for rs in load.values():
        assert sorted(r.slot for r in rs) == list(range(len(rs)))
        assert abs(sum(r.size for r in rs) - total / 6) <= largest


def test_map_versions_move_only_what_they_must(spark, tmp_dir):
    sizes = [random.Random(1).randrange(1, 1000) for _ in range(512)]
    one = sharding.plan_map(sizes, 4)
    two = sharding.rebalance(one, sizes, 5)
    assert two.version == 2 and {two.owner[s] for s in one.moved(two)} == {4}
    load = [sum(z for z, o in zip(sizes, two.owner) if o == s) for s in range(5)]
    assert max(load) - min(load) <= 2 * max(sizes)
    hot = [x * 20 if one.owner[i] == 0 else x for i, x in enumerate(sizes)]
    three = sharding.rebalance(one, hot)
    before = [sum(z for z, o in zip(hot, one.owner) if o == s) for s in range(4)]
    after = [sum(z for z, o in zip(hot, three.owner) if o == s) for s in range(4)]
    assert max(after) < max(before) and all(one.owner[s] == 0 for s in one.moved(three))
    for m in (one, two):
        sharding.save_map(spark, m, f"{tmp_dir}/map")
    assert sharding.load_map(spark, f"{tmp_dir}/map") == two
    assert sharding.load_map(spark, f"{tmp_dir}/map", 1) == one


def test_sharding_by_bytes_holds_where_ids_repeat(spark, docs):
    """A third of the rows have no id, many of them the same text."""
    d = docs.select(F.when(F.col("doc_id") % 3 > 0, F.col("doc_id")).alias("doc_id"),
                    F.when(F.col("doc_id") % 6 > 0, F.col("text")).otherwise(F.lit("one and the same")).alias("text"))
    d = d.unionByName(d).unionByName(d)
    load = {r.shard: (r.b, r.m) for r in sharding.shard_documents(d, shards=4).groupBy("shard").agg(
        F.sum("size").alias("b"), F.max("size").alias("m")).collect()}
    total, largest = sum(b for b, _ in load.values()), max(m for _, m in load.values())
    assert all(abs(b - total / 4) <= largest for b, _ in load.values())


def test_sharding_odd_input(spark):
    got = sharding.shard_documents(odd_docs(spark), shards=3).collect()
    assert len(got) == 10 and {r.size for r in got if r.doc_id == 2} == {8}
    assert sharding.shard_documents(empty_docs(spark)).count() == 0


# ----------------------------------------------------------- decontamination

def brute_hits(texts, items, window=10):
    words = lambda s: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+",
                                 re.sub("[A-Z]", lambda m: m[0].lower(), s or ""))
    grams = {}
    for i, t in items:
        w = words(t)
        m = min(window, len(w))
        for k in range(len(w) - m + 1 if m else 0):
            grams.setdefault(m, {}).setdefault(tuple(w[k:k + m]), set()).add(i)
    out = []
    for t in texts:
        w, hit, found = words(t), set(), set()
        for m, g in grams.items():
            for k in range(len(w) - m + 1):
                if tuple(w[k:k + m]) in g:
                    hit |= set(range(k, k + m))
                    found |= g[tuple(w[k:k + m])]
        out.append((len(w), len(hit), sorted(found)))
    return out


@pytest.mark.parametrize("block_bytes", [1 << 20, 40])
def test_decontamination_matches_brute_force(spark, block_bytes):
    rng = random.Random(3)
    text = lambda n: " ".join(rng.choice("a b c The of-é 7 Ünd").strip() for _ in range(n))
    items = [(f"i{k}", text(rng.choice([0, 1, 2, 5, 9, 10, 11, 25]))) for k in range(12)] + [("i1", "a a a b"), ("z", None)]
    texts = [text(rng.choice([0, 1, 3, 12, 60, 400])) for _ in range(40)] + [None, "", items[3][1] + " x " + items[4][1]]
    ship(spark)
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id string, text string")
    got = {r.doc_id: (r.n_words, sum(s.end - s.start for s in r.hits), list(r["items"]))
           for r in decontaminate.find_items(d, b, block_bytes=block_bytes).collect()}
    assert [got[k] for k in range(len(texts))] == brute_hits(texts, items)


def test_decontamination_odd_input(spark):
    items = spark.createDataFrame([(None, "three four"), (9, None)], "item_id long, text string")
    kept = decontaminate.remove_contaminated(odd_docs(spark), items)
    assert kept.columns == odd_docs(spark).columns and kept.count() == 7
    assert decontaminate.find_items(empty_docs(spark), items).count() == 0
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.remove_contaminated(odd_docs(spark), none).count() == 10


# ------------------------------------------------------------------- quality

def brute_counts(t):
    w = WORDS.findall(t or "")
    lines = [x for x in (t or "").split("\n") if WORDS.search(x)]
    grams = {}
    for k in range(len(w) - 7):
        grams.setdefault(tuple(w[k:k + 8]), []).append(k)
    rep = {p for ks in grams.values() if len(ks) > 1 for k in ks for p in range(k, k + 8)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(rep))


def test_quality_counts_match_brute_force(docs, rows):
    got = {r.doc_id: r for r in quality.judge(docs).collect()}
    for i, t in rows:
        r, want = got[i], brute_counts(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r.base_failed and r.kept)


def test_estimation_recovers_rule_accuracies():
    rng, names = random.Random(5), ["a", "b", "c", "d"]
    on_good = {"a": .05, "b": .02, "c": .10, "d": .01}
    on_bad = {"a": .80, "b": .60, "c": .70, "d": .50}
    seen = {}
    for _ in range(20_000):
        good = rng.random() < 0.8
        votes = tuple("b" if rng.random() < (on_good if good else on_bad)[r] else "g" for r in names)
        seen[votes] = seen.get(votes, 0) + 1
    v = quality.estimate([(dict(zip(names, k)), n) for k, n in seen.items()], names)
    assert abs(v.good_share - 0.8) < 0.03
    for r in names:
        assert abs(v.on_bad[r]["b"] - on_bad[r]) < 0.06 and abs(v.on_good[r]["b"] - on_good[r]) < 0.03


def test_quality_accuracy_on_labels(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lab = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    both = quality.judge(d).join(lab, "doc_id").where("not base_failed").collect()
    clean = [r for r in both if r.quality == 1]
    junk = [r for r in both if r.quality == 0]
    assert sum(r.kept for r in clean) >= 0.98 * len(clean)
    assert sum(not r.kept for r in junk) >= 0.9 * len(junk)


def test_quality_odd_input(spark):
    j = quality.judge(odd_docs(spark)).collect()
    assert len(j) == 10 and sum(r.n_words == 0 for r in j) == 4
    assert quality.filter_quality(odd_docs(spark)).columns == odd_docs(spark).columns
    assert quality.filter_quality(empty_docs(spark)).count() == 0


# --------------------------------------------------------------- token files

def test_coder_round_trip_and_damage():
    rng = np.random.default_rng(0)
    blocks = [rng.integers(0, 49408, n) for n in (1, 2, 500, 2048)] + [np.zeros(700, np.int64), np.arange(900) % 5,
                                                                        np.full(3, 65535), np.zeros(0, np.int64)]
    coded = token_files.encode_blocks(blocks)
    for a, b in zip(blocks, token_files.decode_blocks(coded)):
        assert np.array_equal(a, b)
    alone = token_files.decode_blocks([coded[2]])[0]
    assert np.array_equal(alone, blocks[2])
    assert len(coded[5]) < 900 / 4
    bad = bytearray(coded[3])
    bad[100] ^= 1
    with pytest.raises(ValueError):
        token_files.decode_blocks([bytes(bad)])


def mixed_blocks(n, longest):
    rng = np.random.default_rng(5)
    return [np.minimum(rng.zipf(1.2, longest - i % 7), 49407).astype(np.uint16) for i in range(n)]


def test_coder_writes_the_same_bytes_as_before():
    coded = token_files.encode_blocks(mixed_blocks(150, 700))  # lanes that end apart, three groups of lanes
    assert (sum(map(len, coded)), zlib.crc32(b"".join(coded))) == (141966, 1654876870)


def test_coder_keeps_no_large_copies_of_its_tables():
    import tracemalloc

    blocks = mixed_blocks(1024, 100)
    peaks = []
    tracemalloc.start()
    try:
        coded = token_files.encode_blocks(blocks)
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.reset_peak()
        token_files.decode_blocks(coded)
        peaks.append(tracemalloc.get_traced_memory()[1])
    finally:
        tracemalloc.stop()
    assert max(peaks) < 14_500 * 1024  # bytes a lane; 15,900 before


def test_choices_without_branches():
    rng = np.random.default_rng(2)
    first, a, b = rng.random(99) < 0.5, rng.integers(-2**31, 2**31, 99), rng.integers(-2**31, 2**31, 99)
    for t in (np.int32, np.int64):
        assert np.array_equal(token_files._pick(first, a.astype(t), b.astype(t)), np.where(first, a, b))
    rows = np.sort(rng.integers(0, 50, (99, 16)).astype(np.int32), axis=1)
    want = rng.integers(0, 50, 99).astype(np.int32)
    assert np.array_equal(token_files._at_or_below(rows, want), (rows <= want[:, None]).sum(axis=1))


def test_checksums_combine():
    a, b = b"abc" * 100, b"xyz" * 33
    assert token_files._combine(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


def plain_ids(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(token_files.tokenizer_path())
    t.encode_special_tokens = True
    return [t.encode(x or "", add_special_tokens=False).ids + [1] for x in texts]


def test_token_files_hold_what_the_tokenizer_gives(docs, rows):
    got = {r.doc_id: r for r in token_files.token_documents(docs).collect()}
    start = 0
    for (i, t), ids in zip(rows, plain_ids([t for _, t in rows])):
        r = got[i]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_pieces_encode_like_whole_texts():
    texts = ["It's we'll a,b.c!! d'x <|endoftext|> é́, ÀB,c", "x...y 12,3 -a- «q»,r", "a\u00a0b\u2003c,d", "İI ﬁ,",
             "one\x1ctwo,three", "", "don't!'s"]
    rng = np.random.default_rng(7)  # invented words of Latin and other letters
    letters = list("aZéÈßİıſÿŸǅ×÷ªº'.,0#ΣςσΆ  \tœŒđÐħ-é中KÅɏɐ")
    texts += ["".join(rng.choice(letters, 9)) for _ in range(3000)]
    import pyarrow as pa

    data = b"".join(t.encode() for t in texts)
    off = np.cumsum([0] + [len(t.encode()) for t in texts])
    ids, counts = token_files.tokenize(np.frombuffer(data, np.uint8), off, token_files.tokenizer_path())
    at = 0
    for want, n in zip(plain_ids(texts), counts.tolist()):
        assert ids[at:at + n].tolist() == want[:-1]
        at += n
    assert pa is not None


def test_added_tokens_in_a_text_get_their_ids(spark):
    from tokenizers import Tokenizer

    ship(spark)
    t = Tokenizer.from_file(token_files.tokenizer_path())  # as it is
    texts = ["a <|endoftext|> b", "<|endoftext|>", "", "x<|startoftext|><|endoftext|>y", "A<|ENDOFTEXT|>b <|endoftext|", "<|endof",
             "text|> c", "<|<|endoftext|>|>", "é<|endoftext|>\u0301a,b", "plain"]
    want = [t.encode(x, add_special_tokens=False).ids for x in texts]
    assert want[0] == [320, 49407, 321]
    data, off = "".join(texts).encode(), np.cumsum([0] + [len(x.encode()) for x in texts])
    ids, counts = token_files.token_ids(np.frombuffer(data, np.uint8), off, token_files.tokenizer_path())
    assert ids.tolist() == sum(want, []) and counts.tolist() == [len(w) for w in want]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in token_files.token_documents(d).collect())
    ends = np.cumsum([0] + [len(w) + 1 for w in want]).tolist()
    assert got == [(i, ends[i], len(w) + 1, zlib.crc32(np.array(w + [1], "<u4").tobytes())) for i, w in enumerate(want)]


def test_token_files_odd_input(spark):
    got = token_files.token_documents(odd_docs(spark), block_ids=64).collect()
    assert len(got) == 10 and {r.n_tokens for r in got if r.doc_id == 2} == {1}
    ends = sorted((r.start, r.start + r.n_tokens) for r in got)
    assert all(a[1] == b[0] for a, b in zip(ends, ends[1:])) and ends[0][0] == 0
    assert token_files.token_documents(empty_docs(spark)).count() == 0


# ---------------------------------------------------------------------- warc

def test_canonical_urls(spark):
    want = {"HTTP://WWW.Example.COM:80/a/?utm_source=x&b=2&a=1#f": "example.com/a?a=1&b=2", "http://e.org": "e.org",
            "https://e.org/?ref=1": "e.org", "e.org/x?q": "e.org/x?q"}
    d = spark.createDataFrame([(u,) for u in want] + [(None,)], "u string")
    assert {r[0]: r[1] for r in d.select("u", warc.canonical_url(F.col("u"))).collect()} == {**want, None: None}


def test_revisits_resolve_to_the_latest_earlier_response(spark):
    h = lambda **k: {x.replace("_", "-"): v for x, v in k.items()}
    recs = [(1, "http://a/x", 1, "response", 200, h(etag='"1"', content_type="t", cache_control="a"), None, "one"),
            (2, "http://a/x#f", 5, "response", 200, h(etag='"2"'), None, "two"),
            (3, "http://a/x", 3, "revisit", 304, h(etag='W/"1"', cache_control="b", content_length="0"), None, None),
            (4, "https://www.a/x/", 9, "revisit", 304, h(etag='"2"'), None, None),
            (5, "http://a/x", 10, "revisit", 304, h(etag='"1"'), None, None),
            (6, "http://a/x", 1, "revisit", 304, h(etag='"1"'), None, None),
            (7, None, 9, "revisit", 304, None, None, None), (8, "http://a/y", 2, "response", 404, h(), None, "no"),
            (9, "http://a/y", None, "revisit", 304, h(), None, None), (10, "http://a/x", 7, "revisit", 304, h(), "d", None)]
    d = spark.createDataFrame(recs, "record_id long, url string, at long, kind string, status int, "
                                    "headers map<string,string>, digest string, body string")
    got = {r.record_id: (r.base_id, r.matched, r.body) for r in warc.resolve(d, buckets=4).collect()}
    assert got == {3: (1, True, "one"), 4: (2, True, "two"), 5: (2, False, None), 6: (None, False, None),
                   7: (None, False, None), 9: (None, False, None), 10: (2, False, None)}
    r = warc.resolve(d).where("record_id = 3").first()
    assert r.headers == {"etag": 'W/"1"', "content-type": "t", "cache-control": "b"}
    assert warc.resolve(d.limit(0)).count() == 0


def test_revisits_that_share_an_id_resolve_by_their_own_url(spark):
    h = {"etag": '"1"'}
    long = "x" * 300_000
    recs = [(i, f"http://{u}/", at, kind, 200 if kind == "response" else 304, h, None, body) for i, u, at, kind, body in [
        (1, "a", 1, "response", "body a"), (1, "b", 1, "response", "body b"), (None, "c", 1, "response", long),
        (None, "c", 1, "response", long), (2, "a", 5, "revisit", None), (2, "b", 5, "revisit", None), (2, "b", 5, "revisit", None),
        (None, "c", 6, "revisit", None), (None, "d", 6, "revisit", None), (None, "a", 0, "revisit", None)]]
    d = spark.createDataFrame(recs, "record_id long, url string, at long, kind string, status int, "
                                    "headers map<string,string>, digest string, body string")
    d = d.select("*", *[F.lit("z").alias(c) for c in ("rec", "base_id", "bucket", "near", "url_key")])
    got = sorted(((r.record_id, r.url_key, r.base_id, r.matched, r.body) for r in warc.resolve(d, buckets=3).collect()), key=repr)
    assert got == sorted([(2, "a", 1, True, "body a"), (2, "b", 1, True, "body b"), (2, "b", 1, True, "body b"),
                          (None, "c", None, True, long), (None, "d", None, False, None), (None, "a", None, False, None)], key=repr)


# ----------------------------------------------------------------- url rules

def test_url_rules_odd_input(spark):
    urls = ["http://x.Example.NET/en/a", "http://example.net/de/", "http://net", "https://a.net/x", None, "nothing", "",
            "http://example.com/de/1", "ftp://q.org/fr/?a=1#b", "http://notexample.net/en/", "http://net/?x://org/fr/"]
    d = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string").withColumn("host", F.lit("x"))
    got = {r.page_id: (r.host, r.path, r.rule) for r in url_rules.judge(d).collect()}
    assert got[0] == ("x.example.net", "/en/a", "example.net/en/") and got[1] == ("example.net", "/de/", "net/")
    assert got[2] == ("net", "", None) and got[4] == got[5] == got[6] == ("", "", None)
    assert got[7][2] == "example.com/de/" and got[8] == ("q.org", "/fr/", "org/fr/") and got[9][2] == "net/"
    assert got[10] == ("net", "/", "net/")
    assert url_rules.judge(d.limit(0)).count() == 0


def test_mined_rules_have_support_and_confidence(spark):
    rows = [(["host=a", "path=spam"], "block")] * 9 + [(["host=a", "path=ok"], "allow")] * 9 + [(["host=b", "path=spam"], "allow")]
    d = spark.createDataFrame(rows, "tokens array<string>, label string")
    got = {(tuple(r.tokens), r.label): (r.support, r.confidence) for r in url_rules.mine(d, 0.2, 0.95).collect()}
    assert got == {(("path=ok",), "allow"): (9, 1.0), (("host=a", "path=ok"), "allow"): (9, 1.0),
                   (("host=a", "path=spam"), "block"): (9, 1.0)}


def test_rules_are_mined_over_all_tokens_of_a_url(spark):
    front = [f"host=h{i:02d}" for i in range(30)]  # more tokens than the rules' own, sorted before them
    rows = [(front + ["path=spam"], "block")] * 9 + [(front + ["path=ok"], "allow")] * 9 + [(["path=ok"], "block")]
    d = spark.createDataFrame(rows, "tokens array<string>, label string")
    got = {(tuple(r.tokens), r.label): (r.support, r.confidence) for r in url_rules.mine(d, 0.2, 0.95).collect()}
    assert got[(("path=spam",), "block")] == (9, 1.0)
    assert (("path=ok",), "allow") not in got and got[(("host=h00", "path=ok"), "allow")] == (9, 1.0)
    assert got[(("host=h28", "host=h29", "path=spam"), "block")] == (9, 1.0)
    assert all(len(t) <= 3 for t, _ in got)  # no longer one is surer


def test_long_rules_are_mined_where_no_shorter_one_is_sure(spark):
    four = ["host=a", "host=b", "path=c", "query=d"]
    rows = [(four, "block")] * 10 + [(four[:i] + four[i + 1:], "allow") for i in range(4) for _ in range(5)]
    d = spark.createDataFrame(rows, "tokens array<string>, label string")
    got = {(tuple(r.tokens), r.label): (r.support, r.confidence) for r in url_rules.mine(d, 0.3, 0.9).collect()}
    assert got == {(tuple(four), "block"): (10, 1.0)}


# ------------------------------------------------------------------- simhash

def brute_fp(t):
    w = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode()).split()
    sh = [b" ".join(w[k:k + 3]) for k in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    hs = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_fingerprints_match_brute_force(rows):
    for _, t in rows[:60]:
        assert simhash.fingerprint(t) == brute_fp(t)
    assert simhash.fingerprint(None) == 0 and simhash.fingerprint("a b") == brute_fp("a b")


def test_golay_code_is_perfect():
    g = simhash.golay()
    rng = np.random.default_rng(1)
    index = rng.integers(0, 1 << 12, 2000)
    word = index << 11 | g.parity[index]
    for k in range(4):
        flips = np.zeros(2000, np.int64)
        for i in range(2000):
            flips[i] = sum(1 << int(b) for b in rng.choice(23, k, replace=False))
        assert (g.decode(word ^ flips) == index).all()


def test_every_pair_within_three_bits_shares_a_key():
    rng = np.random.default_rng(2)
    a = rng.integers(-2**63, 2**63, 3000, dtype=np.int64)
    for bits in range(4):
        b = a.copy()
        for i in range(len(b)):
            for k in rng.choice(64, bits, replace=False):
                b[i] ^= np.int64(np.uint64(1 << int(k)).view(np.int64))
        ra, ka = simhash.keys(a, True)
        rb, kb = simhash.keys(b, False)
        assert len(set(zip(ra.tolist(), ka.tolist())) & set(zip(rb.tolist(), kb.tolist()))) > 0
        shared = {r for r, _ in set(zip(ra.tolist(), ka.tolist())) & set(zip(rb.tolist(), kb.tolist()))}
        assert shared == set(range(len(a)))


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000, 1001)]
    random.Random(4).shuffle(edges)
    got = {r.node: r.root for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(1, 301)} == {0} and got[1001] == 1000


def test_near_duplicates_odd_input(spark):
    d = odd_docs(spark)
    c = {(r.doc_id, r.component_id) for r in simhash.cluster(d).collect()}
    assert (None, 1) in c and (2, 2) in c and (3, 2) in c and (4, 2) in c and (5, 5) in c and (6, 5) in c and (None, 2) in c
    kept = simhash.drop_near_duplicates(d)
    assert kept.columns == d.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 5, 7]
    assert simhash.drop_near_duplicates(empty_docs(spark)).count() == 0


def test_simhash_joins_pass_nothing_through_the_driver(spark, monkeypatch):
    ship(spark)
    d = spark.createDataFrame([(k, f"w{k % 5} a b c", "en", "a", 8) for k in range(40)], DOC)
    plans = []

    def noted(df, tag):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return written(df, tag)

    monkeypatch.setattr(simhash, "written", noted)
    plans.append(simhash.cluster(d)._jdf.queryExecution().executedPlan().toString())
    simhash.drop_near_duplicates(d)
    assert sum("SortMergeJoin" in p for p in plans) > 8
    assert not any("Broadcast" in p for p in plans)


# ----------------------------------------------------------------------- pii

def brute_pii(t):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        s = sum(sum(divmod(int(c) * 2, 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d)))
        if 12 <= len(d) <= 19 and s % 10 == 0:
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def test_base_spans_match_brute_force(rows):
    rng = random.Random(6)
    made = ["".join(rng.choice("ab1290.@+- ()é%") for _ in range(rng.randrange(0, 120))) for _ in range(3000)]
    made += ["4111 1111 1111 1111", "4111-1111-1111-1112", "+49 (170) 123-4567", "1.2.3.4.5.6.7.8", "a@b@c.de.f", "0255.1.1.1"]
    for t in made + [t for _, t in rows]:
        assert pii.base_spans(t) == brute_pii(t), t


def test_base_spans_are_linear():
    for t in ("a" * 300_000 + " @", "1" * 300_000, "a@" * 100_000, "1." * 100_000, "+1" + " " * 200_000, "1 " * 150_000):
        pii.base_spans(t)


def test_skip_edges_carry_labels_to_other_mentions(spark):
    ship(spark)
    said = "call +49 170 5551234 or write to jane.doe@mail.example now " + "and so on " * 50
    texts = [said + "again 01705551234 or jane.doe please", said, "nothing here", None, ""]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.find_spans(d).collect()}
    added = {(s.kind, texts[0][s.start:s.end]) for s in got[0] if not s.base}
    assert ("email", "jane.doe") in added
    assert [s for s in got[1] if not s.base] == [] and got[2] == got[3] == got[4] == []


@pytest.mark.parametrize("mentions", [1, 2, 20])
def test_labels_reach_every_mention_whatever_the_corpus_size(mentions):
    said = "write to jane.doe@mail.example now " + "and so on jane.doe please " * mentions
    g = pii.graph([(said, pii.base_spans(said))])
    counts = np.array([[1e9, 0, 0, 0, 0]])  # words that no pattern labels
    field = pii.Field({}, (counts + pii.PRIOR) / (counts.sum(axis=1, keepdims=True) + 1), np.ones((pii.LABELS, pii.LABELS)))
    best = pii.beliefs(g, field).argmax(axis=1)
    assert [said[g.start[w]:g.end[w]] for w in np.flatnonzero((best == 1) & (g.label == 0))] == ["jane.doe"] * mentions
    assert len(g.skip) == mentions + 1  # linear, not pairwise


def test_field_judges_texts_without_any_match(spark):
    ship(spark)
    alone = "ask at 4111-1111-1111-1111 please"
    texts = [alone] * 40 + ["ask at 4111-1111-1111-111 please", "ask at x4111-1111-1111-1112 please"]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    field = pii.train(d)
    field = pii.Field({pii.shape("4111-1111-1111-111"): 1}, np.array([field.unary[0], [0.1, 0, 0, 0.9, 0]]), field.pair)
    got = {r.doc_id: [(s.kind, s.base, texts[r.doc_id][s.start:s.end]) for s in r.spans]
           for r in pii.find_spans(d, field).collect()}
    assert got[40] == [("card", False, "4111-1111-1111-111")] and got[41] == []


def test_every_shape_has_counts_of_its_own(spark):
    ship(spark)
    marks = [f"{a}1{b}2{c}3" for a in "~=/^_" for b in "~=/^_\u00a7" for c in "~=/^_\u00a7"]
    words = [m * k for m in marks for k in range(1, 61)]  # long ones differ at the end only
    assert len({pii.shape(w) for w in words}) == len(words) > 4096
    assert pii.shape("a1" * 40 + "x@") != pii.shape("a1" * 40 + "x") and pii.shape("1" * 25) != pii.shape("1" * 26)
    d = spark.createDataFrame([(" ".join(words),), ("mail =1@a.example and ~1~2~3",), ("=1@a.example",)], "text string")
    field = pii.train(d)
    assert set(field.rows) == {pii.shape("=1@a.example")}
    n = len(words) + 3  # never labelled: the words above, "mail", "and" and one more
    assert field.unary[0] == pytest.approx((np.array([n, 0, 0, 0, 0]) + pii.PRIOR) / (n + 1))
    assert field.unary[1] == pytest.approx((np.array([0, 2, 0, 0, 0]) + pii.PRIOR) / 3)


def test_pii_odd_input(spark):
    assert pii.find_spans(odd_docs(spark)).count() == 10
    assert pii.find_spans(empty_docs(spark)).count() == 0


# -------------------------------------------------------------------- mixing

def brute_targets(sizes, weights=(5, 2, 1), cap=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, free, out = sum(sizes.values()), set(names), {}
    while True:
        level = left / sum(w[s] for s in free) if free else 0
        over = {s for s in free if w[s] * level > cap * sizes[s]}
        if not over:
            return {**out, **{s: w[s] * level for s in free}}
        for s in over:
            out[s] = cap * sizes[s]
            left -= out[s]
        free -= over


@pytest.mark.parametrize("seed", range(3))
def test_water_filling_matches_repeated_clamping(spark, seed):
    rng = random.Random(seed)
    sizes = {f"s{i:02d}": rng.choice([1, 5, 40, 1000, 5000]) for i in range(14)} | {None: 77}
    d = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r.source: r.target for r in mixing.targets(d).collect()}
    for s, t in brute_targets(sizes).items():
        assert got[s] == pytest.approx(t)


def test_mix_hits_the_targets(docs):
    plan = mixing.mix(docs)
    again = mixing.mix(docs)
    assert sorted(map(tuple, plan.collect()), key=repr) == sorted(map(tuple, again.collect()), key=repr)
    for r in plan.groupBy("source").agg(F.first("target").alias("t"), F.sum("taken").alias("n"),
                                        F.max(F.col("taken") - 3 * F.col("size")).alias("over")).collect():
        assert abs(r.n - r.t) <= 1 and r.over <= 0
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    taken = {r.doc_id: r.n for r in out.groupBy("doc_id").agg(F.sum(F.size(F.split(F.trim("text"), r"[\x20\x09-\x0D]+"))).alias("n")).collect()}
    assert taken == {r.doc_id: r.taken for r in plan.collect() if r.taken}


def test_mix_of_rows_that_share_ids(spark, docs):
    """A third of the ids are null, others repeat, texts are short: the cut falls among
    rows of one id, and the written documents have the words that the plan took."""
    d = docs.select(F.when(F.col("doc_id") % 3 > 0, F.col("doc_id") % 7).alias("doc_id"),
                    F.array_join(F.slice(F.split("text", " "), 1, 30), " ").alias("text"), "lang", "source", "n_chars")
    plan = mixing.mix(d)
    for r in plan.groupBy("source").agg(F.first("target").alias("t"), F.sum("taken").alias("n"),
                                        F.max(F.col("taken") - 3 * F.col("size")).alias("over")).collect():
        assert abs(r.n - r.t) <= 1 and r.over <= 0
    words = F.sum(F.size(F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")))
    out = {r.source: r.n for r in mixing.mixed_documents(d).groupBy("source").agg(words.alias("n")).collect()}
    assert out == {r.source: r.n for r in plan.groupBy("source").agg(F.sum("taken").alias("n")).collect() if r.n}


def test_mixing_odd_input(spark):
    got = mixing.mix(odd_docs(spark)).collect()
    assert len(got) == 10 and all(r.taken == 0 for r in got if r.size == 0)
    assert mixing.mixed_documents(odd_docs(spark)).columns == odd_docs(spark).columns
    assert mixing.mix(empty_docs(spark)).count() == 0 and mixing.mixed_documents(empty_docs(spark)).count() == 0


# ----------------------------------------------------------------- substring

def brute_repeats(rows, window):
    seen, out = {}, []
    for i, t in rows:
        w = WORDS.findall(t or "")
        gone, mine = set(), []
        for k in range(len(w) - window + 1):
            g = tuple(w[k:k + window])
            if g in seen:
                gone |= set(range(k, k + window))
            else:
                seen[g] = i
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


@pytest.mark.parametrize("window", [1, 3, 7, 20])
def test_repeats_match_brute_force(spark, window):
    ship(spark)
    rng = random.Random(window)
    pool = [" ".join(rng.choice("abcdefgh") for _ in range(rng.choice([4, 19, 20, 25, 60]))) for _ in range(12)]
    rows = [(i, "  ".join(rng.choice(pool) if rng.random() < .6 else rng.choice("uvwxyz") * 2 for _ in range(rng.randrange(0, 12))))
            for i in range(80)] + [(80, "q " * 70), (81, "")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.n_words, sum(s.end - s.start for s in r.spans), r.kept_text)
                 for r in substring.remove_repeats(d, window).collect())
    assert got == brute_repeats(rows, window)


def test_rows_that_share_an_id_are_documents_of_their_own(spark):
    ship(spark)
    rng = random.Random(9)
    pool = [" ".join(rng.choice("abcdefgh") for _ in range(rng.choice([19, 20, 25, 60]))) for _ in range(8)]
    ids = [None, 7, 7, 7, 3, -(2**63), 11]
    rows = [(rng.choice(ids), "  ".join(rng.choice(pool) if rng.random() < .6 else rng.choice("uvwxyz") * 2
                                        for _ in range(rng.randrange(0, 8)))) for _ in range(60)] + [(7, pool[0]), (7, pool[0])]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    got = [(r.doc_id, r.n_words, sum(s.end - s.start for s in r.spans), r.kept_text) for r in substring.remove_repeats(d).collect()]
    assert sorted(got, key=repr) == sorted(brute_repeats(ordered, 20), key=repr)


def test_repeats_odd_input(spark):
    got = substring.remove_repeats(odd_docs(spark)).collect()
    assert len(got) == 10
    by = {r.doc_id: r for r in got if r.doc_id in (5, 6)}
    assert by[6].kept_text == "" and len(by[5].kept_text.split()) < 1100
    assert substring.remove_repeats(empty_docs(spark)).count() == 0
