"""One registered query per operator, over its whole table, and the SQL of
those that SQL can express.

Queries derive the digest columns of their contracts from the operators'
outputs.  Not expressible in DuckDB SQL: op1 (greedy assignment of slots), op3
(expectation-maximisation), op4 (tokenizer and coder), op7 (XXH64, components),
op8 (message passing) and op11 (least-cost edits); tests hold them against brute
force.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import (
    conversation_repair, decontaminate, hard_negatives, line_dedup, mixing, pii, quality, sharding, simhash, substring,
    token_files, url_rules, warc,
)
from strata.llm.common import ship, table


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """24 shards of nearly equal bytes."""
    placed = sharding.shard_documents(table(spark, sf_dir, "documents"), shards=24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "map_version")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_items(docs, table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.size("hits") > 0).alias("contaminated"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept", "posterior")


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_documents(table(spark, sf_dir, "documents"))


def op5_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's conditional capture, resolved."""
    done = warc.resolve(warc.captures(table(spark, sf_dir, "pages")))
    pairs = F.transform(F.array_sort(F.map_keys("headers")), lambda k: F.concat(k, F.lit("="), F.col("headers")[k]))
    return done.select("record_id", F.expr("record_id div 2").alias("page_id"), "url_key", "base_id", "matched", "status",
                       F.array_join(pairs, ";").alias("headers"), F.md5(F.col("body").cast("binary")).alias("body_md5"))


def op6_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = url_rules.judge(table(spark, sf_dir, "pages"))
    return j.select("page_id", "host", "path", "rule", "verdict", F.array_join("mined", " ").alias("mined"), "confidence")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = simhash.cluster(table(spark, sf_dir, "documents"))
    return c.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_spans(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])
    named = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    of = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")
    counts = [of(k).alias("n_" + k) for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(named(base), 256).alias("base_sha256"), named(F.col("spans")).alias("spans"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = mixing.mix(table(spark, sf_dir, "documents"))
    return m.select("doc_id", "size", "source_size", "target", "taken")


def op10_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = substring.remove_repeats(table(spark, sf_dir, "documents"))
    n_removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return r.select("doc_id", "n_words", n_removed.alias("n_removed"), F.sha2("kept_text", 256).alias("kept_sha256"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repaired_conversations(table(spark, sf_dir, "conversations"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine_embeddings(table(spark, sf_dir, "embeddings")).drop("anchor")


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = [op1_sharding, op2_decontamination, op3_quality_rules, op4_token_files, op5_warc_revisits, op6_url_rules,
           op7_simhash, op8_pii, op9_mixing, op10_substring, op11_conversation_repair, op12_hard_negatives,
           op13_line_dedup, pipeline]

_OP2_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
il AS (SELECT item_id, w, least(10, len(w)) AS m FROM i WHERE len(w) > 0),
ik AS (SELECT item_id, w, m, unnest(range(1, len(w) - m + 2)) AS k FROM il),
iw AS (SELECT DISTINCT item_id, m, md5(array_to_string(w[k:k + m - 1], ' ')) AS g FROM ik),
dm AS (SELECT rid, w, m FROM d, (SELECT DISTINCT m FROM il) WHERE len(w) >= m),
dk AS (SELECT rid, w, m, unnest(range(1, len(w) - m + 2)) AS k FROM dm),
hit AS (SELECT dk.rid, dk.k, dk.m, iw.item_id FROM dk JOIN iw ON dk.m = iw.m AND md5(array_to_string(dk.w[k:k + dk.m - 1], ' ')) = iw.g),
cov AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(k, k + m)) AS p FROM hit) GROUP BY rid),
its AS (SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
        FROM (SELECT DISTINCT rid, item_id FROM hit) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cov USING (rid) LEFT JOIN its USING (rid)
"""

_OP5_SQL = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS h, html, page_id % 1000 AS day,
    regexp_replace(regexp_replace(trim(url), '(?s)#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS rest,
    '"' || substr(md5(coalesce(html, '')), 1, 12) || '"' AS tag FROM pages),
u AS (
  SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(rest, '(?s)^([^/?]*)', 1)), '^www\.', ''), ':(80|443)$', '')
    || regexp_replace(regexp_extract(rest, '(?s)^[^/?]*([^?]*)', 1), '/$', '') AS place,
    list_sort(list_filter(string_split(regexp_extract(rest, '(?s)\?(.*)$', 1), '&'),
      lambda q: q <> '' AND lower(string_split(q, '=')[1]) NOT IN
        ('ref', 'utm_source', 'utm_medium', 'utm_campaign', 'utm_term', 'utm_content', 'fbclid', 'gclid'))) AS q FROM p),
k AS (SELECT *, place || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END AS url_key FROM u),
r AS (
  SELECT v.page_id, v.url_key, v.tag, v.day, v.h, max(f.page_id) AS base FROM k v LEFT JOIN k f
    ON v.url_key = f.url_key AND f.page_id * 10 < v.page_id * 10 + 10005 GROUP BY ALL),
j AS (
  SELECT r.*, f.html AS body, f.tag AS base_tag, f.day AS base_day, octet_length(encode(f.h)) AS bytes,
    f.page_id IS NOT NULL AND CASE WHEN r.page_id % 5 = 0 THEN f.day = r.day
      WHEN r.page_id % 7 = 0 THEN '"changed"' = f.tag ELSE r.tag = f.tag END AS ok
  FROM r LEFT JOIN k f ON f.page_id = r.base)
SELECT page_id * 2 + 1 AS record_id, page_id, url_key, base * 2 AS base_id, ok AS matched,
  CASE WHEN ok THEN 200 END AS status,
  CASE WHEN ok THEN 'cache-control=max-age=600;content-length=' || bytes || ';content-type=text/html;date=later;etag='
    || CASE WHEN page_id % 5 = 0 THEN base_tag ELSE 'W/' || tag END || ';last-modified=day ' || base_day END AS headers,
  CASE WHEN ok THEN md5(body) END AS body_md5
FROM j
"""

_URL_PARTS_SQL = r"""
a AS (
  SELECT page_id, coalesce(url, '') AS url,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^?#]*\?([^#]*)', 1) AS query FROM pages),
t AS (
  SELECT page_id, host, path,
    list_sort(list_distinct(list_filter(list_concat(list_concat(
      list_transform(string_split(host, '.'), lambda x: 'host=' || regexp_replace(x, '[0-9]+', '0', 'g')),
      list_transform(string_split(path, '/'), lambda x: 'path=' || regexp_replace(x, '[0-9]+', '0', 'g'))),
      list_transform(string_split(query, '&'), lambda x: 'query=' || regexp_replace(string_split(x, '=')[1], '[0-9]+', '0', 'g'))),
      lambda x: x NOT IN ('host=', 'path=', 'query=')))) AS tokens FROM a),
g AS (
  SELECT *, CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule FROM t),
v AS (SELECT *, CASE rule WHEN 'net/' THEN 'block' WHEN 'example.com/de/' THEN 'block' WHEN 'example.net/en/' THEN 'allow'
  WHEN 'org/fr/' THEN 'allow' END AS given, row_number() OVER () AS rid FROM g)
"""

_OP6_SQL = "WITH " + _URL_PARTS_SQL + r""",
l AS (SELECT rid, list_slice(tokens, 1, 24) AS tokens, given FROM v WHERE given IS NOT NULL AND len(tokens) > 0),
x AS (SELECT rid, given, unnest(tokens) AS k FROM l),
s AS (
  SELECT rid, given, [k] AS c FROM x
  UNION ALL SELECT p.rid, p.given, [p.k, q.k] FROM x p JOIN x q ON p.rid = q.rid AND p.k < q.k
  UNION ALL SELECT p.rid, p.given, [p.k, q.k, r.k] FROM x p JOIN x q ON p.rid = q.rid AND p.k < q.k
    JOIN x r ON q.rid = r.rid AND q.k < r.k),
n AS (SELECT ceil(0.005 * count(*)) AS least FROM l),
al AS (SELECT c, count(*) AS n FROM s GROUP BY c),
m AS (
  SELECT c, given, count(*) AS support, count(*) / any_value(al.n) AS confidence FROM s JOIN al USING (c)
  GROUP BY c, given HAVING count(*) >= (SELECT least FROM n) AND count(*) / any_value(al.n) >= 0.9),
h AS (
  SELECT v.rid, m.*, row_number() OVER (PARTITION BY v.rid ORDER BY confidence DESC, support DESC,
    (m.given = 'block') DESC, c DESC) AS place
  FROM v JOIN m ON len(list_intersect(v.tokens, m.c)) = len(m.c) WHERE v.given IS NULL)
SELECT page_id, host, path, rule, coalesce(v.given, h.given, 'allow') AS verdict,
  array_to_string(h.c, ' ') AS mined, h.confidence
FROM v LEFT JOIN h ON v.rid = h.rid AND h.place = 1
"""

_OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS ord FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w FROM d GROUP BY source),
c AS (SELECT *, 3 * source_size AS cap, 3 * source_size / w AS tight, CAST(sum(source_size) OVER () AS BIGINT) AS total,
  CAST(sum(w) OVER () AS BIGINT) AS all_w FROM s),
f AS (
  SELECT c.*, (total - coalesce((SELECT CAST(sum(o.cap) AS BIGINT) FROM c o WHERE o.tight < c.tight), 0))
    / (all_w - coalesce((SELECT CAST(sum(o.w) AS BIGINT) FROM c o WHERE o.tight < c.tight), 0)) >= tight AS clamped FROM c),
lv AS (SELECT any_value(total) - coalesce(CAST(sum(cap) FILTER (clamped) AS BIGINT), 0) AS kept,
  any_value(all_w) - coalesce(CAST(sum(w) FILTER (clamped) AS BIGINT), 0) AS kept_w FROM f),
t AS (SELECT source, source_size, CASE WHEN clamped THEN CAST(cap AS DOUBLE)
  ELSE w * (CASE WHEN kept_w > 0 THEN kept / kept_w ELSE 0 END) END AS target FROM f, lv),
q AS (SELECT *, CAST(round(target) AS BIGINT) AS words,
  CASE WHEN source_size > 0 THEN CAST(round(target) AS BIGINT) // source_size ELSE 0 END AS whole FROM t),
r AS (SELECT d.doc_id, d.size, q.source_size, q.target, q.whole, q.words - q.whole * q.source_size AS want,
  coalesce(CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.ord, d.doc_id, d.size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS before
  FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source)
SELECT doc_id, size, source_size, target,
  CAST(whole * size + greatest(0, least(size, want - before)) AS BIGINT) AS taken FROM r
"""

_OP10_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
k AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS k FROM d WHERE len(w) >= 20),
g AS (SELECT doc_id, k, md5(array_to_string(w[k:k + 19], ' ')) AS g FROM k),
dup AS (SELECT doc_id, k FROM (SELECT doc_id, k, row_number() OVER (PARTITION BY g ORDER BY doc_id, k) AS n FROM g) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(k, k + 20)) AS p FROM dup),
kept AS (
  SELECT x.doc_id, string_agg(x.word, ' ' ORDER BY x.p) AS t, count(*) AS n
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d) x
  LEFT JOIN gone USING (doc_id, p) WHERE gone.p IS NULL GROUP BY x.doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

_OP12_SQL = r"""
WITH e AS (
  SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.rid AS a, a.vec_id AS anchor_id, r.vec_id, r.rid, r.label = a.label AS same,
    CAST(list_dot_product(a.v, r.v) AS BIGINT) AS score
  FROM e a JOIN e r ON a.rid <> r.rid AND len(a.v) = len(r.v) WHERE a.vec_id % 50 = 0),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id NULLS LAST, rid) AS k
  FROM s WHERE same) WHERE k <= 5),
n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, p.score AS positive_score, s.vec_id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.a, p.rid ORDER BY s.score DESC, s.vec_id NULLS LAST, s.rid) AS place
  FROM p JOIN s ON p.a = s.a AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM n WHERE place <= 3
"""

_OP13_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
x AS (SELECT rid, doc_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS p FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM x),
h AS (SELECT key, max(doc_id) AS top FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT rid) >= 3),
s AS (SELECT k.*, h.key IS NOT NULL AND k.doc_id IS DISTINCT FROM h.top AS gone FROM k LEFT JOIN h ON k.key = h.key)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (NOT gone), '')) AS kept_sha256
FROM s GROUP BY rid
"""

SQL = {"op2_decontamination": _OP2_SQL, "op5_warc_revisits": _OP5_SQL, "op6_url_rules": _OP6_SQL,
       "op9_mixing": _OP9_SQL, "op10_substring": _OP10_SQL,
       "op12_hard_negatives": _OP12_SQL, "op13_line_dedup": _OP13_SQL}


def _shipped(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return f(spark, sf_dir)

    run.__doc__ = f.__doc__
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: _shipped(f) for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
