"""Not-modified revisits of a web archive.

A crawler that asks "has this changed?" and hears 304 stores a *revisit*: a
record without a body.  Resolving it is an as-of join: the latest earlier full
response of the same canonical URL, if its validators agree, gives the body,
and the headers that a 304 may update are merged over the stored ones.

The join is split by time, so that one URL with a third of all captures is not
one task's work: inside each (URL, time bucket) a window carries the last full
response forward, and only revisits that find none there look at the latest
full response of the URL's earlier buckets (one row per bucket).

Records have ``record_id, url, at`` (capture order: a timestamp or whole number),
``kind`` (``response`` or ``revisit``), ``status``, ``headers`` (map of
lower-case names), ``digest`` (payload digest, may be null) and ``body``.

Every record is numbered once, in a written table, and joined by that number:
record ids may repeat or be null.

Defined cases: records without URL or time are kept and never matched; of
responses at one time the one with the largest id counts as the later (null ids
are the smallest, then the earlier row); a response at the very time of a revisit
is not earlier; rows that repeat, or share an id, resolve one by one, each by its
own URL and time; null headers are empty; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import written

BUCKETS = 64
# Header fields that a stored response keeps when a 304 arrives
# (RFC 9111, 3.2: what describes the stored body or the connection).
NOT_UPDATED = ("content-encoding", "content-length", "content-range", "content-type", "transfer-encoding",
               "connection", "keep-alive", "proxy-authenticate", "proxy-authentication-info",
               "proxy-connection", "te", "trailer", "upgrade")
# Query names that only track where a visit came from.
TRACKING = ("ref", "utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "fbclid", "gclid")


def canonical_url(url: Column) -> Column:
    """Scheme dropped, host in lower case without ``www.`` or default port,
    fragment and tracking parameters dropped, the others sorted, one trailing
    slash dropped; null stays null."""
    rest = F.regexp_replace(F.trim(url), "(?s)#.*$", "")
    rest = F.regexp_replace(rest, "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    authority = F.lower(F.regexp_extract(rest, r"(?s)^([^/?]*)", 1))
    authority = F.regexp_replace(F.regexp_replace(authority, r"^www\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"(?s)^[^/?]*([^?]*)", 1), "/$", "")
    query = F.split(F.regexp_extract(rest, r"(?s)\?(.*)$", 1), "&")
    kept = F.array_sort(F.filter(query, lambda q: (q != "") & ~F.lower(F.substring_index(q, "=", 1)).isin(*TRACKING)))
    return F.when(url.isNotNull(), F.concat(
        authority, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(F.lit(""))))


def parse_headers(block: Column) -> Column:
    """Header lines as a map of lower-case names; repeated fields are joined by
    a comma, lines without a colon are left out."""
    lines = F.filter(F.split(F.coalesce(block, F.lit("")), r"\r?\n"), lambda x: F.locate(":", x) > 1)
    name = lambda x: F.lower(F.trim(F.substring_index(x, ":", 1)))
    value = lambda x: F.trim(F.regexp_replace(x, r"^[^:]*:", ""))
    names = F.array_distinct(F.transform(lines, name))
    return F.map_from_arrays(names, F.transform(names, lambda n: F.array_join(
        F.transform(F.filter(lines, lambda x: name(x) == n), value), ", ")))


def merge_headers(stored: Column, fresh: Column) -> Column:
    """The stored headers, updated by the permitted ones of the 304."""
    allowed = F.map_filter(fresh, lambda k, _: ~F.lower(k).isin(*NOT_UPDATED))
    kept = F.map_filter(stored, lambda k, _: ~F.array_contains(F.map_keys(allowed), k))
    return F.map_concat(kept, allowed)


def validators_agree(revisit: str, base: str) -> Column:
    """Payload digests where both have one, else entity tags (weak comparison),
    else Last-Modified; without a common validator they do not agree."""
    tag = lambda side: F.regexp_replace(F.try_element_at(f"{side}.headers", F.lit("etag")), "^W/", "")
    date = lambda side: F.try_element_at(f"{side}.headers", F.lit("last-modified"))
    pairs = [(F.col(f"{revisit}.digest"), F.col(f"{base}.digest")), (tag(revisit), tag(base)), (date(revisit), date(base))]
    out = F.lit(False)
    for a, b in reversed(pairs):
        out = F.when(a.isNotNull() & b.isNotNull(), a == b).otherwise(out)
    return out


def resolve(records: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """One row per revisit: ``record_id, url_key, base_id`` (the latest earlier
    full response), ``matched`` (its validators agree), ``status``, ``headers``
    and ``body`` of the resolved record (null where not matched)."""
    empty = F.create_map().cast("map<string,string>")
    at = F.col("at")
    at = F.unix_micros(at.cast("timestamp")) if dict(records.dtypes)["at"].startswith("timestamp") else at.cast("long")
    r = records.select("record_id", F.monotonically_increasing_id().alias("rec"), canonical_url(F.col("url")).alias("url_key"), at.alias("at"),
                       "kind", "status", F.coalesce(F.col("headers"), empty).alias("headers"), "digest", "body")
    r = written(r, "warc-records")
    full = (F.col("kind") == "response") & (F.col("status") == 200)
    # the as-of join moves ids and validators; bodies join at the end, by id
    light = r.select("record_id", "rec", "url_key", "at", full.alias("full"), (F.col("kind") == "revisit").alias("revisit"))
    light = light.where("(full or revisit) and url_key is not null and at is not null")
    # cuts at the times' quantiles: buckets of about equally many captures
    cuts = light.agg(F.percentile_approx("at", [i / buckets for i in range(1, buckets)], 10_000)).first()[0] or []
    cuts = sorted(set(cuts))
    bucket = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= F.col("at"))) if cuts else F.lit(0)
    light = written(light.withColumn("bucket", bucket.cast("int")), "warc-times")
    base = F.when(F.col("full"), F.struct("at", "record_id", "rec"))
    inside = Window.partitionBy("url_key", "bucket").orderBy("at").rangeBetween(Window.unboundedPreceding, -1)
    near = light.withColumn("near", F.max(base).over(inside)).where("revisit")
    # the last full response up to the end of each bucket of a URL with revisits
    tops = light.groupBy("url_key", "bucket").agg(F.max(base).alias("top"))
    before = Window.partitionBy("url_key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    tops = written(tops.withColumn("far", F.max("top").over(before)).where("far is not null")
                   .select("url_key", "bucket", "far"), "warc-tops")
    found = near.join(tops, ["url_key", "bucket"], "left").select(
        "rec", F.coalesce("near", "far").alias("found")).select(
        "rec", F.col("found.record_id").alias("base_id"), F.col("found.rec").alias("base_rec"))
    rev = r.where("kind = 'revisit'").join(written(found, "warc-bases"), "rec", "left")
    # a revisit without a base has a number of its own, so that these do not meet in one task
    rev = rev.withColumn("base_rec", F.coalesce("base_rec", -F.col("rec") - 1))
    bases = r.where(full).select(F.col("rec").alias("base_rec"), F.struct("headers", "digest", "status", "body").alias("base"))
    both = rev.withColumn("own", F.struct("headers", "digest")).join(bases, "base_rec", "left")
    ok = F.coalesce(F.col("base").isNotNull() & validators_agree("own", "base"), F.lit(False))
    return both.select("record_id", "url_key", "base_id", ok.alias("matched"),
                       F.when(ok, F.col("base.status")).alias("status"),
                       F.when(ok, merge_headers(F.col("base.headers"), F.col("headers"))).alias("headers"),
                       F.when(ok, F.col("base.body")).alias("body"))


def captures(pages: DataFrame) -> DataFrame:
    """An archive derived from a table of pages, for tests and the registered
    query: every page was captured twice, first in full (its capture order is ten
    times the page id) and a while later as an answer to a conditional request.

    The answers carry an entity tag made of the page; where the page id is a
    multiple of 7 the resource had changed since, so the tags differ; where it
    is a multiple of 5 only a Last-Modified date was given."""
    page = F.col("page_id").cast("long")
    tag = F.concat(F.lit('"'), F.substring(F.md5(F.coalesce("html", F.lit("")).cast("binary")), 1, 12), F.lit('"'))
    date = F.concat(F.lit("day "), (page % 1000).cast("string"))
    first = pages.select(
        (page * 2).alias("record_id"), "url", (page * 10).alias("at"), F.lit("response").alias("kind"), F.lit(200).alias("status"),
        parse_headers(F.concat(F.lit("Content-Type: text/html\r\nContent-Length: "),
                               F.coalesce(F.octet_length("html"), F.lit(0)).cast("string"),
                               F.lit("\r\nETag: "), tag, F.lit("\r\nLast-Modified: "), date,
                               F.lit("\r\nCache-Control: max-age=60\r\n"))).alias("headers"),
        F.lit(None).cast("string").alias("digest"), F.col("html").alias("body"))
    own = F.when(page % 7 == 0, F.lit('"changed"')).otherwise(F.concat(F.lit("W/"), tag))
    again = pages.select(
        (page * 2 + 1).alias("record_id"), "url", (page * 10 + 10005).alias("at"), F.lit("revisit").alias("kind"),
        F.lit(304).alias("status"),
        parse_headers(F.concat(F.when(page % 5 == 0, F.concat(F.lit("Last-Modified: "), date))
                               .otherwise(F.concat(F.lit("ETag: "), own)),
                               F.lit("\r\nCache-Control: max-age=600\r\nContent-Length: 0\r\nDate: later\r\n"))).alias("headers"),
        F.lit(None).cast("string").alias("digest"), F.lit(None).cast("string").alias("body"))
    return first.unionByName(again)
