"""URL filtering by mined association rules.

Given rules (``host/path`` prefixes) decide the URLs that they fit.  Those
decided URLs are also the labelled examples: Spark's FP-growth mines token
combinations over them, each transaction being the tokens of one URL plus its
label.  A combination becomes a rule when it is frequent together with one
label (support) and that label follows it nearly always (confidence).  All
other URLs are judged by the mined rules that match them, found through an
inverted index from each rule's rarest token; without a match they are allowed.

Mining sees every token of a labelled URL and combinations of any length.  What
bounds it is the support: a token that is rarer than that with every label is in
no rule, and tokens that always occur together are mined as one and written out
again afterwards.  Combinations of up to ``ALL_UPTO`` tokens are all kept; a
longer one is kept when its confidence is above that of every combination that
it extends, as otherwise a shorter rule that matches wherever it does is at
least as good.  The rules reach the rows as one map value, so judging needs no
shuffle.

Defined cases: a null URL or one without ``://`` has an empty host and path
and no tokens, and is allowed; repeated rows are judged alike; with nothing
labelled no rule is mined; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import written

# The given rules, (verdict, host, path prefix).
GIVEN = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
MIN_SUPPORT = 0.005
MIN_CONFIDENCE = 0.9
ALL_UPTO = 3
LABEL = "label="


def host(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def tokens(url: Column) -> Column:
    """Sorted distinct tokens: host labels, path segments and query names, with
    runs of digits as ``0``."""
    digits = lambda c: F.regexp_replace(c, "[0-9]+", "0")
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    named = F.transform(F.split(query, "&"), lambda x: F.concat(F.lit("query="), digits(F.substring_index(x, "=", 1))))
    labels = F.transform(F.split(host(url), r"\."), lambda x: F.concat(F.lit("host="), digits(x)))
    parts = F.transform(F.split(path(url), "/"), lambda x: F.concat(F.lit("path="), digits(x)))
    every = F.concat(labels, parts, named)
    return F.array_sort(F.array_distinct(F.filter(every, lambda x: ~x.isin("host=", "path=", "query="))))


def given_rule(given: Sequence[tuple[str, str, str]] = GIVEN) -> tuple[Column, Column]:
    """``(rule, verdict)`` of the longest given rule that fits ``host, path``."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(given, key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == h) | F.col("host").endswith("." + h)) & F.col("path").startswith(p)
        rule = F.when(fits, F.lit(h + p)).otherwise(rule)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """``tokens`` (sorted), ``label``, ``support`` (URLs with both) and
    ``confidence`` of the rules mined from ``tokens, label`` rows."""
    rows = written(labelled.where(F.size("tokens") > 0).select("tokens", "label"), "url-labelled")
    least = F.ceil(F.lit(min_support) * rows.count())
    frequent, groups = _folded(rows, least)
    known = F.array_intersect("tokens", frequent.scalar())
    heads = groups.agg(F.map_from_entries(F.collect_list(F.struct("head", "members"))).alias("m")).scalar()
    items = rows.select(known.alias("tokens"), "label", F.map_keys(heads).alias("heads")).select(F.concat(
        F.coalesce(F.array_intersect("tokens", "heads"), F.array().cast("array<string>")),
        F.array(F.concat(F.lit(LABEL), F.col("label")))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(items)
    found = model.freqItemsets
    is_label = lambda x: x.startswith(LABEL)
    found = written(found.select(F.array_sort(F.filter("items", lambda x: ~is_label(x))).alias("tokens"),
                                 F.get(F.filter("items", is_label), F.lit(0)).alias("label"), "freq")
                    .where(F.size("tokens") >= 1), "url-itemsets")
    alone = found.where("label is null").select("tokens", F.col("freq").alias("all"))
    both = found.where("label is not null")
    rules = (both.join(alone, "tokens").withColumn("confidence", F.col("freq") / F.col("all"))
             .where(F.col("confidence") >= min_confidence)
             .select("tokens", F.expr(f"substring(label, {len(LABEL) + 1})").alias("label"),
                     F.col("freq").alias("support"), "confidence"))
    return _unfolded(_gainful(rules), heads)


def _folded(rows: DataFrame, least: Column) -> tuple[DataFrame, DataFrame]:
    """The tokens that reach the support with some label (one row, an array),
    and ``head, members``: tokens that occur in the same URLs, under the first."""
    each = rows.select("tokens", "label", F.explode("tokens").alias("token"))
    counts = each.groupBy("token", "label").agg(F.count(F.lit(1)).alias("n")).groupBy("token").agg(
        F.max("n").alias("most"), F.sum("n").alias("n")).where(F.col("most") >= least)
    counts = written(counts.select("token", "n"), "url-tokens")
    frequent = counts.agg(F.collect_list("token").alias("f"))
    sizes = counts.agg(F.map_from_entries(F.collect_list(F.struct("token", "n"))).alias("m"))
    # pairs of equally frequent tokens; they always occur together if the pair is as frequent
    near = rows.select(F.array_intersect("tokens", frequent.scalar()).alias("tokens")).withColumn("sizes", sizes.scalar())
    near = near.select("tokens", "sizes", F.explode("tokens").alias("token"))
    near = near.select("token", F.try_element_at("sizes", F.col("token")).alias("n"), F.explode(F.filter(
        "tokens", lambda t: (t <= F.col("token")) & (F.try_element_at("sizes", t) == F.try_element_at("sizes", F.col("token"))))).alias("head"))
    same = near.groupBy("token", "n", "head").agg(F.count(F.lit(1)).alias("both")).where("both = n")
    heads = same.groupBy("token").agg(F.min("head").alias("head"))
    return frequent, heads.groupBy("head").agg(F.array_sort(F.collect_list("token")).alias("members"))


def _gainful(rules: DataFrame) -> DataFrame:
    """Without the long combinations that one token less makes no less sure."""
    rules = written(rules, "url-combinations")
    parts = rules.where(F.size("tokens") > ALL_UPTO).select(F.col("tokens").alias("whole"), "label", F.col("confidence").alias("own"),
                                                            F.explode("tokens").alias("t"))
    parts = parts.select("whole", "label", "own", F.array_remove("whole", F.col("t")).alias("tokens"))
    beaten = parts.join(rules, ["tokens", "label"]).where("confidence >= own").select(F.col("whole").alias("tokens"), "label").distinct()
    return rules.join(beaten, ["tokens", "label"], "left_anti")


def _unfolded(rules: DataFrame, members: Column) -> DataFrame:
    """Rules over heads written out: one member for each head, and also several
    where that makes no more than ``ALL_UPTO`` tokens."""
    empty = F.array().cast("array<array<string>>")
    one = lambda g: F.transform(g, lambda t: F.array(t))
    after = lambda g, t: F.filter(g, lambda u: u > t)
    two = lambda g: F.flatten(F.transform(g, lambda t: F.transform(after(g, t), lambda u: F.array(t, u))))
    three = lambda g: F.flatten(F.transform(g, lambda t: F.flatten(F.transform(
        after(g, t), lambda u: F.transform(after(g, u), lambda v: F.array(t, u, v))))))
    heads = F.size("tokens")
    some = lambda g: F.concat(one(g), F.when(heads < ALL_UPTO, two(g)).otherwise(empty),
                              F.when(heads < ALL_UPTO - 1, three(g)).otherwise(empty))
    every = F.aggregate(F.transform("tokens", lambda t: some(F.try_element_at("members", t))),
                        F.array(F.array().cast("array<string>")),
                        lambda got, g: F.flatten(F.transform(got, lambda a: F.transform(g, lambda x: F.concat(a, x)))))
    rules = rules.withColumn("members", members)
    rules = rules.select(F.explode(every).alias("tokens"), "label", "support", "confidence", heads.alias("heads"))
    return rules.where(F.size("tokens") <= F.greatest(F.col("heads"), F.lit(ALL_UPTO))).select(
        F.array_sort("tokens").alias("tokens"), "label", "support", "confidence")


def index(rules: DataFrame) -> DataFrame:
    """``token, rules``: every rule under its rarest token (by the rules that
    hold it; ties by name)."""
    uses = rules.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("uses"))
    each = rules.withColumn("token", F.explode("tokens")).join(uses, "token")
    rarest = each.groupBy("tokens", "label", "support", "confidence").agg(
        F.min(F.struct("uses", "token")).alias("m"))
    rule = F.struct("confidence", "support", (F.col("label") == "block").cast("int").alias("block"), "tokens")
    return rarest.groupBy(F.col("m.token").alias("token")).agg(F.collect_list(rule).alias("rules"))


def judge(pages: DataFrame, given: Sequence[tuple[str, str, str]] = GIVEN,
          min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """``page_id, host, path, rule, verdict, mined, confidence``: ``mined`` is
    the matching mined rule of highest confidence, then support, then *block*
    (null where a given rule decides or none matches)."""
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), host(F.col("url")).alias("host"),
                     path(F.col("url")).alias("path"), tokens(F.col("url")).alias("tokens"))
    rule, verdict = given_rule(given)
    p = p.withColumn("rule", rule).withColumn("given", verdict)
    rules = written(mine(p.where("given is not null").select("tokens", F.col("given").alias("label")),
                         min_support, min_confidence), "url-rules")
    lookup = index(rules).agg(F.map_from_entries(F.collect_list(F.struct("token", "rules"))).alias("m"))
    p = p.withColumn("lookup", lookup.scalar())
    near = F.flatten(F.transform("tokens", lambda t: F.coalesce(
        F.try_element_at("lookup", t), F.array().cast("array<struct<confidence:double,support:bigint,block:int,tokens:array<string>>>"))))
    hits = F.filter(near, lambda r: F.size(F.array_except(r["tokens"], F.col("tokens"))) == 0)
    p = p.select("page_id", "host", "path", "rule", "given",
                 F.when(F.col("given").isNull(), F.array_max(hits)).alias("best"))
    return p.select("page_id", "host", "path", "rule",
                    F.coalesce("given", F.when(F.col("best.block") == 1, "block").otherwise("allow")).alias("verdict"),
                    F.col("best.tokens").alias("mined"), F.col("best.confidence").alias("confidence"))
