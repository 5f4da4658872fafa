"""Document quality by weak supervision.

Rules look at a document's counts and vote *good*, vote *bad* or abstain.  No
rule decides alone: expectation-maximisation estimates, without labels, how
each rule votes on good and on bad documents, and a document is kept when its
posterior probability of being good reaches one half.

The estimation needs only how often each combination of votes occurs: one
aggregate of at most ``3 ** rules`` rows, whatever the corpus, which the driver
iterates over.  All that touches documents is built-in column expressions; the
text is read once, and what is kept between the steps is a row of counts per
document.

Defined cases: null or blank text has no words and fails the base rule;
repeated rows are judged one by one and alike; an empty table gives an empty
result; repeats are found by 64-bit hashes of the windows inside one text;
further columns are carried by ``filter_quality`` and ignored elsewhere.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import SPACE_CHARS, free_name, quoted, words, written

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
REPEAT_WINDOW = 8  # a power of two: windows are hashed by halves
ROUNDS = 100
KEEP_FROM = 0.5

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_lines", "n_upper", "n_punct", "n_distinct", "n_ended"]


def with_counts(docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` but ``text``, plus the count columns.

    Every step carries only what the later ones need, as each array is copied
    from one projection to the next."""
    w = REPEAT_WINDOW
    keys = [quoted(c) for c in docs.columns if c != "text"]
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.btrim(x, F.lit(SPACE_CHARS))) > 0)

    def matched(pattern: str) -> Column:
        return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("long")

    d = docs.select(*keys, words(F.col("text")).alias("ws"), lines.alias("lines"),
                    matched(r"[#*$%&|<>]+").alias("n_symbols"), matched(r"[A-Z]+").alias("n_upper"),
                    matched(r"[!-/:-@\[-`{-~]+").alias("n_punct"))
    done = ["n_symbols", "n_upper", "n_punct"]
    n = F.size("ws")
    ended = F.filter("lines", lambda x: F.rtrim(x).rlike(r"[.!?:;\"')\]]$"))
    d = d.select(
        *keys, *done, n.cast("long").alias("n_words"),
        F.length(F.concat_ws("", "ws")).cast("long").alias("word_chars"),
        F.size(F.array_distinct("ws")).cast("long").alias("n_distinct"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(ended).cast("long").alias("n_ended"),
        F.when(n >= w, F.transform("ws", lambda x: F.xxhash64(x))).alias("h"))
    done += ["n_words", "word_chars", "n_distinct", "n_lines", "n_dup_lines", "n_ended"]
    # hashes of windows of 1, 2, 4 and 8 words, each made of two halves; a text
    # without a repeated window of 4 has none of 8, so most stop there

    def doubled(half: int) -> Column:
        m = F.size("h") - half
        return F.zip_with(F.slice("h", F.lit(1), m), F.slice("h", F.lit(half + 1), m), lambda a, b: F.xxhash64(a, b))

    repeated = F.col("h").isNotNull() & (F.size(F.array_distinct("h")) < F.size("h"))
    for half in (1, 2):
        d = d.select(*keys, *done, doubled(half).alias("h"))
    d = d.select(*keys, *done, F.when(repeated, doubled(4)).alias("h"))
    # only texts with a repeated window: (hash, start) in order, then the
    # starts whose neighbour has the same hash
    d = d.select(*keys, *done, F.when(repeated, F.array_sort(
        F.transform("h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("hs"))
    last = F.size("hs") - 1

    def start(x: Column, k: Column) -> Column:
        before = F.when(k > 0, F.get(F.col("hs"), k - 1)["h"] == x["h"]).otherwise(F.lit(False))
        after = F.when(k < last, F.get(F.col("hs"), k + 1)["h"] == x["h"]).otherwise(F.lit(False))
        return F.when(before | after, x["i"]).otherwise(F.lit(-1))

    d = d.select(*keys, *done, F.when(F.col("hs").isNotNull(), F.array_sort(
        F.filter(F.transform("hs", start), lambda i: i >= 0))).alias("starts"))
    covered = F.aggregate(
        "starts", F.struct(F.lit(0).alias("n"), F.lit(-w).alias("p")),
        lambda a, i: F.struct((a["n"] + F.least(F.lit(w), i - a["p"])).alias("n"), i.alias("p")),
        lambda a: a["n"])
    return d.select(*keys, *done, F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    return ((F.col("n_words") < MIN_WORDS)
            | (F.lit(100) * F.col("n_repeat_words") > F.lit(MAX_REPEAT_PERCENT) * F.col("n_words")))


def _vote(bad: Column, good: Column) -> Column:
    return F.when(bad, F.lit("b")).when(good, F.lit("g")).otherwise(F.lit("-"))


def rules() -> dict[str, Column]:
    """Each rule's vote: ``g`` good, ``b`` bad, ``-`` abstain."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    lines = F.greatest(F.col("n_lines"), F.lit(1))
    return {
        "symbols": _vote(F.col("n_symbols") > 0.1 * n, F.col("n_symbols") <= 0.01 * n),
        "capitals": _vote(F.col("n_upper") > 0.3 * chars, F.col("n_upper") <= 0.1 * chars),
        "letters": _vote(F.col("n_punct") > 0.12 * chars, F.col("n_punct") <= 0.07 * chars),
        "repeats": _vote(F.col("n_repeat_words") > 0.3 * n, F.col("n_repeat_words") == 0),
        "lines": _vote(F.col("n_dup_lines") > 0.2 * lines, (F.col("n_dup_lines") == 0) & (F.col("n_lines") > 2)),
        "lengths": _vote((chars < 2 * n) | (chars > 12 * n), (chars >= 3 * n) & (chars <= 9 * n)),
        "variety": _vote(F.col("n_distinct") < 0.2 * n, (F.col("n_distinct") > 0.4 * n) & (n >= 50)),
        "endings": _vote(F.col("n_ended") < 0.2 * lines, F.col("n_ended") > 0.8 * lines),
    }


@dataclass(frozen=True)
class Votes:
    """How often each rule votes each way on good and on bad documents."""

    good_share: float
    on_good: dict[str, dict[str, float]]
    on_bad: dict[str, dict[str, float]]

    def posterior(self) -> Column:
        """Probability that a document (with its vote columns) is good."""
        odds = F.lit(math.log(self.good_share / (1 - self.good_share)))
        for r, good in self.on_good.items():
            bad = self.on_bad[r]
            for v in "gb-":
                odds = odds + F.when(F.col("vote_" + r) == v, F.lit(math.log(good[v] / bad[v]))).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))

    def probability(self, votes: dict[str, str]) -> float:
        """The same for one combination of votes."""
        odds = math.log(self.good_share / (1 - self.good_share))
        odds += sum(math.log(g[votes[r]] / self.on_bad[r][votes[r]]) for r, g in self.on_good.items())
        return 1 / (1 + math.exp(min(-odds, 700.0)))

    def accuracy(self) -> dict[str, float]:
        """Estimated share of each rule's votes that are right."""
        p, out = self.good_share, {}
        for r, g in self.on_good.items():
            b = self.on_bad[r]
            right = p * g["g"] + (1 - p) * b["b"]
            out[r] = right / (right + p * g["b"] + (1 - p) * b["g"])
        return out


def estimate(patterns: list[tuple[dict[str, str], int]], names: list[str], rounds: int = ROUNDS) -> Votes:
    """Expectation-maximisation over vote patterns and how often each occurs.

    It starts from rules that are mostly right; every rate keeps one vote of
    prior weight, so none reaches 0 or 1 and an empty table keeps the start.
    A rule that would end up voting *bad* more often on good documents than on
    bad ones has lost its meaning and is held at even odds."""
    start_good, start_bad = {"g": 0.70, "b": 0.02, "-": 0.28}, {"g": 0.40, "b": 0.30, "-": 0.30}
    v = Votes(0.85, {r: dict(start_good) for r in names}, {r: dict(start_bad) for r in names})
    total = sum(n for _, n in patterns)
    for _ in range(rounds if total else 0):
        good = 0.0
        on_good = {r: dict(start_good) for r in names}
        on_bad = {r: dict(start_bad) for r in names}
        for votes, n in patterns:
            p = v.probability(votes) * n
            good += p
            for r in names:
                on_good[r][votes[r]] += p
                on_bad[r][votes[r]] += n - p
        for r in names:
            on_good[r] = {k: x / (good + 1) for k, x in on_good[r].items()}
            on_bad[r] = {k: x / (total - good + 1) for k, x in on_bad[r].items()}
            if on_good[r]["b"] > on_bad[r]["b"]:
                on_bad[r] = dict(on_good[r])
        share = min(max((good + 0.85) / (total + 1), 0.5), 0.999)
        moved = max(abs(share - v.good_share), *(abs(on_bad[r][k] - v.on_bad[r][k]) for r in names for k in "gb-"))
        v = Votes(share, on_good, on_bad)
        if moved < 1e-7:
            break
    return v


def _judged(counted: DataFrame, rounds: int) -> DataFrame:
    voted = counted.withColumns({"vote_" + r: c for r, c in rules().items()})
    votes = [c for c in voted.columns if c.startswith("vote_")]
    # at most 3 ** rules rows, whatever the corpus
    counts = voted.groupBy(*votes).agg(F.count(F.lit(1)).alias("n")).orderBy(*votes).collect()
    v = estimate([({c[5:]: r[c] for c in votes}, r["n"]) for r in counts], [c[5:] for c in votes], rounds)
    return (voted.withColumn("base_failed", base_failed()).withColumn("posterior", v.posterior())
            .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= KEEP_FROM)))


def judge(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``doc_id``, the counts, each rule's vote, ``posterior``, ``base_failed``
    and ``kept`` of every document."""
    counted = with_counts(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    return _judged(written(counted, "quality-counts"), rounds)


def filter_quality(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """The documents that are kept, with the columns of ``docs``."""
    row = free_name(docs, "row")
    packed = docs.select(F.struct(*[quoted(c) for c in docs.columns]).alias(row), F.col("text"))
    counted = written(with_counts(packed), "quality-rows")
    kept = _judged(counted, rounds).where("kept")
    return kept.select(*[F.col(row).getField(c).alias(c) for c in docs.columns])
