"""Moments that merge by exact sums, against rational arithmetic."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from strata.functions.metrics import METRIC_COLUMNS, STORE_TYPES
from strata.functions.moments import MANTISSA, SPAN, limb_sums, with_bucket_moments, with_folded_moments, with_limbs
from strata.operators.merge import merge_profiles
from strata.operators.profile import profile


def exact(parts):
    """Mean and population variance times n of (n, mean, m2) triples."""
    parts = [(n, Fraction(m), Fraction(s)) for n, m, s in parts]
    total = sum(n for n, _, _ in parts)
    mean = sum(n * m for n, m, _ in parts) / total
    return total, float(mean), float(sum(s + n * (m - mean) ** 2 for n, m, s in parts))


def merged(spark, groups):
    """Moments of each named group of triples, by the two levels of the merge."""
    rows = [(k, n, float(m), float(s)) for k, parts in groups.items() for n, m, s in parts]
    df = spark.createDataFrame(rows, "k string, n long, mean double, m2 double").repartition(7)
    df = df.withColumnsRenamed({"n": "mom_n", "mean": "mom_mean", "m2": "mom_m2"})
    one = with_limbs(df, "_").groupBy("k", "_bucket").agg(F.sum("mom_n").alias("mom_n"), *limb_sums("_"))
    two = with_bucket_moments(one, "_").groupBy("k").agg(
        F.sum("mom_n").alias("mom_n"), F.array_sort(F.collect_list("_part")).alias("_parts"))
    done = with_folded_moments(two, "_").select("*", F.size("_parts").alias("buckets"))
    return {r.k: (r.mom_n, r._mean, r._m2, r.buckets) for r in done.collect()}


def test_merged_moments_equal_rational_arithmetic(spark):
    rng = random.Random(1)
    groups = {
        "near": [(rng.randrange(1, 10**6), 1e9 + rng.random() * 1e-3, rng.random()) for _ in range(500)],
        "spread": [(rng.randrange(1, 50), rng.uniform(-1, 1) * 10.0 ** rng.randrange(-30, 30), 0.0) for _ in range(500)],
        "border": [(rng.randrange(1, 9), 65536 + rng.uniform(-1e-6, 1e-6), 0.0) for _ in range(300)],
        "signs": [(7, rng.choice([-3.5, 3.5, 0.0]), 1.25) for _ in range(300)],
        "tiny": [(2, 5e-324 * rng.randrange(1, 100), 0.0) for _ in range(50)],
        "large": [(3, rng.uniform(.5, 1) * 1e150, 0.0) for _ in range(50)],
        "one": [(12, 0.1, 0.7)],
        "limb": [(1, 2.0**k, 0.0) for k in range(30, 40)] + [(1, -(2.0**k), 0.0) for k in range(30, 40)],
    }
    got = merged(spark, groups)
    for k, parts in groups.items():
        n, mean, m2 = exact(parts)
        assert got[k][0] == n
        assert math.isclose(got[k][1], mean, rel_tol=1e-15, abs_tol=1e-323 + 1e-15 * max(abs(m) for _, m, _ in parts)), k
        # two buckets meet as doubles: their means carry half a unit in the last place each
        assert math.isclose(got[k][2], m2, rel_tol=1e-4 if k == "border" else 1e-12), (k, got[k][2], m2)
    assert got["near"][3] == 1 and got["border"][3] == 2


def test_powers_of_two_are_exact_in_every_bucket(spark):
    means = [s * math.ldexp(m, e) for e in range(-1074, 1024, 3) for m in (1.0, 1.9999999999999998) for s in (1, -1)]
    means = [m for m in means if m and math.isfinite(m)]
    got = merged(spark, {str(i): [(5, m, 2.0)] for i, m in enumerate(means)})
    # a single bucket of a single row gives back its mean, bit for bit
    assert [got[str(i)][1] for i in range(len(means))] == means
    assert {got[str(i)][2] for i in range(len(means))} == {2.0}
    assert MANTISSA + SPAN <= 70


def test_overflowed_and_empty_moments(spark):
    inf = math.inf
    got = merged(spark, {"over": [(2, inf, inf), (3, 1.0, 0.5)], "both": [(2, inf, inf), (2, -inf, inf)],
                         "nan": [(2, 1.0, math.nan), (1, 1.0, 0.0)], "none": [(0, 0.0, 0.0), (0, 0.0, 0.0)]})
    assert got["over"][1:3] == (inf, inf) and got["both"][2] == inf and got["nan"][2] == inf
    assert got["none"][0] == 0 and got["none"][1] is None and got["none"][2] is None


def _store(df):
    typed = {"column": F.lit("c"), "type_class": F.lit("fractional"), "n": F.col("k"), "nonnull": F.col("k"),
             "mom_n": F.col("k"), "mom_mean": F.col("mean"), "mom_m2": F.col("m2"), "kll_kind": F.lit("double"),
             "min_d": F.col("mean"), "max_d": F.col("mean")}
    return df.select(F.lit("all").alias("key"), *[
        typed.get(m, F.lit(0 if m in ("null", "nan", "inf") else None)).cast(STORE_TYPES[m]).alias(m) for m in METRIC_COLUMNS])


def test_one_key_with_many_partial_rows(spark):
    """100,000 partial rows of one key and column; no row grows with their number."""
    df = spark.range(0, 100_000, 1, 16).select(
        F.expr("id % 9 + 1").alias("k"), F.expr("1e8 + double(id % 977) / 1024").alias("mean"),
        F.expr("double(id % 5)").alias("m2"))
    out = merge_profiles(_store(df), keys=["key"])
    row = out.first()
    n, mean, m2 = exact([(i % 9 + 1, 1e8 + (i % 977) / 1024.0, float(i % 5)) for i in range(100_000)])
    assert row.mom_n == n and row.mom_mean == pytest.approx(mean, rel=1e-15) and row.mom_m2 == pytest.approx(m2, rel=1e-12)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    lists = [line for line in plan.splitlines() if "collect_list" in line]
    assert len(lists) == 1 and "sum_aa" not in lists[0].split("collect_list")[0]  # of buckets, above the sums


def test_merge_of_shifted_values_equals_direct_profile(spark):
    df = spark.range(20_000).select(F.expr("id % 3000").alias("g"), F.expr("1e9 + sin(id)").alias("x"))
    direct = profile(df, columns=["x"]).first()
    back = merge_profiles(profile(df, by="g", columns=["x"]).drop("g")).first()
    assert back.mom_n == direct.mom_n and back.mom_mean == pytest.approx(direct.mom_mean, rel=1e-15)
    assert back.mom_m2 == pytest.approx(direct.mom_m2, rel=1e-7)
