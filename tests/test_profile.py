import datetime as dt
import decimal
import math

import pytest
from pyspark.sql import functions as F

from strata import exact_metrics, merge_profiles, merge_stores, profile, profile_table, rollup
from strata.operators.merge import lookup, period_count
from tests.conftest import SF001


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def lineitem(spark):
    return spark.read.parquet(f"{SF001}/lineitem.parquet")


def test_counts_add_up_to_rows(spark, lineitem):
    store = profile(lineitem, "l_shipdate", "D")
    total = store.where("column = 'l_orderkey'").agg(F.sum("n")).first()[0]
    assert total == lineitem.where("l_shipdate IS NOT NULL").count()
    assert period_count(store).first().periods == lineitem.select(
        F.to_date("l_shipdate")).distinct().count()


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_partitioning_does_not_change_exact_metrics(spark, lineitem, parts):
    base = rows(exact_metrics(profile(lineitem, "l_shipdate", "M")))
    again = rows(exact_metrics(profile(lineitem.repartition(parts), "l_shipdate", "M", fanout=3)))
    assert base == again


def test_merge_of_splits_equals_direct(spark, lineitem):
    a = profile(lineitem.where("l_orderkey % 3 = 0"), "l_shipdate", "M")
    b = profile(lineitem.where("l_orderkey % 3 != 0"), "l_shipdate", "M")
    direct = profile(lineitem, "l_shipdate", "M")
    assert rows(exact_metrics(merge_stores([b, a]))) == rows(exact_metrics(direct))
    est = (profile_table(merge_stores([a, b])).select("dataset_ts", "column", "distinct_est")
           .join(profile_table(direct).select("dataset_ts", "column",
                                              F.col("distinct_est").alias("d2")),
                 ["dataset_ts", "column"]))
    worst = est.select(F.max(F.abs(F.col("distinct_est") - F.col("d2")) /
                             F.greatest(F.col("d2"), F.lit(1.0)))).first()[0]
    assert worst < 0.05


def test_merge_with_itself_doubles_counts_keeps_ranges(spark, lineitem):
    store = profile(lineitem, "l_shipdate", "M")
    twice = merge_stores([store, store])
    a = {(r.dataset_ts, r.column): r for r in exact_metrics(store).collect()}
    for r in exact_metrics(twice).collect():
        o = a[(r.dataset_ts, r.column)]
        assert r.n == 2 * o.n and r.nonnull == 2 * o.nonnull
        assert (r.min_i, r.max_i, r.min_d, r.max_d, r.min_s, r.max_s) == \
            (o.min_i, o.max_i, o.min_d, o.max_d, o.min_s, o.max_s)
        if o.stddev is not None:
            assert math.isclose(r.stddev, o.stddev, rel_tol=1e-6, abs_tol=1e-4)
    d1 = profile_table(store).select("dataset_ts", "column", "distinct_est")
    d2 = profile_table(twice).select("dataset_ts", "column", F.col("distinct_est").alias("e"))
    assert d1.join(d2, ["dataset_ts", "column"]).where("distinct_est != e").count() == 0


def test_identity_and_empty_input(spark, lineitem):
    empty = lineitem.where(F.lit(False))
    g = profile(empty)
    r = g.collect()
    assert len(r) == len(lineitem.columns) and all(x.n == 0 for x in r)
    assert profile(empty, "l_shipdate", "D").count() == 0
    store = profile(lineitem)
    assert rows(exact_metrics(merge_stores([store, g]))) == rows(exact_metrics(store))
    # decoding estimates of an all-empty profile must not fail
    assert profile_table(g).count() == len(lineitem.columns)


def test_rollup_day_to_month_equals_direct(spark, lineitem):
    daily = profile(lineitem, "l_shipdate", "D")
    assert rows(exact_metrics(rollup(daily, "M"))) == rows(
        exact_metrics(profile(lineitem, "l_shipdate", "M")))


def test_lookup(spark, lineitem):
    store = profile(lineitem, "l_shipdate", "M")
    got = lookup(store, dataset_ts=dt.datetime(1995, 3, 31))
    assert got.select("dataset_ts").distinct().count() == 1


EDGE_SCHEMA = ("id int, d double, big bigint, dec decimal(38,10), s string, b boolean, "
               "arr array<int>, nothing string, day date, ts timestamp, "
               "items array<struct<sku:string,qty:int>>")


@pytest.fixture(scope="module")
def edge_df(spark):
    inf = float("inf")
    data = [
        (1, float("nan"), 2**53 + 1, decimal.Decimal("12345678901234567890.0123456789"), "a", True,
         [1, 2], None, dt.date(2024, 2, 29), dt.datetime(2024, 1, 1, 0, 0), [("x", 1)]),
        (2, inf, -(2**62), decimal.Decimal("-1.5"), "bb", False, None, None, None, None, None),
        (3, -inf, 7, None, None, None, [3], None, dt.date(2023, 12, 31), dt.datetime(2023, 12, 31, 23, 59, 59),
         [("x", 1), ("y", 2)]),
        (4, -0.0, None, decimal.Decimal("0"), "", True, [], None, dt.date(2024, 1, 1), dt.datetime(2024, 1, 1, 12), []),
        (5, 2.5, 7, decimal.Decimal("2"), "zz", True, [1, 2], None, dt.date(2024, 1, 1), dt.datetime(2024, 1, 2),
         [("x", 1)]),
        (6, None, 7, decimal.Decimal("3"), "a", None, None, None, dt.date(2024, 1, 1), dt.datetime(2024, 1, 2), None),
    ]
    return spark.createDataFrame(data, EDGE_SCHEMA)


def test_edge_values(spark, edge_df):
    t = {r.column: r for r in profile_table(profile(edge_df)).collect()}
    d = t["d"]
    assert (d.n, d.nonnull, d.null, d.nan, d.inf) == (6, 5, 1, 1, 2)
    assert (d.min_d, d.max_d) == (float("-inf"), float("inf"))
    assert d.mean == pytest.approx(1.25)  # finite values only: -0.0 and 2.5
    big = t["big"]
    assert (big.min_i, big.max_i) == (-(2**62), 2**53 + 1)  # exact beyond 2^53
    assert big.distinct_est == 3
    assert t["dec"].type_class == "fractional" and t["dec"].nonnull == 5
    s = t["s"]
    assert (s.min_s, s.max_s, s.nonnull) == ("", "zz", 5)
    assert s.mean == pytest.approx((1 + 2 + 0 + 2 + 1) / 5)  # lengths
    assert {(x.item, x["count"]) for x in s.frequent_items} == {("a", 2), ("bb", 1), ("", 1), ("zz", 1)}
    b = t["b"]
    assert {(x.item, x["count"]) for x in b.frequent_items} == {("true", 3), ("false", 1)}
    assert t["arr"].type_class == "object" and t["arr"].distinct_est == 3
    assert t["items"].type_class == "object" and t["items"].nonnull == 4
    assert t["items"].distinct_est == 3
    nothing = t["nothing"]
    assert (nothing.nonnull, nothing.null, nothing.distinct_est) == (0, 6, 0)
    assert nothing.quantiles is None and nothing.frequent_items == []
    day = t["day"]
    assert day.type_class == "datetime" and day.min_i == 1703980800 * 1_000_000


def test_null_date_policies(spark, edge_df):
    drop = profile(edge_df, "ts", "D", columns=["id"])
    assert drop.agg(F.sum("n")).first()[0] == 5
    keep = profile(edge_df, "ts", "D", columns=["id"], null_dates="keep")
    assert keep.where("dataset_ts IS NULL").first().n == 1
    epoch = profile(edge_df, "ts", "D", columns=["id"], null_dates="epoch")
    assert epoch.where("dataset_ts = TIMESTAMP_NTZ'1970-01-01 00:00:00'").first().n == 1
    with pytest.raises(Exception):
        profile(edge_df, "ts", "D", columns=["id"], null_dates="error").collect()


def test_reference_sample_rows(spark):
    # The three sample rows of the reference (by `time`: 2015-06-11 x1, 2015-06-17 x2).
    df = spark.createDataFrame(
        [(9734136, 1434565400, dt.datetime(2015, 6, 17, 18, 23, 20)),
         (4921158, 1434565400, dt.datetime(2012, 12, 14, 14, 56, 6)),
         (7500568, 1434065400, dt.datetime(2014, 3, 31, 10, 19, 18))],
        "id bigint, time bigint, time_ts timestamp_ntz")
    by_time = {r.dataset_ts.date(): r.n for r in
               profile(df, "time", "D", unit="s", columns=["id"]).collect()}
    assert by_time == {dt.date(2015, 6, 11): 1, dt.date(2015, 6, 17): 2}
    assert profile(df, "time_ts", "D", columns=["id"]).count() == 3
    with pytest.raises(ValueError):
        profile(df, "time", "D")  # epoch seconds without a unit


def test_quantiles_are_within_rank_bound(spark, lineitem):
    t = profile_table(profile(lineitem, columns=["l_quantity"])).first()
    med = t.quantiles[4]
    vals = sorted(r[0] for r in lineitem.select("l_quantity").collect())
    lo = sum(v < med for v in vals) / len(vals)
    hi = sum(v <= med for v in vals) / len(vals)
    assert lo <= 0.53 and hi >= 0.47


def test_odd_column_names(spark):
    df = spark.createDataFrame([(1, "x", dt.datetime(2024, 1, 1, 5)), (2, "y", dt.datetime(2024, 1, 2))],
                               "`a.b c` int, `k.v` string, `when.ts` timestamp_ntz")
    store = profile(df, "when.ts", "D", by="k.v")
    assert {r.column for r in store.collect()} == {"a.b c", "k.v", "when.ts"}
    assert merge_profiles(store).count() == store.count()
    assert exact_metrics(store, {"dataset_ts": "yyyy-MM-dd"}).count() == 6


try:
    from hypothesis import Phase, given, settings
    from hypothesis import strategies as st
except ImportError:  # pragma: no cover
    given = None

if given is not None:
    values = st.one_of(st.none(), st.just(float("nan")), st.just(float("inf")), st.just(float("-inf")),
                       st.floats(-1e9, 1e9), st.integers(-10, 10).map(float))
    rows_st = st.lists(st.tuples(st.integers(0, 4), values, st.sampled_from(["a", "b", None, "ccc"]),
                                 st.integers(0, 2)), min_size=0, max_size=40)

    def _same(a, b):
        if isinstance(a, float) and isinstance(b, float):
            return (math.isnan(a) and math.isnan(b)) or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-3)
        return a == b

    @settings(max_examples=8, deadline=None, phases=[Phase.explicit, Phase.reuse, Phase.generate])
    @given(rows_st)
    def test_property_random_split_merge_equals_direct(spark, data):
        df = spark.createDataFrame(data, "k int, x double, s string, part int")
        direct = {(r.k, r.column): r for r in
                  exact_metrics(profile(df, by="k", columns=["x", "s"])).collect()}
        parts = [profile(df.where(F.col("part") == p), by="k", columns=["x", "s"]) for p in range(3)]
        merged = {(r.k, r.column): r for r in exact_metrics(merge_stores(parts)).collect()}
        assert direct.keys() == merged.keys()
        for key, r in direct.items():
            m = merged[key]
            for f in r.__fields__:
                assert _same(r[f], m[f]), (key, f, r[f], m[f])


def test_salted_tree_path_equals_single_level(spark, lineitem):
    from strata.operators.profile import input_partitions, tree_fanout
    assert tree_fanout(64) == 1 and tree_fanout(100) == 10 and tree_fanout(800_000) == 895
    # a plan ending in a shuffle arrives in shuffle-partition width (not run to find out)
    assert input_partitions(lineitem.groupBy("l_orderkey").count()) == 8
    assert input_partitions(lineitem) == lineitem.rdd.getNumPartitions()
    wide = lineitem.repartition(100)
    for args in [("l_shipdate", "M"), ()]:
        a = rows(exact_metrics(profile(wide, *args, fanout=10)))
        b = rows(exact_metrics(profile(lineitem, *args)))
        assert a == b


def test_topk_extremes(spark):
    df = spark.range(5000).selectExpr("cast(id as string) AS uniq", "'same' AS one")
    t = {r.column: r for r in profile_table(profile(df)).collect()}
    assert [(x.item, x["count"]) for x in t["one"].frequent_items] == [("same", 5000)]
    # a near-unique column has no heavy hitter: whatever is returned is valid
    assert all(x["count"] >= 1 for x in t["uniq"].frequent_items)
    assert abs(t["uniq"].distinct_est - 5000) <= 250


def test_wide_tables_are_profiled_in_chunks(spark, lineitem):
    wide = lineitem.select("*", *[F.col(c).alias(f"{c}_copy{i}") for i in range(3) for c in lineitem.columns])
    chunked = profile(wide, "l_shipdate", "M", columns_per_pass=10)
    whole = profile(wide, "l_shipdate", "M")
    assert chunked.select("column").distinct().count() == len(wide.columns)
    assert rows(exact_metrics(chunked)) == rows(exact_metrics(whole))


def test_row_shuffle_plan_equals_default(spark, lineitem):
    a = profile(lineitem, "l_shipdate", "D", row_shuffle=True)
    plan = a._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(dataset_ts" in plan
    assert rows(exact_metrics(a)) == rows(exact_metrics(profile(lineitem, "l_shipdate", "D")))
    assert rows(exact_metrics(profile(lineitem, row_shuffle=True))) == rows(exact_metrics(profile(lineitem)))


def test_null_date_count(spark, edge_df):
    from strata.operators.counts import count_null_dates
    assert count_null_dates(edge_df, "ts") == 1
    assert count_null_dates(edge_df, "day") == 1


def test_sketch_config_is_validated():
    from strata import SketchConfig
    for bad in ({"lg_k": 3}, {"kll_k": 4}, {"topk_capacity": -1}):
        with pytest.raises(ValueError):
            SketchConfig(**bad)


def test_plan_choice_is_explicit(spark, lineitem):
    shuffled = profile(lineitem, "l_shipdate", "M", row_shuffle=True, columns=["l_quantity"])
    assert "REPARTITION_BY_COL" in shuffled._jdf.queryExecution().executedPlan().toString()
    partial = profile(lineitem, "l_shipdate", "M", columns=["l_quantity"])
    assert "REPARTITION_BY_COL" not in partial._jdf.queryExecution().executedPlan().toString()
    assert rows(exact_metrics(shuffled)) == rows(exact_metrics(partial))
    with pytest.raises(ValueError):
        profile(lineitem, "l_shipdate", "D", row_shuffle="auto")


def test_missing_periods_count_unparsable_text(spark):
    from strata.operators.counts import count_missing_periods
    df = spark.createDataFrame([("2024-01-01",), ("not a date",), (None,)], "t string")
    assert count_missing_periods(df, "t", date_errors="coerce") == 2


def test_key_names_must_not_clash_with_store_columns(spark):
    df = spark.createDataFrame([(1, "a")], "n int, `column` string")
    with pytest.raises(ValueError, match="clash"):
        profile(df, by="column")
    assert profile(df).count() == 2  # profiling such columns is fine


def test_lookup_is_independent_of_session_zone(spark, lineitem):
    store = profile(lineitem, "l_shipdate", "M")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert lookup(store, dataset_ts=dt.datetime(1995, 3, 31)).count() == len(lineitem.columns)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_row_shuffle_spreads_identical_copies(spark):
    # one period made of identical rows: the salt must still split it
    copies = spark.range(4000).selectExpr("TIMESTAMP_NTZ'2024-01-01 10:00:00' AS ts", "1 AS v")
    from strata.operators.profile import PERIOD_COLUMN, with_period
    salted = with_period(copies, "ts", "D").withColumn(
        "s", F.pmod(F.monotonically_increasing_id(), F.lit(4)))
    assert salted.groupBy(PERIOD_COLUMN, "s").count().count() == 4
    store = profile(copies, "ts", "D", row_shuffle=True, fanout=4)
    assert store.where("column = 'v'").first().n == 4000


def test_text_dates_raise_or_coerce(spark):
    df = spark.createDataFrame([("2024-01-01 10:00:00", 1), ("garbage", 2), (None, 3)], "t string, v int")
    with pytest.raises(Exception):
        profile(df, "t", "D", columns=["v"]).collect()
    kept = profile(df, "t", "D", columns=["v"], date_errors="coerce").collect()
    assert [(r.dataset_ts, r.n) for r in kept] == [(dt.datetime(2024, 1, 1), 1)]
    keep = profile(df, "t", "D", columns=["v"], date_errors="coerce", null_dates="keep")
    assert sorted(r.n for r in keep.collect()) == [1, 2]


def test_custom_metrics_merge_like_profiles(spark, lineitem):
    from strata.operators.custom import custom_profile, merge_custom
    metrics = {"positive": ("sum", lambda c: (c > 0).cast("int")),
               "largest": ("max", lambda c: c), "smallest": ("min", lambda c: c)}
    cols_ = ["l_quantity", "l_discount"]
    direct = custom_profile(lineitem, metrics, "l_shipdate", "M", columns=cols_)
    a = custom_profile(lineitem.where("l_orderkey % 2 = 0"), metrics, "l_shipdate", "M", columns=cols_)
    b = custom_profile(lineitem.where("l_orderkey % 2 = 1"), metrics, "l_shipdate", "M", columns=cols_)
    assert rows(merge_custom(a.unionByName(b))) == rows(direct)
    pos = {(r.dataset_ts, r.column): r.value for r in direct.where("metric = 'positive'").collect()}
    want = lineitem.where("l_discount > 0").groupBy(
        F.last_day("l_shipdate").cast("timestamp_ntz").alias("d")).count().collect()
    assert all(pos[(r.d, "l_discount")] == r["count"] for r in want)
    with pytest.raises(ValueError):
        custom_profile(lineitem, {"x": ("median", lambda c: c)})


def test_one_row_and_all_null_dates(spark):
    one = spark.createDataFrame([(1, 2.5, "x", dt.datetime(2024, 5, 6, 7, 8))], "a int, b double, s string, ts timestamp_ntz")
    t = {r.column: r for r in profile_table(profile(one, "ts", "D")).collect()}
    assert t["b"].stddev == 0.0 and t["b"].quantiles == [2.5] * 9 and t["a"].distinct_est == 1
    nulls = spark.createDataFrame([(1, None), (2, None)], "a int, ts timestamp_ntz")
    assert profile(nulls, "ts", "D").count() == 0                      # dropped
    kept = profile(nulls, "ts", "D", null_dates="keep").collect()
    assert {r.dataset_ts for r in kept} == {None} and {r.n for r in kept} == {2}


def test_merges_plan_no_window(spark, lineitem):
    daily = profile(lineitem, "l_shipdate", "M", columns=["l_quantity"])
    plan = merge_profiles(daily)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


@pytest.mark.parametrize("how", [{"date_column": "ts", "freq": "D"}, {"by": "g"}, {}])
def test_salts_follow_the_weight_of_a_key(spark, how):
    """A third of all rows in one key: partitions fill evenly, and the answer is the plain one."""
    from strata.operators.profile import SHARES, _salts_by_weight, key_weights, merge_weights

    n = 40_000
    df = spark.range(0, n, 1, 6).select(
        F.when(F.col("id") % 3 == 0, F.lit("2024-01-01")).otherwise(F.date_add(F.lit("2024-01-02"), (F.col("id") % 500).cast("int")))
        .cast("timestamp_ntz").alias("ts"), F.when(F.col("id") % 3 > 0, F.col("id") % 500).alias("g"), F.col("id").alias("rows"))
    answer = lambda s: sorted(map(tuple, exact_metrics(s).collect()), key=repr)
    want = answer(profile(df, columns=["rows"], **how))
    assert answer(profile(df, columns=["rows"], row_shuffle=True, **how)) == want
    if how:
        old = merge_weights(key_weights(df, **how).unionByName(key_weights(df, **how)))
        assert old.agg(F.sum("rows")).first()[0] == 2 * n
        assert answer(profile(df, columns=["rows"], row_shuffle=True, weights=old, **how)) == want
    if how == {"by": "g"}:
        src, salts = _salts_by_weight(df.select("g", "rows"), ["g"], "__period", None)
        salted = src.withColumn("s", F.pmod(F.monotonically_increasing_id(), salts))
        groups = salted.groupBy("g", "s").count().collect()
        width = SHARES * int(spark.conf.get("spark.sql.shuffle.partitions"))
        assert max(r["count"] for r in groups) <= 1.1 * n / width
        assert {r.s for r in groups if r.g is not None} == {0}  # light keys are not split
