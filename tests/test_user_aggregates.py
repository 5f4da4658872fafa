"""User aggregates: typed states of several fields, merges, finishing steps."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from strata.operators.custom import custom_profile, merge_custom
from strata.operators.user_aggregates import (
    Field, UserAggregate, finish_user, finish_user_long, merge_user, rollup_user, state_columns, user_profile,
)

BIG = 9007199254740993  # 2**53 + 1
WEIGHTED = UserAggregate(state={"w": Field("sum", lambda c: F.when(c.isNotNull(), F.col("w"))),
                                "wx": Field("sum", lambda c: c * F.col("w"))},
                         finish=lambda s: s["wx"] / s["w"])
ARGMAX = UserAggregate(state={"best": Field("max", lambda c: F.when(c.isNotNull(), F.struct(c.alias("v"), F.col("id"), F.col("name"))))},
                       finish=lambda s: s["best"]["name"])


@pytest.fixture(scope="module")
def rows(spark):
    data = [(i, f"2024-0{1 + i % 3}-{1 + i % 27:02d}", float(i % 7) if i % 11 else None, i % 5 + 1, BIG + i,
             Decimal(i) + Decimal("0.0000000001"), f"n{i:03d}") for i in range(300)]
    df = spark.createDataFrame(data, "id long, d string, x double, w int, big long, dec decimal(38,10), name string")
    return df.withColumn("d", F.col("d").cast("timestamp_ntz")).repartition(5)


def test_weighted_mean_and_argmax(rows):
    aggs = {"wmean": WEIGHTED, "top": ARGMAX}
    got = {r["dataset_ts"].month: r for r in finish_user(user_profile(rows, aggs, "d", "M", columns=["x"]), aggs).collect()}
    data = [r for r in rows.collect() if r.x is not None]
    for m in (1, 2, 3):
        mine = [r for r in data if r.d.month == m]
        assert got[m]["x:wmean"] == pytest.approx(sum(r.x * r.w for r in mine) / sum(r.w for r in mine))
        assert got[m]["x:top"] == max((r.x, r.id, r.name) for r in mine)[2]


def test_types_stay_exact(rows):
    aggs = {"sum": UserAggregate({"s": Field("sum", lambda c: c)}), "max": UserAggregate({"s": Field("max", lambda c: c)})}
    r = finish_user(user_profile(rows, aggs, columns=["big", "dec"]), aggs).first()
    assert r["big:max"] == BIG + 299 and r["big:sum"] == sum(BIG + i for i in range(300))
    assert r["dec:max"] == Decimal("299.0000000001")
    text = {"max": aggs["max"]}
    assert finish_user(user_profile(rows, text, columns=["name"]), text).first()["name:max"] == "n299"


def test_every_merge_folds_like_one_pass(spark, rows, tmp_dir):
    aggs = {"all": UserAggregate({
        "sum": Field("sum", lambda c: c, 0), "count": Field("count", lambda c: c), "min": Field("min", lambda c: c),
        "max": Field("max", lambda c: c), "every": Field("every", lambda c: c > 3), "any": Field("any", lambda c: c > 3),
        "and": Field("bit_and", lambda c: c), "or": Field("bit_or", lambda c: c), "xor": Field("bit_xor", lambda c: c),
        "distinct": Field("distinct", lambda c: c)})}
    daily = user_profile(rows, aggs, "d", "D", columns=["id", "w"])
    daily.write.parquet(f"{tmp_dir}/store")
    back = spark.read.parquet(f"{tmp_dir}/store")
    assert set(state_columns(back)) == {"id:all", "w:all"}  # the merges are kept with the columns
    key = lambda r: r["dataset_ts"]
    want = sorted(finish_user(user_profile(rows, aggs, "d", "M", columns=["id", "w"]), aggs).collect(), key=key)
    assert sorted(finish_user(rollup_user(back, "M"), aggs).collect(), key=key) == want
    halves = [user_profile(rows.where(F.col("id") % 2 == k), aggs, "d", "M", columns=["id", "w"]) for k in (0, 1)]
    assert sorted(finish_user(merge_user(halves[0].unionByName(halves[1])), aggs).collect(), key=key) == want
    with pytest.raises(ValueError):
        rollup_user(rollup_user(back, "W"), "M")


def test_init_where_and_empty_input(rows):
    aggs = {"hits": UserAggregate({"n": Field("sum", lambda c: F.lit(1), 0)}, where=lambda c: c > 100)}
    r = finish_user(user_profile(rows, aggs, columns=["x", "id"]), aggs).first()
    assert (r["x:hits"], r["id:hits"]) == (0, 199)
    none = user_profile(rows.where("false"), aggs, columns=["x"])
    assert [tuple(r) for r in finish_user(none, aggs).collect()] == [(0,)]
    assert [tuple(r) for r in finish_user(merge_user(none, aggregates=aggs), aggs).collect()] == [(0,)]


def test_long_results_and_bad_definitions(rows):
    aggs = {"top": ARGMAX, "n": UserAggregate({"n": Field("count", lambda c: c)})}
    long = {(r.column, r.metric): (r.type, r.value) for r in finish_user_long(user_profile(rows, aggs, columns=["big"]), aggs).collect()}
    assert long == {("big", "top"): ("string", "n299"), ("big", "n"): ("bigint", "300")}
    with pytest.raises(ValueError):
        Field("median", lambda c: c)
    with pytest.raises(ValueError):
        UserAggregate({})
    with pytest.raises(ValueError):
        user_profile(rows, aggs, columns=["nope"])
    with pytest.raises(ValueError):
        merge_user(rows)


def test_names_cannot_clash(rows):
    aggs = {"n": UserAggregate({"n": Field("count", lambda c: c)})}
    odd = rows.select("*", F.lit(1).alias("dataset_ts"), F.lit("k").alias("__period"), F.lit("z").alias("__0_0_0"))
    got = finish_user(user_profile(odd, aggs, "d", "M", by=["__0_0_0"], columns=["dataset_ts"]), aggs)
    assert got.columns == ["dataset_ts", "__0_0_0", "dataset_ts:n"] and got.agg(F.sum("`dataset_ts:n`")).first()[0] == 300


def test_custom_metrics_keep_whole_numbers_and_text(rows):
    top = {"top": ("max", lambda c: c)}
    assert custom_profile(rows, top, columns=["big"]).first().value == BIG + 299
    assert merge_custom(custom_profile(rows, top, columns=["name"])).first().value == "n299"
    with pytest.raises(ValueError):
        custom_profile(rows, top, columns=["name", "x"])


def test_kinds_of_text_values(spark):
    from strata.operators.sniff import kind_of, sniff, sniffed

    kinds = {"12": "integral", " +7\n": "integral", "-0.5": "fractional", ".5": "fractional", "5.": "fractional", "1e9": "fractional",
             "TRUE": "boolean", "false": "boolean", "tRUE": "text", "2024-02-29": "date", "2024-02-29T23:59:59.5Z": "date",
             "2024-13-01": "text", "2024-01-01 24:00": "text", "": "blank", " \t": "blank", "12 13": "text", "\u0661": "text"}
    df = spark.createDataFrame([(k, v, i % 2) for i, (k, v) in enumerate(kinds.items())] + [(None, None, 0)], "v string, want string, g int")
    assert [r.v for r in df.withColumn("got", kind_of(F.col("v"))).collect() if r.got != r.want] == []
    parts = [sniff(df.where(F.col("g") == k), columns=["v"]) for k in (0, 1)]
    both, direct = sniffed(merge_user(parts[0].unionByName(parts[1]))), sniffed(sniff(df, columns=["v"]))
    assert both.collect() == direct.collect() and direct.first().fits == "text" and direct.first().integral == 2
    assert sniffed(sniff(df.where("want in ('integral', 'fractional', 'blank')"), columns=["v"])).first().fits == "fractional"
    assert sniffed(sniff(df.where("false"), columns=["v"])).first().fits is None
    assert [r.column for r in sniffed(sniff(df, by="want")).select("column").distinct().collect()] == ["v"]
