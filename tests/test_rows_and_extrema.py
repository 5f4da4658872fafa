"""Heavy hitters, checked rows, exact extrema, type changes, observed counts."""

import logging
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from strata.functions.metrics import decimal_key, decimal_text
from strata.operators.heavy import SLACK, heavy_hitters, map_size
from strata.operators.merge import merge_stores
from strata.operators.profile import profile
from strata.operators.views import across_types, exact_extrema
from strata.plans.jobs import profile_job
from strata.sources.tables import checked_rows, register_tables, split_rows
from tests.conftest import SF001


# -------------------------------------------------------------- heavy hitters

def test_heavy_hitters_of_every_type(spark):
    df = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-0.0)).when(F.col("id") % 3 == 1, F.lit(0.0)).otherwise(F.col("id") * 1.5).alias("x"),
        F.expr("date_add(DATE'2024-01-01', int(id % 40 * (id % 2)))").alias("d"),
        F.expr("CASE WHEN id % 4 = 0 THEN concat('text ', id) WHEN id % 4 = 1 THEN NULL ELSE 'common' END").alias("t"),
        F.expr("cast(id % 7 * 1.25 AS decimal(20,4))").alias("c"), F.expr("cast(concat('b', id % 2) AS binary)").alias("b"),
        F.expr("array(id % 2)").alias("a"), (F.col("id") % 2).alias("k"))
    capacity = 64
    got = {(r.column, r.item): (r["count"], r.rows, r.bound) for r in heavy_hitters(df, capacity=capacity).collect()}
    want = {}
    texts = {"x": lambda v: str(v + 0.0), "d": str, "t": str, "c": str, "b": lambda v: bytes(v).hex().upper(),
             "a": lambda v: str(v).replace(" ", ""), "k": str}
    rows = df.collect()
    for c, text in texts.items():
        values = Counter(text(r[c]) for r in rows if r[c] is not None)
        n = sum(values.values())
        bound = int(SLACK * n / map_size(capacity))
        want |= {(c, v): (k, n, bound) for v, k in values.items() if k > bound}
    assert got == want and len(got) > 12


def test_heavy_hitters_per_key(spark):
    df = spark.range(4000).select((F.col("id") % 3).alias("g"), F.when(F.col("id") % 5 > 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("v"))
    df = df.withColumn("g", F.when(F.col("g") > 0, F.col("g")))  # a null key is a key
    got = {(r.g, r.item): r["count"] for r in heavy_hitters(df, ["v"], by="g", capacity=100).collect()}
    rows = Counter((r.g, r.v) for r in df.collect())
    assert got == {k: n for k, n in rows.items() if k[1] == "hot"}
    assert heavy_hitters(df.where("false"), ["v"]).count() == 0
    with pytest.raises(ValueError):
        heavy_hitters(df.withColumnRenamed("g", "rows"), ["v"], by="rows")


# ---------------------------------------------------------------- checked rows

def test_rows_are_split_with_reasons(spark, tmp_dir):
    df = spark.createDataFrame([(1, "5", 2.0, "a"), (2, "x", 2.5, None), (3**30, "7", 1e30, "b"), (None, None, None, "c")],
                               "id long, n string, x double, reasons string")
    schema = "id int NOT NULL, n int, x bigint, reasons string NOT NULL"
    why = {r.id: r.reasons_ for r in checked_rows(df, schema)[0].collect()}
    assert why == {1: [], 2: ["cast:n", "inexact:x", "null:reasons"], 3**30: ["cast:id", "cast:x"], None: ["null:id"]}
    for folder in (None, f"{tmp_dir}/checked"):
        good, bad = split_rows(df, schema, folder)
        assert [tuple(r) for r in good.collect()] == [(1, 5, 2, "a")]
        assert [f.dataType.simpleString() for f in good.schema.fields] == ["int", "int", "bigint", "string"]
        assert bad.columns == ["id", "n", "x", "reasons", "reasons_"]
        assert sorted(map(repr, bad.drop("reasons_").collect())) == sorted(map(repr, df.where("id <> 1 OR id IS NULL").collect()))
    with pytest.raises(ValueError):
        split_rows(df, "nope int")


# -------------------------------------------------------------------- extrema

def test_decimal_keys_sort_as_numbers(spark):
    values = [Decimal(s) for s in ("0", "-0.5", "0.5", "-12345678901234567890.123456789", "12345678901234567890.123456788",
                                   "12345678901234567890.123456789", "-1", "1", "10", "9", "-10", "-9", "0.000000001")]
    df = spark.createDataFrame([(v,) for v in values], "v decimal(38,9)").select("v", F.expr(decimal_key("v")).alias("k"))
    rows = df.withColumn("t", F.expr(decimal_text("k"))).collect()
    assert [r.v for r in sorted(rows, key=lambda r: r.k)] == sorted(values)
    assert all(Decimal(r.t) == r.v for r in rows)


def test_exact_extrema_of_decimals_binary_and_times(spark):
    df = spark.createDataFrame(
        [(Decimal("12345678901234567890.1234567891"), b"\xff", b""), (Decimal("-12345678901234567890.1234567892"), b"\x0a", None), (None, None, None)],
        "d decimal(38,10), b binary, e binary").withColumn("t", F.lit("2024-02-29 23:59:59.999999").cast("timestamp_ntz"))
    got = {r.column: (r.minimum, r.maximum) for r in exact_extrema(profile(df)).collect()}
    assert got == {"d": ("-12345678901234567890.1234567892", "12345678901234567890.1234567891"), "b": ("0A", "FF"), "e": ("", ""),
                   "t": ("2024-02-29T23:59:59.999999",) * 2}
    # over a merge, also of decimals of unlike scales
    other = spark.createDataFrame([(Decimal("99999999999999999999999.5"),)], "d decimal(30,1)")
    both = merge_stores([profile(df, columns=["d"]), profile(other)])
    assert [(r.minimum, r.maximum) for r in exact_extrema(both).collect()] == [
        ("-12345678901234567890.1234567892", "99999999999999999999999.5")]


def test_type_changes_give_one_row(spark):
    runs = [spark.createDataFrame([(9007199254740993,), (None,)], "v long"), spark.createDataFrame([(2.5,), (-1e3,)], "v double"),
            spark.createDataFrame([(Decimal("9007199254740993.5"),)], "v decimal(38,10)"), spark.createDataFrame([("abc",)], "v string")]
    rows = across_types(merge_stores([profile(r) for r in runs])).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.n, r.nonnull, r["null"]) == (6, 5, 1) and r.types == {"fractional": 3, "integral": 1, "string": 1}
    assert (r.least, r.greatest) == ("-1000", "9007199254740993.5")
    far = spark.createDataFrame([(1e300,), (-1e39,), (1e-7,)], "v double")
    r = across_types(merge_stores([profile(runs[0]), profile(far)])).first()
    assert (r.least, r.greatest) == ("-", "+")


# ------------------------------------------------------------------ one scan

def test_dropped_rows_are_observed_by_the_profile(spark, tmp_dir, caplog):
    ev = spark.read.parquet(f"{SF001}/events.parquet").withColumn("ts", F.when(F.col("event_id") % 10 > 0, F.col("ts")))
    ev.repartition(4).write.parquet(f"{tmp_dir}/in")
    missing = ev.where("ts IS NULL").count()
    seen = Observation("seen")
    store = profile_job(spark, table_path=f"{tmp_dir}/in", date_column="ts", freq="D", dropped=seen)
    assert store.where("column = 'event_id'").agg(F.sum("n")).first()[0] == ev.count() - missing
    assert seen.get["dropped"] == missing
    with caplog.at_level(logging.INFO, logger="strata"):
        profile_job(spark, table_path=f"{tmp_dir}/in", date_column="ts", freq="D", output=f"{tmp_dir}/out")
    assert f"{missing} rows without ts" in caplog.text


def test_tables_are_listed_by_spark(spark):
    assert "orders" in register_tables(spark, f"file://{SF001}")
    assert register_tables(spark, SF001, ["nation", "nope"]) == ["nation"]
