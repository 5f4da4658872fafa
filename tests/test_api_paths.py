"""Smaller public paths: each call checked against a value worked out by hand."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from strata import (
    count_per_period, exact_metrics, frequent_items, profile, profile_job, read_input, rollup,
)
from strata.functions.periods import as_wall_clock, from_epoch, label_text, period_label
from strata.operators.merge import period_count
from tests.conftest import SF001


def test_epoch_units_and_date_columns(spark):
    df = spark.createDataFrame([(1434565400,)], "s bigint")
    r = df.select(from_epoch(F.col("s") * 1_000_000, "us").alias("us"),
                  from_epoch(F.col("s") * 1_000_000_000, "ns").alias("ns")).first()
    assert r.us == r.ns == dt.datetime(2015, 6, 17, 18, 23, 20)
    d = spark.createDataFrame([(dt.date(2024, 2, 29),)], "d date")
    w = d.select(as_wall_clock(F.col("d"), d.schema["d"].dataType).alias("w")).first().w
    assert w == dt.datetime(2024, 2, 29)
    with pytest.raises(ValueError):
        from_epoch(F.col("s"), "minutes")


def test_label_text_and_anchor(spark):
    df = spark.createDataFrame([("2024-01-05 13:14:15",)], "t string").select(F.to_timestamp_ntz("t").alias("ts"))
    r = df.select(label_text(period_label(F.col("ts"), "H"), "H").alias("h"),
                  label_text(period_label(F.col("ts"), "M"), "M").alias("m"),
                  period_label(F.col("ts"), "3D", anchor="2024-01-04").alias("a")).first()
    assert (r.h, r.m) == ("2024-01-05 13:00:00", "2024-01-31")
    assert r.a == dt.date(2024, 1, 4)


def test_counts_with_epoch_unit_and_period_count(spark):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    ev = ev.withColumn("secs", F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000)
    ev = ev.withColumn("secs", F.floor("secs").cast("bigint"))
    by_unit = count_per_period(ev, "secs", "D", unit="s").agg(F.sum("n")).first()[0]
    assert by_unit == ev.count()
    store = profile(spark.read.parquet(f"{SF001}/events.parquet"), "ts", "W")
    assert period_count(store).first().periods == store.select("dataset_ts").distinct().count()


def test_rollup_and_frequent_items_with_keys(spark):
    orders = spark.read.parquet(f"{SF001}/orders.parquet")
    daily = profile(orders, "o_orderdate", "D", by="o_orderstatus", columns=["o_orderpriority"])
    monthly = rollup(daily, "M")
    direct = profile(orders, "o_orderdate", "M", by="o_orderstatus", columns=["o_orderpriority"])
    assert sorted(map(tuple, exact_metrics(monthly).collect())) == \
        sorted(map(tuple, exact_metrics(direct).collect()))
    fi = frequent_items(monthly)
    assert set(fi.columns) == {"dataset_ts", "o_orderstatus", "column", "item", "count"}
    total = fi.agg(F.sum("count")).first()[0]
    assert total == orders.where("o_orderdate IS NOT NULL AND o_orderpriority IS NOT NULL").count()


def test_read_input_files_with_options(spark, tmp_dir):
    path = os.path.join(tmp_dir, "nation_csv")
    spark.read.parquet(f"{SF001}/nation.parquet").write.option("header", True).csv(path)
    df = read_input(spark, path=path, format="csv", options={"header": "true"},
                    schema="n_nationkey int, n_name string, n_regionkey int")
    assert df.count() == 25 and df.schema["n_nationkey"].dataType.simpleString() == "int"


def test_profile_job_writer_without_output(spark):
    seen = spark.sparkContext.accumulator(0)

    def writer(pairs):
        for _ in pairs:
            seen.add(1)

    store = profile_job(spark, table_path=f"{SF001}/region.parquet", writer=writer, dataset_id="r")
    assert seen.value == store.count() == 2


def test_accuracy_on_object_columns(spark):
    from strata.plans.accuracy import global_sketch_accuracy
    emb = spark.read.parquet(f"{SF001}/embeddings.parquet")
    acc = {r.column: r for r in global_sketch_accuracy(emb, profile(emb)).collect()}
    assert all(r.distinct_ok for r in acc.values())
    assert acc["embedding"].quantile_ok is None and acc["vec_id"].quantile_ok


def test_global_store_size_and_flat_write(spark, tmp_dir):
    from strata import profile_size, read_profiles, write_profiles
    store = profile(spark.read.parquet(f"{SF001}/supplier.parquet"))
    sizes = profile_size(store).collect()
    assert len(sizes) == 1 and sizes[0].columns == 4 and sizes[0].bytes > 0
    write_profiles(store, os.path.join(tmp_dir, "flat"))
    assert read_profiles(spark, os.path.join(tmp_dir, "flat")).count() == 4


def test_keyed_stream_profile(spark, tmp_dir):
    from strata.streaming import merge_panes, profile_stream
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    src = os.path.join(tmp_dir, "src")
    ev.repartition(3).write.parquet(src)
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(src)
    out = os.path.join(tmp_dir, "panes")
    profile_stream(stream, out, "ts", "D", by="event_type", checkpoint=os.path.join(tmp_dir, "ck"),
                   trigger={"availableNow": True}).awaitTermination()
    merged = exact_metrics(merge_panes(spark, out))
    direct = exact_metrics(profile(ev, "ts", "D", by="event_type"))
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, direct.collect()))


def test_windowed_stream_on_epoch_seconds(spark, tmp_dir):
    import uuid

    from strata.streaming import profile_stream_windowed
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    ev = ev.withColumn("secs", F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000).cast("bigint"))
    src = os.path.join(tmp_dir, "src")
    ev.orderBy("ts").coalesce(1).write.parquet(src)
    stream = spark.readStream.schema(ev.schema).parquet(src)
    long = profile_stream_windowed(stream, "secs", "1 day", watermark="0 seconds", unit="s",
                                   columns=["event_id", "value"])
    name = "wsec_" + uuid.uuid4().hex[:8]
    (long.writeStream.format("memory").queryName(name).outputMode("append")
     .option("checkpointLocation", os.path.join(tmp_dir, "ck")).trigger(availableNow=True)
     .start().awaitTermination())
    got = spark.table(name)
    assert got.select("column").distinct().count() == 2
    assert got.select("dataset_ts").distinct().count() == ev.select(F.to_date("ts")).distinct().count() - 1


def test_parameter_validation():
    from strata.streaming.batches import _wait_ms
    from strata.streaming.panes import parse_lateness
    assert _wait_ms("30 seconds") == 30_000 and _wait_ms("2 minutes") == 120_000
    assert parse_lateness("2 days") == dt.timedelta(days=2)
    for bad in ("soon", "5 fortnights"):
        with pytest.raises(ValueError):
            _wait_ms(bad)
        with pytest.raises(ValueError):
            parse_lateness(bad)


def test_command_line_runs_and_plans(spark, tmp_dir):
    from strata.plans.cli import main
    from strata.sinks import read_merged
    out = os.path.join(tmp_dir, "cli_runs")
    for run, plan in (("r1", "partial"), ("r2", "row-shuffle")):
        main(["--path", f"{SF001}/events.parquet", "--date-column", "ts", "--freq", "D",
              "--output", out, "--run-id", run, "--plan", plan, "--columns", "value"], spark=spark)
    merged = read_merged(spark, out)  # the same rows twice, as two runs
    n = merged.agg(F.sum("n")).first()[0]
    assert n == 2 * spark.read.parquet(f"{SF001}/events.parquet").count()


def test_accuracy_of_merged_sketches_bounds_each_task(spark, monkeypatch):
    import datetime

    from strata.plans import accuracy

    day = datetime.datetime(1995, 1, 1)
    rows = [(k % 7 if k % 3 else None, float(k), day.replace(year=1995 + k % 2) if k % 10 else None) for k in range(2000)]
    rows += rows[:50]
    df = spark.createDataFrame(rows, "a long, b double, ts timestamp_ntz")
    monkeypatch.setattr(accuracy, "PAIRS_PER_TASK", 100)
    got = accuracy.merged_sketch_accuracy(df, profile(df, "ts", "A"), "ts", "A", ["a", "b"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count(f", {-(-len(rows) * 2 // 100)}), REPARTITION_BY_NUM") == 2  # as many tasks as the rows ask for
    assert not any("hashpartitioning(dataset_ts" in x and "ENSURE" in x and "hash#" in x for x in plan.split("\n"))
    assert {(r.dataset_ts.year, r.column, r.n, r.distinct_exact, r.distinct_ok, r.quantiles_ok) for r in got.collect()} == {
        (y, c, sum(r[2] is not None and r[2].year == y for r in rows),
         len({r[i] for r in rows if r[2] is not None and r[2].year == y and r[i] is not None}), True, True)
        for y in (1995, 1996) for i, c in enumerate("ab")}
