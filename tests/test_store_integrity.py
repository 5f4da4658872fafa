"""Runs replaced as a unit, top-k widths through merges, exact values through
streaming batches, and the watermark after a restart."""

import datetime as dt
import math
import time

import pytest
from pyspark.sql import functions as F

from strata.functions.metrics import SketchConfig
from strata.operators.merge import merge_profiles, merge_stores, rollup
from strata.operators.profile import profile
from strata.operators.views import frequent_items
from strata.plans.jobs import profile_job
from strata.sinks.writers import read_merged, read_profiles, write_profiles, write_run
from strata.streaming.batches import stream_group_into_batches
from strata.streaming.panes import PaneWriter, pane_report


def _days(spark, *days):
    return spark.createDataFrame([(dt.datetime(2024, 1, 1) + dt.timedelta(days=d), d) for d in days],
                                 "ts timestamp_ntz, x bigint")


def test_a_shorter_rerun_replaces_its_run(spark, tmp_path):
    out = str(tmp_path / "history")
    write_run(profile(_days(spark, 2, 40), "ts", "M"), out, "r/1")
    write_run(profile(_days(spark, 3), "ts", "M"), out, "other")
    write_run(profile(_days(spark, 2), "ts", "M"), out, "r/1")
    got = read_merged(spark, out).where("column = 'x'").select("dataset_ts", "n").collect()
    assert [tuple(r) for r in got] == [(dt.datetime(2024, 1, 31), 2)]


def test_a_run_uploads_only_its_own_profiles(spark, tmp_path):
    out, seen = str(tmp_path / "history"), tmp_path / "seen"
    seen.mkdir()
    target = str(seen)

    def writer(rows):
        import os
        import uuid
        for key, _ in rows:
            with open(os.path.join(target, uuid.uuid4().hex), "w") as f:
                f.write(key)

    write_run(profile(_days(spark, 2), "ts", "M"), out, "first")
    _days(spark, 40).createOrReplaceTempView("later_days")
    profile_job(spark, table="later_days", date_column="ts", freq="M", output=out, run_id="second", writer=writer)
    keys = {p.read_text() for p in seen.iterdir()}
    assert keys == {"dataset/2024-02-29T00:00:00/ts", "dataset/2024-02-29T00:00:00/x"}


def test_a_merge_keeps_the_width_of_topk(spark):
    df = spark.range(1800).select((F.col("id") % 600).alias("x"))
    store = profile(df, sketches=SketchConfig(topk_capacity=2000))
    merged = merge_profiles(store)
    assert merged.select("topk.maxItemsTracked").first()[0] == 2000
    assert frequent_items(merged, 1000).count() == 600
    with pytest.raises(Exception, match="(?i)sketch|size|track"):
        merge_stores([store, profile(df)]).collect()
    assert merge_stores([store, profile(df)], sketches=SketchConfig(topk_capacity=2000)).count() == 1


def test_batches_keep_every_value(spark, tmp_path):
    df = spark.sql("""
        SELECT * FROM VALUES
          (double('NaN'), 9007199254740993, CAST(1.2345678901 AS DECIMAL(38,10)), 'a\\nb', X'00FF', 'k'),
          (NULL, 9007199254740995, NULL, NULL, NULL, 'k'),
          (double('-Infinity'), NULL, CAST(-7 AS DECIMAL(38,10)), '', X'', 'k'),
          (0.1D, 9223372036854775807, CAST(12345678901234567890.5 AS DECIMAL(38,10)), '\\u00e9"', X'22', 'k')
        AS t(d, i, m, s, b, k)""")
    df = df.withColumn("ts", F.expr("timestamp_ntz'2024-01-10 01:02:03.123457'")).withColumn(
        "tz", F.expr("timestamp'2024-01-10 01:02:03.000001Z'")).withColumn("l", F.array(F.lit(1), F.lit(None).cast("int")))
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    out = stream_group_into_batches(stream, "k", 2, shards=1)
    q = (out.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp"))
         .option("path", str(tmp_path / "out")).start())
    # processing-time timeouts keep such a query going: wait for its first batch
    deadline = time.time() + 60
    while not (tmp_path / "out" / "_spark_metadata" / "0").exists() and time.time() < deadline:
        time.sleep(0.5)
    q.stop()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r[0] for r in got.groupBy("batch_id").count().select("count").collect()) == [2, 2]

    def rows(frame):
        plain = lambda v: "nan" if isinstance(v, float) and math.isnan(v) else v
        return sorted((tuple(plain(v) for v in r) for r in frame.select(*df.columns).collect()), key=repr)

    assert rows(got) == rows(df)


def test_the_watermark_never_falls_after_a_restart(spark, tmp_path):
    path = str(tmp_path)
    PaneWriter(path, "ts", "D", lateness="1 day")(_days(spark, 20), 0)
    again = PaneWriter(path, "ts", "D", lateness="1 day")
    again(_days(spark, 19), 1)
    again(_days(spark, 18), 2)  # behind day 19, the watermark of pane 0
    again(_days(spark, 18), 2)  # a replay decides alike
    late = {r.pane: r.late_rows for r in pane_report(spark, path).collect()}
    assert late == {0: 0, 1: 0, 2: 1}


def test_roll_up_refuses_periods_that_do_not_nest(spark, tmp_path):
    df = spark.createDataFrame([("2024-01-30", 1), ("2024-03-05", 2)], "d string, x int").withColumn("d", F.to_date("d"))
    weekly = profile(df, "d", "W")
    with pytest.raises(ValueError):
        rollup(weekly, "M")
    write_profiles(weekly, str(tmp_path / "weekly"))
    with pytest.raises(ValueError):
        rollup(read_profiles(spark, str(tmp_path / "weekly")), "M")
    with pytest.raises(ValueError):  # a rolled-up store knows its new frequency
        rollup(rollup(profile(df, "d", "D"), "M"), "W")
    months = rollup(rollup(profile(df, "d", "D"), "M"), "Q").where("column = 'x'").collect()
    assert [(str(r.dataset_ts)[:10], r.n) for r in months] == [("2024-03-31", 2)]


def test_floats_and_doubles_count_as_the_same_values(spark):
    base = spark.range(1000).selectExpr("cast(id / 4 as double) as x")
    stores = [profile(base.selectExpr(f"cast(x as {t}) as x")) for t in ("float", "double", "decimal(12,2)")]
    got = merge_stores(stores).selectExpr("hll_sketch_estimate(hll) as e", "n").collect()
    assert [r.n for r in got] == [3000] and 950 <= got[0].e <= 1050
