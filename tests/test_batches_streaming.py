import os

import pytest
from pyspark.sql import functions as F

from strata import exact_metrics, profile
from strata.operators.batches import batch_sizes, group_into_batches
from strata.operators.counts import count_per_period, count_per_period_batched, distinct_periods
from strata.streaming import merge_panes, pane_report, profile_stream
from tests.conftest import SF001


def test_batches_respect_size_and_keep_rows(spark):
    li = spark.read.parquet(f"{SF001}/lineitem.parquet").repartition(5)
    b = group_into_batches(li, "l_returnflag", 7)
    sizes = batch_sizes(b, "l_returnflag", 7).collect()
    assert all(r.sizes_ok and r.max_batch <= 7 for r in sizes)
    assert sum(r.n for r in sizes) == li.count()
    # dense packing: at most one partial batch per key and input partition
    for r in sizes:
        assert r.batches <= -(-r.n // 7) + 5


def test_batched_counts_equal_counts(spark):
    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    a = sorted(map(tuple, count_per_period(li, "l_shipdate", "W").collect()))
    b = sorted(map(tuple, count_per_period_batched(li, "l_shipdate", "W", batch_size=3).collect()))
    assert a == b
    assert distinct_periods(li, "l_shipdate", "W").count() == len(a)


def _replay_files(spark, tmp_dir, n=4):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    src = os.path.join(tmp_dir, "src")
    # one file per week so that replaying file by file moves event time forward
    for i, w in enumerate(sorted(r.w for r in ev.select(F.weekofyear("ts").alias("w")).distinct().collect())):
        ev.where(F.weekofyear("ts") == w).coalesce(1).write.parquet(os.path.join(src, f"part{i:02d}"))
    return ev, src


def test_stream_panes_merge_to_batch_profile(spark, tmp_dir):
    ev, src = _replay_files(spark, tmp_dir)
    stream = (spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1)
              .parquet(os.path.join(src, "*")))
    out = os.path.join(tmp_dir, "panes")
    q = profile_stream(stream, out, "ts", "D", checkpoint=os.path.join(tmp_dir, "ck"),
                       trigger={"availableNow": True})
    q.awaitTermination()
    assert pane_report(spark, out).count() > 1
    merged = exact_metrics(merge_panes(spark, out))
    direct = exact_metrics(profile(ev, "ts", "D"))
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, direct.collect()))


def test_stream_late_rows_dropped_only_with_lateness(spark, tmp_dir):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    src = os.path.join(tmp_dir, "src")
    late = ev.where("ts < TIMESTAMP_NTZ'2024-01-10 00:00:00'")
    recent = ev.where("ts >= TIMESTAMP_NTZ'2024-01-10 00:00:00'")
    recent.coalesce(1).write.parquet(os.path.join(src, "a"))
    late.coalesce(1).write.parquet(os.path.join(src, "b"))  # arrives after newer rows
    for lateness, expect_dropped in [(None, 0), ("2 days", late.count())]:
        tag = lateness or "none"
        stream = (spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1)
                  .parquet(os.path.join(src, "*")))
        out = os.path.join(tmp_dir, f"panes-{tag.replace(' ', '')}")
        q = profile_stream(stream, out, "ts", "D", lateness=lateness,
                           checkpoint=os.path.join(tmp_dir, f"ck-{tag.replace(' ', '')}"),
                           trigger={"availableNow": True})
        q.awaitTermination()
        dropped = pane_report(spark, out).agg(F.sum("late_rows")).first()[0]
        assert dropped == expect_dropped
        kept = merge_panes(spark, out).where("column = 'event_id'").agg(F.sum("n")).first()[0]
        assert kept == ev.count() - expect_dropped


def test_stream_group_into_batches(spark, tmp_dir):
    import time
    import uuid

    from strata.streaming.batches import stream_group_into_batches

    ev = spark.read.parquet(f"{SF001}/events.parquet")
    src = os.path.join(tmp_dir, "src")
    ev.repartition(3).write.parquet(src)
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(src)
    b = stream_group_into_batches(stream, "event_type", 50, max_wait="1 second", shards=2)
    name = "gib_" + uuid.uuid4().hex[:8]
    q = (b.writeStream.format("memory").queryName(name).outputMode("append")
         .option("checkpointLocation", os.path.join(tmp_dir, "ck"))
         .trigger(processingTime="1 second").start())
    total, t0 = ev.count(), time.time()
    try:
        while time.time() - t0 < 90 and spark.table(name).count() < total:
            time.sleep(1)
    finally:
        q.stop()
    out = spark.table(name)
    assert out.count() == total  # partial batches are flushed by the timeout
    assert out.groupBy("event_type", "batch_id").count().agg(F.max("count")).first()[0] <= 50
    assert sorted(out.drop("batch_id").collect()) == sorted(ev.collect())


def test_count_or_time_panes(spark, tmp_dir):
    import time

    ev, src = _replay_files(spark, tmp_dir)
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 2).parquet(os.path.join(src, "*"))
    out = os.path.join(tmp_dir, "panes")
    q = profile_stream(stream, out, "ts", "D", checkpoint=os.path.join(tmp_dir, "ck"),
                       pane_rows=10, pane_wait="1 second", shards=2,
                       trigger={"processingTime": "1 second"})
    total, t0 = ev.count(), time.time()
    try:
        while time.time() - t0 < 120:
            try:
                got = merge_panes(spark, out).where("column = 'event_id'").agg(F.sum("n")).first()[0]
            except Exception:  # noqa: BLE001 - no pane written yet
                got = None
            if got == total:
                break
            time.sleep(2)
    finally:
        q.stop()
    panes = spark.read.parquet(os.path.join(out, "panes"))
    assert panes.where("column = 'event_id'").agg(F.max("n")).first()[0] <= 10
    merged = exact_metrics(merge_panes(spark, out))
    direct = exact_metrics(profile(ev, "ts", "D"))
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, direct.collect()))


def test_windowed_stream_profile_with_watermark(spark, tmp_dir):
    import uuid

    from strata.streaming import profile_stream_windowed

    ev, src = _replay_files(spark, tmp_dir)  # one file per week, replayed in time order
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(os.path.join(src, "*"))
    long = profile_stream_windowed(stream, "ts", "1 day", watermark="1 day")
    name = "win_" + uuid.uuid4().hex[:8]
    q = (long.writeStream.format("memory").queryName(name).outputMode("append")
         .option("checkpointLocation", os.path.join(tmp_dir, "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    final = spark.table(name)
    days = [r.dataset_ts for r in final.select("dataset_ts").distinct().collect()]
    assert days  # windows whose end the watermark passed
    # in-order replay drops nothing: every emitted day equals the batch profile
    direct = exact_metrics(profile(ev, "ts", "D"), {"dataset_ts": "yyyy-MM-dd"}).where(
        F.col("dataset_ts").isin([d.strftime("%Y-%m-%d") for d in days]))
    got = exact_metrics(final, {"dataset_ts": "yyyy-MM-dd"})
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, direct.collect()))


def test_batch_profile_refuses_a_stream(spark):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    stream = spark.readStream.schema(ev.schema).parquet(f"{SF001}/{{events}}.parquet")
    with pytest.raises(ValueError, match="profile_stream"):
        profile(stream, "ts", "D")


def test_windowed_stream_with_out_of_order_files(spark, tmp_dir):
    """Spark keeps all data within the watermark delay and may still fold rows
    behind it into windows it has not finalized; what must hold is that every
    window is emitted once, with exact metrics, and the drop counter reads."""
    import uuid

    from strata.streaming import profile_stream_windowed, rows_dropped_by_watermark

    ev = spark.read.parquet(f"{SF001}/events.parquet")
    src = os.path.join(tmp_dir, "src")
    ev.where("ts >= TIMESTAMP_NTZ'2024-01-10 00:00:00'").coalesce(1).write.parquet(os.path.join(src, "a"))
    ev.where("ts < TIMESTAMP_NTZ'2024-01-10 00:00:00'").coalesce(1).write.parquet(os.path.join(src, "b"))
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(os.path.join(src, "*"))
    name = f"ooo_{uuid.uuid4().hex[:6]}"
    q = (profile_stream_windowed(stream, "ts", "1 day", watermark="1 day", columns=["event_id"])
         .writeStream.format("memory").queryName(name).outputMode("append")
         .option("checkpointLocation", os.path.join(tmp_dir, "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert rows_dropped_by_watermark(q) >= 0
    out = spark.table(name)
    assert out.count() == out.select("dataset_ts").distinct().count()  # each window once
    emitted = [r.dataset_ts.strftime("%Y-%m-%d") for r in out.select("dataset_ts").collect()]
    direct = exact_metrics(profile(ev, "ts", "D", columns=["event_id"]), {"dataset_ts": "yyyy-MM-dd"})
    got = exact_metrics(out, {"dataset_ts": "yyyy-MM-dd"})
    assert sorted(map(tuple, got.collect())) == \
        sorted(map(tuple, direct.where(F.col("dataset_ts").isin(emitted)).collect()))


def test_stream_batches_append_to_state_and_keep_batch_ids(spark, tmp_dir):
    """Held rows survive a restart, full batches leave at once, names cannot clash."""
    import time

    from strata.streaming.batches import batch_column, stream_group_into_batches

    ev = spark.read.parquet(f"{SF001}/events.parquet").withColumn("batch_id", F.col("event_id") * 2)
    src, out, ck = (os.path.join(tmp_dir, x) for x in ("src", "out", "ck"))
    ev.where("event_id % 2 = 0").coalesce(1).write.parquet(os.path.join(src, "a"))
    stream = spark.readStream.schema(ev.schema).parquet(os.path.join(src, "*"))
    name = batch_column(stream)
    assert name == "batch_id_"

    def run(wait, until):
        b = stream_group_into_batches(stream, "event_type", 40, max_wait=wait, shards=1)
        q = (b.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)
             .trigger(processingTime="1 second").start())
        t0 = time.time()
        try:
            while time.time() - t0 < 90:
                time.sleep(1)
                rows = spark.read.schema(b.schema).parquet(out) if os.path.exists(out) else None
                if rows is not None and rows.count() >= until:
                    return rows.collect()
        finally:
            q.stop()
        raise AssertionError("the stream did not emit its rows")

    half = ev.where("event_id % 2 = 0").groupBy("event_type").count().collect()
    full = sum(r["count"] // 40 * 40 for r in half)
    first = run("10 minutes", full)
    assert len(first) == full  # partial batches wait
    ev.where("event_id % 2 = 1").coalesce(1).write.parquet(os.path.join(src, "b"))
    both = ev.groupBy("event_type").count().collect()
    rows = run("10 minutes", sum(r["count"] // 40 * 40 for r in both))
    sizes = {}
    for r in rows:
        sizes[r.event_type, r[name]] = sizes.get((r.event_type, r[name]), 0) + 1
    assert set(sizes.values()) == {40} and len({r.event_id for r in rows}) == len(rows)
    assert all(r.batch_id == 2 * r.event_id for r in rows)


def _late_stream(spark, tmp_dir, **kw):
    """Newer rows first, then older ones, then the oldest with rows without a date."""
    ev = spark.read.parquet(f"{SF001}/events.parquet").withColumn(
        "ts", F.when(F.col("event_id") % 97 > 0, F.col("ts")))
    src, out = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "panes")
    deal = F.when(F.col("ts") >= F.lit("2024-01-16 00:00:00").cast("timestamp_ntz"), 0).when(F.col("ts").isNotNull(), F.col("event_id") % 2 + 1).otherwise(2)
    for k in range(3):
        ev.where(deal == k).coalesce(1).write.parquet(os.path.join(src, str(k)))
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(os.path.join(src, "*"))
    profile_stream(stream, out, "ts", "D", checkpoint=os.path.join(tmp_dir, "ck"), lateness="18 days",
                   trigger={"availableNow": True}, **kw).awaitTermination()
    newest = ev.where(deal == 0).agg(F.max("ts")).first()[0]
    import datetime as dt
    return ev, out, (F.col("ts") >= F.lit(newest - dt.timedelta(days=18)).cast("timestamp_ntz")) | F.col("ts").isNull()


def test_late_rows_are_kept_aside_and_corrected(spark, tmp_dir):
    from strata.streaming.panes import correct_panes

    ev, out, on_time = _late_stream(spark, tmp_dir, late="keep", null_dates="keep")
    answer = lambda s: sorted(map(tuple, exact_metrics(s).collect()), key=repr)
    kept = answer(profile(ev.where(on_time), "ts", "D", null_dates="keep"))
    everything = answer(profile(ev, "ts", "D", null_dates="keep"))
    assert kept != everything and answer(merge_panes(spark, out)) == kept
    late = spark.read.parquet(os.path.join(out, "late"))
    assert sorted(r.event_id for r in late.collect()) == sorted(r.event_id for r in ev.where(~on_time).collect())
    assert answer(merge_panes(spark, out, corrections=True)) == kept  # nothing corrected yet
    assert correct_panes(spark, out, "ts", "D", null_dates="keep") == [1, 2]
    assert answer(merge_panes(spark, out, corrections=True)) == everything
    assert correct_panes(spark, out, "ts", "D", null_dates="keep") == []  # once
    assert answer(merge_panes(spark, out)) == kept


def test_panes_compact_without_the_newest(spark, tmp_dir):
    from strata.streaming.panes import compact_panes, pane_history

    ev, out, _ = _late_stream(spark, tmp_dir, late="drop")
    answer = lambda s: sorted(map(tuple, exact_metrics(s).collect()), key=repr)
    want = answer(merge_panes(spark, out))
    assert compact_panes(spark, out).folded == {"pane=0", "pane=1"}
    assert answer(merge_panes(spark, out)) == want
    assert pane_history(spark, out).vacuum() == ["pane=0", "pane=1"]
    assert answer(merge_panes(spark, out)) == want


def test_pane_arguments(spark, tmp_dir):
    from strata.streaming.panes import PaneWriter

    for kw in ({"late": "later"}, {"by": "pane"}, {"by": ["batch_id"]}):
        with pytest.raises(ValueError):
            PaneWriter(tmp_dir, "ts", **kw)


def test_stream_is_delivered_to_a_service_once(spark, tmp_dir):
    """Two starts of one stream, the second after its last commit was lost: every pane's
    record has one key, and a committed epoch is not sent again."""
    import glob
    import json

    from strata.sinks.service import ProfileServiceSink
    from strata.streaming import profile_stream_windowed

    ev, src = _replay_files(spark, tmp_dir)
    box, ck = os.path.join(tmp_dir, "box"), os.path.join(tmp_dir, "ck")
    os.makedirs(box)

    class Recorder(ProfileServiceSink):
        @classmethod
        def name(cls):
            return "recorder"

        def send(self, records):
            import uuid
            with open(f"{box}/sent-{uuid.uuid4().hex}", "w") as f:
                f.writelines(json.dumps([r["key"], r["column"], r["n"]]) + "\n" for r in records)

        def delivered(self, epoch):
            return os.path.exists(f"{box}/epoch-{epoch}")

        def on_epoch(self, epoch, delivered):
            with open(f"{box}/epoch-{epoch}", "a") as f:
                f.write(f"{delivered}\n")

    spark.dataSource.register(Recorder)

    def run():
        stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(os.path.join(src, "*"))
        long = profile_stream_windowed(stream, "ts", "1 day", watermark="0 seconds", columns=["event_id", "value"])
        (long.writeStream.format("recorder").option("dataset_id", "ev").option("batch_size", 7).outputMode("append")
         .option("checkpointLocation", ck).trigger(availableNow=True).start()).awaitTermination()

    def sent():
        return [json.loads(x) for p in sorted(glob.glob(f"{box}/sent-*")) for x in open(p)]

    run()
    first = sent()
    epochs = sorted(int(p.rpartition("-")[2]) for p in glob.glob(f"{box}/epoch-*"))
    assert first and len({k for k, *_ in first}) == len(first)
    assert sum(int(x) for e in epochs for x in open(f"{box}/epoch-{e}")) == len(first)
    # the stream dies after the service's commit and before its own: the epoch comes again
    for name in (str(epochs[-1]), f".{epochs[-1]}.crc"):
        if os.path.exists(os.path.join(ck, "commits", name)):
            os.unlink(os.path.join(ck, "commits", name))
    run()
    assert sent() == first
    # and before the service's commit, too: sent again under the same keys
    for name in (str(epochs[-1]), f".{epochs[-1]}.crc"):
        if os.path.exists(os.path.join(ck, "commits", name)):
            os.unlink(os.path.join(ck, "commits", name))
    os.unlink(f"{box}/epoch-{epochs[-1]}")
    run()
    again = sent()
    assert {tuple(r) for r in again} == {tuple(r) for r in first}
    days = {k.split("/")[2][:10] for k, *_ in first}
    direct = exact_metrics(profile(ev, "ts", "D", columns=["event_id", "value"]), {"dataset_ts": "yyyy-MM-dd"})
    want = {(r.dataset_ts, r.column, r.n) for r in direct.collect() if r.dataset_ts in days}
    assert {(k.split("/")[2][:10], c, n) for k, c, n in first} == want
