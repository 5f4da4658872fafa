"""Results must not change when tasks fail and are retried, or when a stream
is stopped and restarted from its checkpoint."""

import os
import subprocess
import sys
import textwrap

from pyspark.sql import functions as F

from strata import exact_metrics, profile
from strata.streaming import merge_panes, pane_report, profile_stream
from tests.conftest import ROOT, SF001

RETRY_SCRIPT = textwrap.dedent("""
    import sys
    sys.path.insert(0, {root!r})
    from pyspark import TaskContext
    from pyspark.sql import SparkSession
    from strata import exact_metrics, profile

    spark = (SparkSession.builder.master("local[4,3]")  # up to 3 attempts per task
             .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "8")
             .getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    li = spark.read.parquet({path!r}).repartition(70)  # wide input: salted two-level tree

    def fail_first_attempt(batches):
        ctx = TaskContext.get()
        if ctx.partitionId() in (3, 41) and ctx.attemptNumber() == 0:
            raise RuntimeError("injected task failure")
        yield from batches

    flaky = li.mapInPandas(fail_first_attempt, li.schema)
    got = sorted(map(tuple, exact_metrics(profile(flaky, "l_shipdate", "M")).collect()))
    want = sorted(map(tuple, exact_metrics(profile(li, "l_shipdate", "M")).collect()))
    print("SAME" if got == want and got else "DIFFERENT")
""")


def test_profile_is_unchanged_by_task_retries(tmp_dir):
    script = os.path.join(tmp_dir, "retry.py")
    with open(script, "w") as f:
        f.write(RETRY_SCRIPT.format(root=ROOT, path=f"{SF001}/lineitem.parquet"))
    out = subprocess.run([sys.executable, script], capture_output=True, text=True, timeout=600)
    assert "SAME" in out.stdout, out.stdout[-2000:] + out.stderr[-3000:]


def test_stream_restarts_from_checkpoint_exactly_once(spark, tmp_dir):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    staged = os.path.join(tmp_dir, "staged")
    ev.repartition(5).write.parquet(staged)
    files = sorted(f for f in os.listdir(staged) if f.endswith(".parquet"))
    src = os.path.join(tmp_dir, "src")
    os.makedirs(src)
    out, ck = os.path.join(tmp_dir, "panes"), os.path.join(tmp_dir, "ck")

    def land(names):  # files arrive in the source folder
        for name in names:
            os.link(os.path.join(staged, name), os.path.join(src, name))

    def run():  # one run of the job; it stops when caught up, as if it died there
        stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(src)
        profile_stream(stream, out, "ts", "D", checkpoint=ck,
                       trigger={"availableNow": True}).awaitTermination()

    land(files[:2])
    run()
    land(files[2:4])
    run()          # restart: only the new files
    land(files[4:])
    run()
    run()          # a restart with nothing new adds nothing
    report = pane_report(spark, out)
    assert report.count() == 5
    assert report.agg(F.sum("rows")).first()[0] == ev.count()
    merged = exact_metrics(merge_panes(spark, out))
    direct = exact_metrics(profile(ev, "ts", "D"))
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, direct.collect()))


def test_lateness_survives_a_restart(spark, tmp_dir):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    cut = "ts >= TIMESTAMP_NTZ'2024-01-10 00:00:00'"
    staged_new, staged_old = os.path.join(tmp_dir, "new"), os.path.join(tmp_dir, "old")
    ev.where(cut).coalesce(1).write.parquet(staged_new)
    ev.where(f"NOT ({cut})").coalesce(1).write.parquet(staged_old)
    src = os.path.join(tmp_dir, "src")
    os.makedirs(src)
    out, ck = os.path.join(tmp_dir, "panes"), os.path.join(tmp_dir, "ck")

    def land(folder, tag):
        for name in os.listdir(folder):
            if name.endswith(".parquet"):
                os.link(os.path.join(folder, name), os.path.join(src, f"{tag}-{name}"))

    def run():  # a new query object each time: the writer starts with no memory
        stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(src)
        profile_stream(stream, out, "ts", "D", checkpoint=ck, lateness="2 days",
                       trigger={"availableNow": True}).awaitTermination()

    land(staged_new, "a")
    run()
    land(staged_old, "b")  # arrives after the restart and is older than the watermark
    run()
    late = ev.where(f"NOT ({cut})").count()
    assert pane_report(spark, out).agg(F.sum("late_rows")).first()[0] == late
    kept = merge_panes(spark, out).where("column = 'event_id'").agg(F.sum("n")).first()[0]
    assert kept == ev.count() - late
