"""Benchmark of the headline queries.

Runs each query fully (written to Spark's ``noop`` sink, so nothing is
collected to the driver) on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1)
with ``local[$BENCH_CPUS]`` and prints one JSON line.

Headline queries mirror the reference's jobs:
  profile_by_day       the product job: per-day profile of every lineitem column
  profile_global       'less-shuffle': one profile of the whole table
  profile_hot_key      keyed by l_returnflag, each key holding a third of the rows
  profile_by_day_row_shuffle  the per-day profile with the unclustered-input plan
  profile_epoch_day    methods 1/2/3/window: per-day profile keyed by epoch seconds
  count_by_day         'counts' control
  count_by_day_batched '1-control': counts through size-bounded batches
  distinct_days        'noop': the day keys only
  rollup_day_to_month  merge of stored daily profiles into months
  profile_text         text-heavy table (documents), length metrics of whole texts
  stream_panes         file replay as a stream, one pane per file, merged
  stream_windows       file replay into day windows in the state store (watermark)
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from strata.functions.periods import epoch_seconds  # noqa: E402
from strata.operators.counts import (  # noqa: E402
    count_per_period, count_per_period_batched, distinct_periods,
)
from strata.operators.merge import rollup  # noqa: E402
from strata.operators.profile import profile  # noqa: E402
from strata.session import checkpoint_root, local_session  # noqa: E402
from strata.sinks.writers import read_profiles, write_profiles  # noqa: E402
from strata.streaming.panes import merge_panes, profile_stream  # noqa: E402
from strata.streaming.windows import profile_stream_windowed  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    root = checkpoint_root(spark)
    run_id = uuid.uuid4().hex[:10]

    def table(name):
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    def run(df):
        df.write.format("noop").mode("overwrite").save()

    stored = f"{root}/bench-{run_id}/daily"

    def q_profile_by_day():
        # the product job writes its store; later queries read it back
        write_profiles(profile(table("lineitem"), "l_shipdate", "D"), stored)

    def q_profile_epoch_day():
        ev = table("events")
        ev = ev.withColumn("time", epoch_seconds(F.col("ts"), ev.schema["ts"].dataType))
        run(profile(ev, "time", "D", unit="s", null_dates="epoch"))

    def q_stream_panes():
        ev = table("events")
        stream = (spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1)
                  .parquet(os.path.join(sf_dir, "{events}.parquet")))
        out = f"{root}/bench-{run_id}/panes-{uuid.uuid4().hex[:8]}"
        profile_stream(stream, out, "ts", "D", checkpoint=f"{out}/_checkpoint",
                       trigger={"availableNow": True}).awaitTermination()
        run(merge_panes(spark, out))

    def q_stream_windows():
        ev = table("events")
        stream = spark.readStream.schema(ev.schema).parquet(os.path.join(sf_dir, "{events}.parquet"))
        name = f"bench_windows_{uuid.uuid4().hex[:8]}"
        (profile_stream_windowed(stream, "ts", "1 day", watermark="0 seconds")
         .writeStream.format("noop").queryName(name).outputMode("append")
         .option("checkpointLocation", f"{root}/bench-{run_id}/{name}")
         .trigger(availableNow=True).start().awaitTermination())

    plan = {
        "profile_by_day": q_profile_by_day,
        "profile_global": lambda: run(profile(table("lineitem"))),
        "profile_hot_key": lambda: run(profile(table("lineitem"), by="l_returnflag")),
        "profile_by_day_row_shuffle": lambda: run(
            profile(table("lineitem"), "l_shipdate", "D", row_shuffle=True)),
        "profile_epoch_day": q_profile_epoch_day,
        "count_by_day": lambda: run(count_per_period(table("lineitem"), "l_shipdate", "D")),
        "count_by_day_batched": lambda: run(
            count_per_period_batched(table("lineitem"), "l_shipdate", "D", batch_size=10_000)),
        "distinct_days": lambda: run(distinct_periods(table("lineitem"), "l_shipdate", "D")),
        "rollup_day_to_month": lambda: run(rollup(read_profiles(spark, stored), "M")),
        "profile_text": lambda: run(profile(table("documents"))),
        "stream_panes": q_stream_panes,
        "stream_windows": q_stream_windows,
    }

    # Warm-up (JIT, class loading, codegen cache) on the smallest scale of the
    # same schemas when it exists, so the timings are steady-state; the timed
    # queries below never reuse cached data.
    warm_dir = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if not os.path.isdir(warm_dir):
        warm_dir = sf_dir
    run(profile(spark.read.parquet(f"{warm_dir}/lineitem.parquet"), "l_shipdate", "D"))
    run(profile(spark.read.parquet(f"{warm_dir}/documents.parquet")))

    # Each query runs three times; the steady-state (best) time is reported
    # and the first run is kept next to it.  Runs never share cached data.
    times, first = {}, {}
    for name, fn in plan.items():
        runs = []
        for _ in range(3):
            t0 = time.perf_counter()
            fn()
            runs.append(round(time.perf_counter() - t0, 3))
        first[name], times[name] = runs[0], min(runs)

    lineitem_rows = table("lineitem").count()
    total = round(sum(times.values()), 3)
    print(json.dumps({
        "metric": "headline_total",
        "value": total,
        "unit": "sec",
        "queries": times,
        "first_run": first,
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "lineitem_rows": lineitem_rows,
        "profile_by_day_rows_per_sec": round(lineitem_rows / times["profile_by_day"]),
        "cpus": cpus,
    }))


if __name__ == "__main__":
    main()
