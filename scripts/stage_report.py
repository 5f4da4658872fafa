"""Stage and task times of the headline profiles, from Spark's event log.

Usage: python scripts/stage_report.py [sf_dir]

Runs each plan once with the event log written to a fresh scratch folder,
then prints per stage: tasks, max and median task time, input bytes and
shuffle bytes written/read.  A stage whose max task time is far above its
median is a straggler (skew); small shuffle bytes against input bytes show
the map-side partial aggregation at work.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.operators.profile import profile  # noqa: E402
from strata.session import local_session  # noqa: E402


def stage_table(log_file: str) -> list[dict]:
    tasks: dict[tuple[int, int], list[dict]] = {}
    names: dict[tuple[int, int], str] = {}
    for line in open(log_file):
        ev = json.loads(line)
        kind = ev.get("Event")
        if kind == "SparkListenerTaskEnd":
            key = (ev["Stage ID"], ev["Stage Attempt ID"])
            info, metrics = ev["Task Info"], ev.get("Task Metrics") or {}
            sw = metrics.get("Shuffle Write Metrics", {})
            sr = metrics.get("Shuffle Read Metrics", {})
            tasks.setdefault(key, []).append({
                "ms": info["Finish Time"] - info["Launch Time"],
                "in": metrics.get("Input Metrics", {}).get("Bytes Read", 0),
                "sw": sw.get("Shuffle Bytes Written", 0),
                "sr": sr.get("Remote Bytes Read", 0) + sr.get("Local Bytes Read", 0),
            })
        elif kind == "SparkListenerStageCompleted":
            si = ev["Stage Info"]
            names[(si["Stage ID"], si["Stage Attempt ID"])] = si["Stage Name"].split(" at ")[0]
    rows = []
    for key in sorted(tasks):
        ts = tasks[key]
        ms = [t["ms"] for t in ts]
        rows.append({"stage": key[0], "name": names.get(key, "?"), "tasks": len(ts),
                     "max_ms": max(ms), "median_ms": statistics.median(ms),
                     "input_mb": round(sum(t["in"] for t in ts) / 1e6, 2),
                     "shuffle_write_mb": round(sum(t["sw"] for t in ts) / 1e6, 3),
                     "shuffle_read_mb": round(sum(t["sr"] for t in ts) / 1e6, 3)})
    return rows


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="strata-eventlog-")
    spark = local_session(8, extra={"spark.eventLog.enabled": "true",
                                    "spark.eventLog.dir": f"file://{log_dir}",
                                    "spark.eventLog.rolling.enabled": "false",
                                    "spark.eventLog.compress": "false"})
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    plans = {
        "per_day": profile(li, "l_shipdate", "D"),
        "global": profile(li),
        "skewed_key_returnflag": profile(li, by="l_returnflag"),
        "per_day_row_shuffle": profile(li, "l_shipdate", "D", row_shuffle=True),
    }
    for name, df in plans.items():
        spark.sparkContext.setJobDescription(name)
        df.write.format("noop").mode("overwrite").save()
    spark.stop()
    log = max(glob.glob(os.path.join(log_dir, "*")), key=os.path.getmtime)
    print(f"event log: {log}")
    print(f"{'stage':>5} {'tasks':>5} {'max_ms':>7} {'med_ms':>7} {'in_MB':>8} {'shW_MB':>8} {'shR_MB':>8}  name")
    for r in stage_table(log):
        print(f"{r['stage']:>5} {r['tasks']:>5} {r['max_ms']:>7} {r['median_ms']:>7.0f} "
              f"{r['input_mb']:>8} {r['shuffle_write_mb']:>8} {r['shuffle_read_mb']:>8}  {r['name']}")


if __name__ == "__main__":
    main()
