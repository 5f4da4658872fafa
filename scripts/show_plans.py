"""Write docs/PLANS.md: the physical plan of each main operator.

Usage: python scripts/show_plans.py [sf_dir]

Plans are printed by Spark (``explain``) and trimmed to the operator names
and key arguments, so the exchanges, pushed filters and aggregation steps of
each operator can be reviewed without running anything.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.operators.batches import group_into_batches  # noqa: E402
from strata.operators.counts import count_per_period, count_per_period_batched  # noqa: E402
from strata.operators.merge import rollup  # noqa: E402
from strata.operators.profile import profile  # noqa: E402
from strata.session import local_session  # noqa: E402
from strata.streaming.windows import profile_stream_windowed  # noqa: E402

WIDTH = 150


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    lines = []
    for line in buf.getvalue().splitlines():
        line = re.sub(r"#\d+L?", "", line)  # expression ids
        line = re.sub(r"functions=\[.*", "functions=[...]", line)
        line = re.sub(r"Arguments: inline\(.*", "inline(array(struct per column))", line)
        if "FileScan" in line:  # keep what reaches the reader: filters and columns
            pushed = re.search(r"PushedFilters: \[[^\]]*\]", line)
            schema = re.search(r"ReadSchema: \S+", line)
            line = (line.split(" [")[0] + " " + (pushed.group(0) if pushed else "") + ", "
                    + (schema.group(0) if schema else ""))
            lines.append(line)
            continue
        lines.append(line if len(line) <= WIDTH else line[:WIDTH] + " ...")
    return "\n".join(lines)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8)
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    wide = li.repartition(100)  # an input wider than one level: salted tree
    daily = profile(li, "l_shipdate", "D")
    cases = [
        ("profile per day (narrow input: rebalanced, one level)", daily),
        ("profile per day, input of 100 partitions (salted two-level tree)",
         profile(wide, "l_shipdate", "D", fanout=10)),
        ("profile per day, row_shuffle=True", profile(li, "l_shipdate", "D", row_shuffle=True)),
        ("global profile", profile(li)),
        ("roll-up of a daily store to months (merge)", rollup(daily, "M")),
        ("count per period", count_per_period(li, "l_shipdate", "D")),
        ("count per period through batches", count_per_period_batched(li, "l_shipdate", "D")),
        ("group into batches", group_into_batches(li, "l_returnflag", 1000)),
        ("windowed stream profile (state store, watermark)",
         profile_stream_windowed(spark.readStream.schema(li.schema).parquet(f"{sf}/{{lineitem}}.parquet"),
                                 "l_shipdate", "1 day", watermark="1 day")),
    ]
    out = ["# Physical plans", "",
           f"Generated by `python scripts/show_plans.py {sf}` (Spark's `explain`, trimmed:",
           "expression ids removed, aggregate function lists elided).", ""]
    for title, df in cases:
        out += [f"## {title}", "", "```", plan_text(df), "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "PLANS.md")
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(out))
    print(path)


if __name__ == "__main__":
    main()
