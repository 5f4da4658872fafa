"""Command line of the product job, for ``spark-submit``.

    spark-submit --py-files strata.zip strata/plans/cli.py \\
        --input "select * from sales.orders" --date-column o_orderdate --freq D \\
        --output s3://bucket/profiles/orders

The input is a table name or SQL over the session catalog, or ``--path`` with
``--format`` for files.  Parameters are validated before any Spark work.
"""

from __future__ import annotations

import argparse
import logging
import re

from pyspark.sql import SparkSession

from strata.functions.periods import parse_frequency
from strata.plans.jobs import profile_job

# Accepted logging levels.
LOG_LEVELS = ["DEBUG", "INFO", "WARN", "WARNING", "ERROR", "FATAL", "CRITICAL"]


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="strata-profile", description=__doc__.split("\n")[0])
    src = p.add_mutually_exclusive_group(required=True)
    src.add_argument("--input", help="table name or SQL query")
    src.add_argument("--path", help="files to read (see --format)")
    p.add_argument("--format", default="parquet", help="Spark source format for --path")
    p.add_argument("--date-column", help="timestamp/date column; omit for one global profile")
    p.add_argument("--freq", default="D", help="period frequency (D, H, W, W-MON, M, MS, Q, A, B, SM, 2D, ...)")
    p.add_argument("--unit", choices=["s", "ms", "us", "ns"], help="unit of an integral date column")
    p.add_argument("--null-dates", default="drop", choices=["drop", "keep", "epoch", "error"])
    p.add_argument("--date-errors", default="raise", choices=["raise", "coerce"],
                   help="text dates that do not parse: fail, or count as missing")
    p.add_argument("--output", required=True, help="location of the profile store")
    p.add_argument("--columns", help="comma-separated columns to profile (default: all)")
    p.add_argument("--run-id", help="append this run to the store instead of replacing it")
    p.add_argument("--plan", default="partial", choices=["partial", "row-shuffle"],
                   help="aggregation plan: map-side partial sketches or row shuffle")
    p.add_argument("--logging-level", default="INFO", type=str.upper, choices=LOG_LEVELS)
    args = p.parse_args(argv)
    try:
        parse_frequency(args.freq)
    except ValueError as e:
        p.error(str(e))
    if not re.fullmatch(r"\S+", args.output):
        p.error("--output must be a path without spaces")
    return args


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parse_args(argv)
    level = "WARNING" if args.logging_level == "WARN" else args.logging_level
    logging.basicConfig(level=getattr(logging, level))
    log = logging.getLogger("strata")
    spark = spark or SparkSession.builder.appName("strata-profile").getOrCreate()
    columns = [c.strip() for c in args.columns.split(",")] if args.columns else None
    log.info("profiling %s per %s into %s", args.input or args.path, args.freq, args.output)
    profile_job(spark, args.input, table_path=args.path, format=args.format,
                date_column=args.date_column, freq=args.freq, unit=args.unit,
                null_dates=args.null_dates, columns=columns, output=args.output,
                run_id=args.run_id, date_errors=args.date_errors,
                row_shuffle=args.plan == "row-shuffle")
    log.info("done: %s", args.output)


if __name__ == "__main__":
    main()
