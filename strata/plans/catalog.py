"""Registered queries: one per operator of the inventory, each with its exact
SQL twin (``ORACLE``) where SQL can express the result.

Every query reads whole test tables from ``sf_dir``; outputs use text labels,
BIGINT counts and rounded moments so that a second engine can reproduce them
exactly.  Groups:

* sources: ``scan_table``, ``scan_query``, ``scan_input``;
* scalar and filter steps: ``day_floor_*``, ``parse_*``, ``drop_null_dates``,
  ``query_filter_limit``, ``query_order_by``;
* control jobs: ``count_by_day``, ``count_by_epoch_day``, ``count_by_day_batched``,
  ``distinct_days``, ``group_into_batches``, ``tumbling_day``;
* period labels: ``bucket_<freq>`` for every supported frequency;
* profiles: ``profile_by_period_<freq>``, ``profile_global*``, keyed and hot-key
  profiles, epoch-day profile, roll-up, lookup, store merges, history runs,
  Parquet and JSON store round trips, frequent items, sketch bounds
  (``profile_table``), sizes (rows only), user metrics;
* streams: ``stream_panes_by_day`` (discarding panes), ``stream_windowed_by_day``
  (state-store windows under a watermark).
"""

from __future__ import annotations

import datetime as dt
import os
import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.metrics import SketchConfig
from strata.functions.periods import (
    day_start_epoch, epoch_seconds, from_epoch, parse_frequency, parse_timestamp, period_label,
)
from strata.operators import heavy, sniff
from strata.operators.batches import batch_columns, batch_sizes, group_into_batches
from strata.operators.custom import custom_profile
from strata.operators.counts import (
    count_per_epoch_day, count_per_period, count_per_period_batched, distinct_periods,
)
from strata.operators.merge import lookup, merge_profiles, merge_stores, rollup
from strata.operators.profile import PERIOD_COLUMN, profile, with_period
from strata.operators.views import (
    across_types, exact_extrema, exact_metrics, frequent_items, profile_size, profile_table,
)
from strata.plans.accuracy import global_sketch_accuracy, merged_sketch_accuracy, merged_topk_accuracy
from strata.operators.user_aggregates import Field, UserAggregate, finish_user, merge_user, rollup_user, user_profile
from strata.plans.oracle import TABLE_COLUMNS, count_sql, label_sql, profile_sql, q
from strata.session import checkpoint_root
from strata.sinks.history import History
from strata.sinks.writers import (
    fan_out, read_merged, read_profiles, read_text_profiles, write_profiles, write_run, write_text,
)
from strata.sources.tables import (
    enforce_schema, read_csv, read_input, read_table, register_tables, split_rows, table_path,
)
from strata.streaming.batches import stream_group_into_batches
from strata.streaming.panes import compact_panes, correct_panes, merge_panes, pane_history, profile_stream
from strata.streaming.windows import profile_stream_windowed

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _fmt(freq: str) -> dict[str, str]:
    return {PERIOD_COLUMN: parse_frequency(freq).label_format}


def _label_text(df: DataFrame, freq: str) -> DataFrame:
    return df.withColumn(PERIOD_COLUMN, F.date_format(PERIOD_COLUMN, parse_frequency(freq).label_format))


# --------------------------------------------------------------------------
# Sources
# --------------------------------------------------------------------------

@register("scan_table", "SELECT * FROM customer")
def scan_table(spark, d):
    register_tables(spark, d, ["customer"])
    return read_input(spark, table="customer")


SCAN_QUERY = ("SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total "
              "FROM orders WHERE o_orderstatus = 'F' GROUP BY o_orderpriority")


@register("scan_query", SCAN_QUERY)
def scan_query(spark, d):
    register_tables(spark, d, ["orders"])
    return read_input(spark, query=SCAN_QUERY)


@register("scan_input", "SELECT * FROM nation")
def scan_input(spark, d):
    register_tables(spark, d, ["nation"])
    return read_input(spark, "nation")  # a bare identifier resolves to the table


# --------------------------------------------------------------------------
# Projections, filters, parsing
# --------------------------------------------------------------------------

_EPOCH_S = "CAST(floor(epoch_us(ts) / 1000000) AS BIGINT)"


@register("day_floor_epoch",
          f"SELECT event_id, {_EPOCH_S} AS time, {_EPOCH_S} - ({_EPOCH_S} % 86400) AS day_start "
          "FROM events")
def day_floor_epoch(spark, d):
    ev = read_table(spark, d, "events")
    t = epoch_seconds(F.col("ts"), ev.schema["ts"].dataType)
    return ev.select("event_id", t.alias("time"), day_start_epoch(t).alias("day_start"))


@register("day_floor_ts", f"SELECT event_id, {label_sql('D', 'ts')} AS day FROM events")
def day_floor_ts(spark, d):
    ev = read_table(spark, d, "events")
    return ev.select("event_id", F.date_format(period_label(F.col("ts"), "D"), "yyyy-MM-dd").alias("day"))


@register("drop_null_dates", count_sql("events", "D", "ts"))
def drop_null_dates(spark, d):
    ev = read_table(spark, d, "events")
    return _label_text(count_per_period(ev, "ts", "D", null_dates="drop"), "D")


QUERY_FILTER_LIMIT = ("SELECT count(*) AS n FROM "
                      "(SELECT * FROM orders WHERE o_orderdate IS NOT NULL LIMIT 10) t")


@register("query_filter_limit", QUERY_FILTER_LIMIT)
def query_filter_limit(spark, d):
    register_tables(spark, d, ["orders"])
    return read_input(spark, query=QUERY_FILTER_LIMIT)


QUERY_ORDER_BY = "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderdate"


@register("query_order_by", QUERY_ORDER_BY)
def query_order_by(spark, d):
    register_tables(spark, d, ["orders"])
    return read_input(spark, query=QUERY_ORDER_BY)


@register("parse_ts", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS parsed FROM events")
def parse_ts(spark, d):
    ev = read_table(spark, d, "events")
    text = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit(" UTC"))
    return ev.select("event_id", F.date_format(parse_timestamp(text), "yyyy-MM-dd HH:mm:ss.SSSSSS")
                     .alias("parsed"))


@register("parse_epoch",
          f"SELECT event_id, strftime(make_timestamp({_EPOCH_S} * 1000000), '%Y-%m-%d %H:%M:%S') AS parsed "
          "FROM events")
def parse_epoch(spark, d):
    ev = read_table(spark, d, "events")
    t = epoch_seconds(F.col("ts"), ev.schema["ts"].dataType)
    return ev.select("event_id", F.date_format(from_epoch(t, "s"), "yyyy-MM-dd HH:mm:ss").alias("parsed"))


# --------------------------------------------------------------------------
# Counts per period (the control jobs)
# --------------------------------------------------------------------------

@register("count_by_day", count_sql("lineitem", "D", "l_shipdate"))
def count_by_day(spark, d):
    return _label_text(count_per_period(read_table(spark, d, "lineitem"), "l_shipdate", "D"), "D")


@register("count_by_epoch_day",
          f"SELECT {_EPOCH_S} - ({_EPOCH_S} % 86400) AS day_start, count(*) AS n FROM events GROUP BY 1")
def count_by_epoch_day(spark, d):
    ev = read_table(spark, d, "events")
    ev = ev.withColumn("time", epoch_seconds(F.col("ts"), ev.schema["ts"].dataType))
    return count_per_epoch_day(ev, "time")


@register("count_by_day_batched", count_sql("lineitem", "D", "l_shipdate"))
def count_by_day_batched(spark, d):
    li = read_table(spark, d, "lineitem")
    return _label_text(count_per_period_batched(li, "l_shipdate", "D", batch_size=10_000), "D")


@register("distinct_days",
          f"SELECT DISTINCT {label_sql('D', 'l_shipdate')} AS dataset_ts FROM lineitem "
          "WHERE l_shipdate IS NOT NULL")
def distinct_days(spark, d):
    return _label_text(distinct_periods(read_table(spark, d, "lineitem"), "l_shipdate", "D"), "D")


BATCH_SIZE = 10


@register("group_into_batches",
          f"SELECT {label_sql('D', 'l_shipdate')} AS dataset_ts, count(*) AS n, true AS sizes_ok "
          "FROM lineitem WHERE l_shipdate IS NOT NULL GROUP BY 1")
def group_into_batches_q(spark, d):
    li = with_period(read_table(spark, d, "lineitem"), "l_shipdate", "D")
    sizes = batch_sizes(group_into_batches(li, PERIOD_COLUMN, BATCH_SIZE), PERIOD_COLUMN, BATCH_SIZE)
    return _label_text(sizes.select(PERIOD_COLUMN, "n", "sizes_ok"), "D")


@register("tumbling_day",
          f"SELECT {label_sql('D', 'ts')} AS window_start, count(*) AS n FROM events GROUP BY 1")
def tumbling_day(spark, d):
    ev = read_table(spark, d, "events")
    return (ev.groupBy(F.window("ts", "1 day").alias("w")).agg(F.count(F.lit(1)).alias("n"))
            .select(F.date_format("w.start", "yyyy-MM-dd").alias("window_start"), "n"))


# Bucket labels for every supported frequency: (freq, table, column).
BUCKETS = [
    ("D", "events", "ts"), ("H", "events", "ts"), ("T", "events", "ts"), ("S", "events", "ts"),
    ("3H", "events", "ts"), ("5H", "events", "ts"), ("2D", "events", "ts"), ("B", "events", "ts"),
    ("W", "orders", "o_orderdate"), ("W-MON", "events", "ts"), ("W-THU", "orders", "o_orderdate"),
    ("2W", "orders", "o_orderdate"), ("M", "orders", "o_orderdate"), ("MS", "orders", "o_orderdate"),
    ("Q", "orders", "o_orderdate"), ("QS", "orders", "o_orderdate"), ("A", "orders", "o_orderdate"),
    ("AS", "orders", "o_orderdate"), ("SM", "orders", "o_orderdate"),
    ("SMS", "orders", "o_orderdate"), ("Q-OCT", "orders", "o_orderdate"), ("A-JUN", "orders", "o_orderdate"),
    ("AS-APR", "orders", "o_orderdate"), ("2M", "orders", "o_orderdate"), ("3MS", "orders", "o_orderdate"),
    ("BM", "orders", "o_orderdate"), ("BMS", "orders", "o_orderdate"), ("BQ", "orders", "o_orderdate"),
    ("BAS", "orders", "o_orderdate"), ("500ms", "events", "ts"),
]


def _bucket_query(freq: str, table: str, col: str) -> QueryFn:
    def run(spark, d):
        return _label_text(count_per_period(read_table(spark, d, table), col, freq), freq)
    return run


for _freq, _table, _col in BUCKETS:
    register("bucket_" + _freq.replace("-", "_"), count_sql(_table, _freq, _col))(
        _bucket_query(_freq, _table, _col))


# --------------------------------------------------------------------------
# Profiles
# --------------------------------------------------------------------------

PROFILES = [
    ("D", "lineitem", "l_shipdate"),  # the flagship: per-day profile
    ("W", "orders", "o_orderdate"),
    ("M", "lineitem", "l_shipdate"),
    ("Q", "orders", "o_orderdate"),
    ("A", "orders", "o_orderdate"),
    ("H", "events", "ts"),
    ("MS", "events", "ts"),
    ("B", "events", "ts"),
]


def _profile_query(freq: str, table: str, col: str) -> QueryFn:
    def run(spark, d):
        store = profile(read_table(spark, d, table), col, freq)
        return exact_metrics(store, _fmt(freq))
    return run


for _freq, _table, _col in PROFILES:
    register("profile_by_period_" + _freq,
             profile_sql(_table, [(PERIOD_COLUMN, label_sql(_freq, _col))],
                         where=f"{q(_col)} IS NOT NULL"))(_profile_query(_freq, _table, _col))


@register("profile_global", profile_sql("lineitem"))
def profile_global(spark, d):
    return exact_metrics(profile(read_table(spark, d, "lineitem")))


# Global profiles of the remaining tables ('less-shuffle' on every schema).
for _table in ["orders", "events", "customer", "part", "supplier", "labels", "pages",
               "conversations", "benchmark", "nation", "region"]:
    register(f"profile_global_{_table}", profile_sql(_table))(
        (lambda t: lambda spark, d: exact_metrics(profile(read_table(spark, d, t))))(_table))


@register("profile_text", profile_sql("documents"))
def profile_text(spark, d):
    return exact_metrics(profile(read_table(spark, d, "documents")))


@register("profile_conversations_by_role",
          profile_sql("conversations", [("role", q("role"))]))
def profile_conversations_by_role(spark, d):
    return exact_metrics(profile(read_table(spark, d, "conversations"), by="role"))


@register("profile_object", profile_sql("embeddings"))
def profile_object(spark, d):
    return exact_metrics(profile(read_table(spark, d, "embeddings")))


@register("profile_hot_key",
          profile_sql("lineitem", [("l_returnflag", q("l_returnflag"))]))
def profile_hot_key(spark, d):
    """Keyed by a column whose every value holds a third of all rows: the
    partial aggregate bounds that key's merge by the number of input tasks."""
    return exact_metrics(profile(read_table(spark, d, "lineitem"), by="l_returnflag"))


@register("profile_by_day_and_key",
          profile_sql("events", [(PERIOD_COLUMN, label_sql("D", "ts")), ("event_type", q("event_type"))],
                      where="ts IS NOT NULL"))
def profile_by_day_and_key(spark, d):
    """Per period and per value of a key column at once."""
    store = profile(read_table(spark, d, "events"), "ts", "D", by="event_type")
    return exact_metrics(store, _fmt("D"))


@register("group_by_existing_key",
          profile_sql("orders", [("o_orderpriority", q("o_orderpriority"))]))
def group_by_existing_key(spark, d):
    return exact_metrics(profile(read_table(spark, d, "orders"), by="o_orderpriority"))


_EV_EPOCH_SRC = f"(SELECT *, {_EPOCH_S} AS time FROM events) e"


@register("profile_by_epoch_day",
          profile_sql("events", [(PERIOD_COLUMN, label_sql("D", "ts"))], source=_EV_EPOCH_SRC,
                      columns=TABLE_COLUMNS["events"] + [("time", "integral")]))
def profile_by_epoch_day(spark, d):
    ev = read_table(spark, d, "events")
    ev = ev.withColumn("time", epoch_seconds(F.col("ts"), ev.schema["ts"].dataType))
    store = profile(ev, "time", "D", unit="s", null_dates="epoch")
    return exact_metrics(store, _fmt("D"))


@register("profile_rollup_day_to_month",
          profile_sql("lineitem", [(PERIOD_COLUMN, label_sql("M", "l_shipdate"))],
                      where="l_shipdate IS NOT NULL"))
def profile_rollup_day_to_month(spark, d):
    daily = profile(read_table(spark, d, "lineitem"), "l_shipdate", "D")
    return exact_metrics(rollup(daily, "M"), _fmt("M"))


@register("profile_lookup",
          profile_sql("lineitem", [(PERIOD_COLUMN, label_sql("M", "l_shipdate"))],
                      where="last_day(l_shipdate) = DATE '1995-03-31'"))
def profile_lookup(spark, d):
    store = profile(read_table(spark, d, "lineitem"), "l_shipdate", "M")
    return exact_metrics(lookup(store, dataset_ts=dt.datetime(1995, 3, 31)), _fmt("M"))


@register("profile_merge_stores",
          profile_sql("orders", [(PERIOD_COLUMN, label_sql("M", "o_orderdate"))],
                      where="o_orderdate IS NOT NULL"))
def profile_merge_stores(spark, d):
    orders = read_table(spark, d, "orders")
    urgent = F.coalesce(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.lit(False))
    a = profile(orders.where(urgent), "o_orderdate", "M")
    b = profile(orders.where(~urgent), "o_orderdate", "M")
    return exact_metrics(merge_stores([a, b]), _fmt("M"))


@register("profile_history_runs",
          profile_sql("orders", [(PERIOD_COLUMN, label_sql("M", "o_orderdate"))],
                      where="o_orderdate IS NOT NULL"))
def profile_history_runs(spark, d):
    """Two daily runs appended to a history store (one of them retried), read
    back merged and rolled up to months."""
    orders = read_table(spark, d, "orders")
    cut = F.col("o_orderdate") < F.lit("1996-01-01 00:00:00").cast("timestamp_ntz")
    out = f"{checkpoint_root(spark)}/strata-history-{uuid.uuid4().hex}"
    write_run(profile(orders.where(cut), "o_orderdate", "D"), out, "run-1")
    write_run(profile(orders.where(~cut), "o_orderdate", "D"), out, "run-2")
    write_run(profile(orders.where(~cut), "o_orderdate", "D"), out, "run-2")  # retried run
    return exact_metrics(rollup(read_merged(spark, out), "M"), _fmt("M"))


@register("profile_store_round_trip",
          profile_sql("lineitem", [(PERIOD_COLUMN, label_sql("Q", "l_shipdate"))],
                      where="l_shipdate IS NOT NULL"))
def profile_store_round_trip(spark, d):
    """A daily store written (month partitions), read back, rolled up to quarters."""
    out = f"{checkpoint_root(spark)}/strata-store-{uuid.uuid4().hex}"
    write_profiles(profile(read_table(spark, d, "lineitem"), "l_shipdate", "D"), out)
    return exact_metrics(rollup(read_profiles(spark, out), "Q"), _fmt("Q"))


@register("profile_text_round_trip",
          profile_sql("orders", [(PERIOD_COLUMN, label_sql("W", "o_orderdate"))],
                      where="o_orderdate IS NOT NULL"))
def profile_text_round_trip(spark, d):
    """A daily store written as JSON text, read back and rolled up to weeks."""
    out = f"{checkpoint_root(spark)}/strata-text-{uuid.uuid4().hex}"
    write_text(profile(read_table(spark, d, "orders"), "o_orderdate", "D"), out)
    return exact_metrics(rollup(read_text_profiles(spark, out), "W"), _fmt("W"))


# User metrics: (name, kind, Spark row expression, SQL row expression).
_CUSTOM = [("positive", "sum", lambda c: (c > 0).cast("int"), "CAST({c} > 0 AS INTEGER)"),
           ("largest", "max", lambda c: c, "{c}"),
           ("smallest", "min", lambda c: c, "{c}")]
_CUSTOM_COLUMNS = ["l_quantity", "l_discount", "l_tax"]


@register("custom_metrics", "\nUNION ALL\n".join(
    f"SELECT {label_sql('M', 'l_shipdate')} AS dataset_ts, '{c}' AS \"column\", '{m}' AS metric, "
    f"'{k}' AS kind, CAST({k}({sql.format(c=c)}) AS DOUBLE) AS value FROM lineitem "
    f"WHERE l_shipdate IS NOT NULL GROUP BY 1"
    for c in _CUSTOM_COLUMNS for m, k, _, sql in _CUSTOM))
def custom_metrics(spark, d):
    """User-defined mergeable metrics per month (the user aggregate surface)."""
    metrics = {m: (k, fn) for m, k, fn, _ in _CUSTOM}
    store = custom_profile(read_table(spark, d, "lineitem"), metrics, "l_shipdate", "M",
                           columns=_CUSTOM_COLUMNS)
    return _label_text(store, "M")


_FI_COLUMNS = ["l_returnflag", "l_linestatus", "l_linenumber"]


@register("frequent_items", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS item, count(*) AS count "
    f"FROM lineitem WHERE {c} IS NOT NULL GROUP BY 2" for c in _FI_COLUMNS))
def frequent_items_q(spark, d):
    store = profile(read_table(spark, d, "lineitem"), columns=_FI_COLUMNS)
    return frequent_items(store, top_k=10).select("column", "item", "count")


@register("frequent_items_by_month", "\nUNION ALL\n".join(
    f"SELECT {label_sql('M', 'o_orderdate')} AS dataset_ts, '{c}' AS \"column\", "
    f"CAST({c} AS VARCHAR) AS item, count(*) AS count FROM orders "
    f"WHERE o_orderdate IS NOT NULL AND {c} IS NOT NULL GROUP BY 1, 3"
    for c in ["o_orderstatus", "o_orderpriority"]))
def frequent_items_by_month(spark, d):
    store = profile(read_table(spark, d, "orders"), "o_orderdate", "M",
                    columns=["o_orderstatus", "o_orderpriority"])
    return _label_text(frequent_items(store, top_k=10), "M")


@register("profile_table", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", count(*) AS n, count(DISTINCT {q(c)}) AS distinct_exact, "
    f"true AS distinct_ok, true AS quantile_ok FROM customer" for c, _ in TABLE_COLUMNS["customer"]))
def profile_table_q(spark, d):
    cust = read_table(spark, d, "customer")
    return global_sketch_accuracy(cust, profile(cust))


@register("profile_size")
def profile_size_q(spark, d):
    store = profile(read_table(spark, d, "lineitem"), "l_shipdate", "M")
    return _label_text(profile_size(store), "M")


@register("stream_panes_by_day",
          profile_sql("events", [(PERIOD_COLUMN, label_sql("D", "ts"))], where="ts IS NOT NULL"))
def stream_panes_by_day(spark, d):
    """Replay ``events`` as a file stream (one file per trigger), profile each
    micro-batch as a discarding pane, merge the panes on read."""
    schema = spark.read.parquet(table_path(d, "events")).schema
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
              .parquet(os.path.join(d, "{events}.parquet")))
    out = f"{checkpoint_root(spark)}/strata-panes-{uuid.uuid4().hex}"
    q = profile_stream(stream, out, "ts", "D", checkpoint=f"{out}/_checkpoint",
                       trigger={"availableNow": True})
    q.awaitTermination()
    return exact_metrics(merge_panes(spark, out), _fmt("D"))


@register("stream_windowed_by_day",
          profile_sql("events", [(PERIOD_COLUMN, label_sql("D", "ts"))], where="ts IS NOT NULL"))
def stream_windowed_by_day(spark, d):
    """``events`` as a file stream into day windows kept in the state store.
    Update mode writes a window's profile to the store after every trigger that
    changed it, so the last, still open window is there too; the newest batch of
    each window is its result."""
    schema = spark.read.parquet(table_path(d, "events")).schema
    stream = spark.readStream.schema(schema).parquet(os.path.join(d, "{events}.parquet"))
    long = profile_stream_windowed(stream, "ts", "1 day", watermark="0 seconds")
    out = f"{checkpoint_root(spark)}/strata-windows-{uuid.uuid4().hex}"

    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/store/batch={batch_id}")

    q = (long.writeStream.foreachBatch(write).outputMode("update")
         .option("checkpointLocation", f"{out}/_checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    store = spark.read.parquet(f"{out}/store")
    newest = store.groupBy(PERIOD_COLUMN).agg(F.max("batch").alias("batch"))
    return exact_metrics(store.join(newest, [PERIOD_COLUMN, "batch"], "left_semi").drop("batch"), _fmt("D"))


# Sketches that went through a merge, held against the rows: HLL and KLL within
# their bounds, top-k exact below its width and within its bound above it.
_SKETCHED = {"orders": ["o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "o_orderdate"],
             "events": ["event_id", "user_id", "event_type", "value", "ts"]}


def _sketch_sql(table: str, freq: str, date: str) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT {label_sql(freq, date)} AS dataset_ts, '{c}' AS \"column\", count(*) AS n, "
        f"count(DISTINCT {q(c)}) AS distinct_exact, true AS distinct_ok, true AS quantiles_ok "
        f"FROM {table} WHERE {q(date)} IS NOT NULL GROUP BY 1" for c in _SKETCHED[table])


def _yearly(spark, d, store):
    return _label_text(merged_sketch_accuracy(read_table(spark, d, "orders"), store, "o_orderdate", "A",
                                              _SKETCHED["orders"]), "A")


_YEARLY_SQL = _sketch_sql("orders", "A", "o_orderdate")


@register("merged_sketches_rollup", _YEARLY_SQL)
def merged_sketches_rollup(spark, d):
    return _yearly(spark, d, rollup(profile(read_table(spark, d, "orders"), "o_orderdate", "D"), "A"))


@register("merged_sketches_stores", _YEARLY_SQL)
def merged_sketches_stores(spark, d):
    orders = read_table(spark, d, "orders")
    urgent = F.coalesce(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.lit(False))
    return _yearly(spark, d, merge_stores([profile(orders.where(urgent), "o_orderdate", "A"),
                                           profile(orders.where(~urgent), "o_orderdate", "A")]))


@register("merged_sketches_runs", _YEARLY_SQL)
def merged_sketches_runs(spark, d):
    """Two runs of an append-only store; the first attempt of the second held
    every order and is replaced as a unit by the one that holds the later ones."""
    orders = read_table(spark, d, "orders")
    cut = F.col("o_orderdate") < F.lit("1996-01-01 00:00:00").cast("timestamp_ntz")
    out = f"{checkpoint_root(spark)}/strata-history-{uuid.uuid4().hex}"
    write_run(profile(orders.where(cut), "o_orderdate", "M"), out, "run-1")
    write_run(profile(orders, "o_orderdate", "M"), out, "run-2")
    write_run(profile(orders.where(~cut), "o_orderdate", "M"), out, "run-2")
    return _yearly(spark, d, rollup(read_merged(spark, out), "A"))


@register("merged_sketches_files", _YEARLY_SQL)
def merged_sketches_files(spark, d):
    """Through both file forms: Parquet, then JSON text, then merged."""
    out = f"{checkpoint_root(spark)}/strata-files-{uuid.uuid4().hex}"
    write_profiles(profile(read_table(spark, d, "orders"), "o_orderdate", "D"), f"{out}/parquet")
    write_text(read_profiles(spark, f"{out}/parquet"), f"{out}/text")
    return _yearly(spark, d, rollup(read_text_profiles(spark, f"{out}/text"), "A"))


def _event_panes(spark, d, freq: str) -> DataFrame:
    """``events`` dealt over several files, one file a pane, the panes merged."""
    out = f"{checkpoint_root(spark)}/strata-panes-{uuid.uuid4().hex}"
    ev = read_table(spark, d, "events")
    ev.repartition(5, "event_id").write.parquet(f"{out}/input")
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(f"{out}/input")
    profile_stream(stream, out, "ts", freq, checkpoint=f"{out}/_checkpoint",
                   trigger={"availableNow": True}).awaitTermination()
    return merge_panes(spark, out)


@register("merged_sketches_panes", _sketch_sql("events", "W", "ts"))
def merged_sketches_panes(spark, d):
    return _label_text(merged_sketch_accuracy(read_table(spark, d, "events"), _event_panes(spark, d, "W"), "ts", "W",
                                              _SKETCHED["events"]), "W")


@register("stream_several_panes",
          profile_sql("events", [(PERIOD_COLUMN, label_sql("D", "ts"))], where="ts IS NOT NULL"))
def stream_several_panes(spark, d):
    return exact_metrics(_event_panes(spark, d, "D"), _fmt("D"))


@register("merged_frequent_items",
          f"SELECT {label_sql('A', 'o_orderdate')} AS dataset_ts, 'bucket' AS \"column\", "
          "CAST(o_custkey % 600 AS VARCHAR) AS item, count(*) AS count FROM orders "
          "WHERE o_orderdate IS NOT NULL AND o_custkey IS NOT NULL GROUP BY 1, 3")
def merged_frequent_items(spark, d):
    """States wider than the default keep their width through a merge."""
    orders = read_table(spark, d, "orders").withColumn("bucket", F.expr("o_custkey % 600"))
    store = profile(orders, "o_orderdate", "M", columns=["bucket"], sketches=SketchConfig(topk_capacity=2000))
    return _label_text(frequent_items(rollup(store, "A"), top_k=1000), "A")


@register("merged_frequent_items_bound",
          f"SELECT {label_sql('A', 'o_orderdate')} AS dataset_ts, count(o_custkey) AS n, true AS topk_ok "
          "FROM orders WHERE o_orderdate IS NOT NULL AND o_custkey IS NOT NULL GROUP BY 1")
def merged_frequent_items_bound(spark, d):
    orders = read_table(spark, d, "orders")
    store = rollup(profile(orders, "o_orderdate", "M", columns=["o_custkey"]), "A")
    return _label_text(merged_topk_accuracy(orders, store, "o_orderdate", "A", "o_custkey"), "A")


_QUARTERS = profile_sql("lineitem", [(PERIOD_COLUMN, label_sql("Q", "l_shipdate"))], where="l_shipdate IS NOT NULL")


@register("profile_salted_tree", _QUARTERS)
def profile_salted_tree(spark, d):
    """The two-level tree that a wide input uses."""
    return exact_metrics(profile(read_table(spark, d, "lineitem"), "l_shipdate", "Q", fanout=3), _fmt("Q"))


@register("profile_row_shuffle", _QUARTERS)
def profile_row_shuffle(spark, d):
    return exact_metrics(profile(read_table(spark, d, "lineitem"), "l_shipdate", "Q", row_shuffle=True), _fmt("Q"))


# --------------------------------------------------------------------------
# Compacted histories
# --------------------------------------------------------------------------

class _Died(Exception):
    """Stands for a compaction that ends before its version is written."""


def _die() -> None:
    raise _Died


def _history_versions(spark, d, out: str) -> None:
    """Four runs of ``orders``; a compaction after two of them, one that dies after
    the third, one after the fourth, and a vacuum."""
    orders, h = read_table(spark, d, "orders"), History(spark, out)
    run = lambda k: write_run(profile(orders.where(F.pmod("o_orderkey", F.lit(4)) == k), "o_orderdate", "M"),
                              out, f"run-{k}")
    run(0)
    run(1)
    h.compact()
    run(2)
    try:
        h.compact(before_commit=_die)
    except _Died:
        pass
    run(3)


@register("history_compaction",
          profile_sql("orders", [(PERIOD_COLUMN, label_sql("M", "o_orderdate"))],
                      where="o_orderdate IS NOT NULL AND o_orderkey IS NOT NULL"))
def history_compaction(spark, d):
    """A history of four runs, compacted twice, once in vain, and vacuumed."""
    out = f"{checkpoint_root(spark)}/strata-history-{uuid.uuid4().hex}"
    _history_versions(spark, d, out)
    h = History(spark, out)
    h.compact()
    h.vacuum()
    return exact_metrics(h.read(), _fmt("M"))


@register("history_interrupted",
          profile_sql("orders", [(PERIOD_COLUMN, label_sql("M", "o_orderdate"))],
                      where="o_orderdate IS NOT NULL AND o_orderkey IS NOT NULL"))
def history_interrupted(spark, d):
    """The same history read after the compaction that died: bases and runs since."""
    out = f"{checkpoint_root(spark)}/strata-history-{uuid.uuid4().hex}"
    _history_versions(spark, d, out)
    return exact_metrics(History(spark, out).read(), _fmt("M"))


# --------------------------------------------------------------------------
# Moments of many partial rows, user aggregates, clashing names
# --------------------------------------------------------------------------

_SHIFTED = "(SELECT l_orderkey, l_extendedprice + 1000000 AS price, l_quantity FROM lineitem) t"


@register("moments_many_partials",
          profile_sql("lineitem", source=_SHIFTED, columns=[("price", "fractional"), ("l_quantity", "fractional")]))
def moments_many_partials(spark, d):
    """One partial row per order and column, all merged into one key; the values
    stand far from zero, so that careless sums of squares would cancel."""
    li = read_table(spark, d, "lineitem").select("l_orderkey", (F.col("l_extendedprice") + 1000000).alias("price"), "l_quantity")
    # frequent items have other queries; their states would be most of this one's bytes
    store = profile(li, by="l_orderkey", columns=["price", "l_quantity"], sketches=SketchConfig(topk_capacity=0))
    return exact_metrics(merge_profiles(store, keys=[]))


_WEIGHTED = UserAggregate(state={"w": Field("sum", lambda c: F.when(c.isNotNull(), F.col("l_quantity"))),
                                 "wx": Field("sum", lambda c: c * F.col("l_quantity"))},
                          finish=lambda s: F.round(s["wx"] / s["w"], 6))


@register("user_weighted_mean", f"SELECT {label_sql('M', 'l_shipdate')} AS dataset_ts, " + ", ".join(
    f"round(sum({c} * l_quantity) / sum(CASE WHEN {c} IS NOT NULL THEN l_quantity END), 6) AS \"{c}:wmean\""
    for c in ("l_extendedprice", "l_discount")) + " FROM lineitem WHERE l_shipdate IS NOT NULL GROUP BY 1")
def user_weighted_mean(spark, d):
    """A state of two sums with a finishing step, kept per day in files and folded to months."""
    aggs = {"wmean": _WEIGHTED}
    out = f"{checkpoint_root(spark)}/strata-user-{uuid.uuid4().hex}"
    user_profile(read_table(spark, d, "lineitem"), aggs, "l_shipdate", "D",
                 columns=["l_extendedprice", "l_discount"]).write.parquet(out)
    return _label_text(finish_user(rollup_user(spark.read.parquet(out), "M"), aggs), "M")


@register("user_argmax", f"""
WITH o AS (SELECT *, {label_sql('Q', 'o_orderdate')} AS dataset_ts, o_orderkey + 9007199254740992 AS big FROM orders WHERE o_orderdate IS NOT NULL),
p AS (SELECT *, row_number() OVER (PARTITION BY dataset_ts ORDER BY o_totalprice DESC, o_orderkey) AS k FROM o WHERE o_totalprice IS NOT NULL),
s AS (SELECT dataset_ts, max(big) AS "big:largest", CAST(sum(CAST(big AS HUGEINT)) % 1000000007 AS BIGINT) AS "big:checksum" FROM o GROUP BY 1)
SELECT s.dataset_ts, p.o_orderkey AS "o_totalprice:key", p.o_orderpriority AS "o_totalprice:priority", "big:largest", "big:checksum"
FROM s LEFT JOIN p ON s.dataset_ts = p.dataset_ts AND p.k = 1""")
def user_argmax(spark, d):
    """The key and the priority of each quarter's dearest order (ties: smallest key),
    and exact maxima and sums of integers beyond 2**53."""
    best = {"best": Field("max", lambda c: F.when(c.isNotNull(), F.struct(
        c.alias("price"), (-F.col("o_orderkey")).alias("k"), F.col("o_orderpriority").alias("priority"))))}
    price = {"key": UserAggregate(best, finish=lambda s: -s["best"]["k"]),
             "priority": UserAggregate(best, finish=lambda s: s["best"]["priority"])}
    whole = {"largest": UserAggregate({"m": Field("max", lambda c: c)}),
             "checksum": UserAggregate({"s": Field("sum", lambda c: c.cast("decimal(20,0)"))},
                                       finish=lambda s: (s["s"] % 1000000007).cast("bigint"))}
    orders = read_table(spark, d, "orders").withColumn("big", F.col("o_orderkey") + 9007199254740992)
    a = finish_user(user_profile(orders, price, "o_orderdate", "Q", columns=["o_totalprice"]), price)
    b = finish_user(user_profile(orders, whole, "o_orderdate", "Q", columns=["big"]), whole)
    return _label_text(a.join(b, PERIOD_COLUMN), "Q")


# Columns whose names the operators use themselves.
_CLASH_COLUMNS = [("dataset_ts", "datetime"), ("__salt", "integral"), ("batch_id", "integral"), ("period", "string"),
                  ("__n", "integral"), ("__period", "integral"), ("__part", "string")]
_CLASH_SQL = ("(SELECT l_shipdate, l_shipdate - INTERVAL 9000 DAY AS dataset_ts, CAST(5 AS BIGINT) AS __salt, "
              "l_orderkey AS batch_id, l_returnflag AS period, l_partkey AS __n, l_suppkey AS __period, l_linestatus AS __part "
              "FROM lineitem) t")


def _clashing(spark, d) -> DataFrame:
    li = read_table(spark, d, "lineitem")
    return li.select("l_shipdate", (F.col("l_shipdate") - F.expr("INTERVAL '9000' DAY")).alias("dataset_ts"),
                     F.lit(5).cast("bigint").alias("__salt"), F.col("l_orderkey").alias("batch_id"),
                     F.col("l_returnflag").alias("period"), F.col("l_partkey").alias("__n"),
                     F.col("l_suppkey").alias("__period"), F.col("l_linestatus").alias("__part"))


def _clash_query(**how) -> QueryFn:
    def run(spark, d):
        store = profile(_clashing(spark, d), "l_shipdate", "Q", columns=[c for c, _ in _CLASH_COLUMNS], **how)
        return exact_metrics(store, _fmt("Q"))
    return run


for _name, _how in (("plain", {}), ("salted", {"fanout": 3}), ("row_shuffle", {"row_shuffle": True})):
    register(f"profile_clashing_names_{_name}",
             profile_sql("lineitem", [(PERIOD_COLUMN, label_sql("Q", "l_shipdate"))], source=_CLASH_SQL,
                         columns=_CLASH_COLUMNS, where="l_shipdate IS NOT NULL"))(_clash_query(**_how))


@register("profile_clashing_keys_round_trip",
          profile_sql("lineitem", [(PERIOD_COLUMN, label_sql("Q", "l_shipdate")), ("period", q("period"))],
                      source=_CLASH_SQL, columns=[("__n", "integral")], where="l_shipdate IS NOT NULL"))
def profile_clashing_keys_round_trip(spark, d):
    """A key column named as the store's directories are, through files."""
    out = f"{checkpoint_root(spark)}/strata-keys-{uuid.uuid4().hex}"
    write_profiles(profile(_clashing(spark, d), "l_shipdate", "M", by="period", columns=["__n"]), out)
    return exact_metrics(rollup(read_profiles(spark, out), "Q"), _fmt("Q"))


@register("batches_clashing_names",
          "SELECT l_returnflag AS period, count(*) AS n, true AS sizes_ok, sum(l_orderkey)::BIGINT AS keys, "
          "count(DISTINCT l_linestatus) AS parts FROM lineitem GROUP BY 1")
def batches_clashing_names(spark, d):
    df = _clashing(spark, d)
    name, _ = batch_columns(df)
    batched = group_into_batches(df, "period", BATCH_SIZE)
    kept = batched.groupBy("period").agg(F.sum("batch_id").alias("keys"), F.count_distinct("__part").alias("parts"))
    return batch_sizes(batched, "period", BATCH_SIZE, name).select("period", "n", "sizes_ok").join(kept, "period")


# --------------------------------------------------------------------------
# Streams: batches and panes by count or time, late rows, compacted panes
# --------------------------------------------------------------------------

def _event_files(spark, d, out: str, deal: Column, n: int) -> DataFrame:
    """``events`` as a stream of ``n`` files in the order of ``deal``, one a trigger."""
    ev = read_table(spark, d, "events")
    for k in range(n):
        ev.where(deal == k).coalesce(1).write.parquet(f"{out}/input/{k}")
    return (spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1)
            .option("recursiveFileLookup", "true").parquet(f"{out}/input"))


def _run_until(query, done: Callable[[], bool], seconds: int = 300) -> None:
    """A query with processing-time timers never ends by itself: stop it when ``done``."""
    end = time.time() + seconds
    try:
        while query.isActive and not done() and time.time() < end:
            time.sleep(0.5)
        if query.exception() is not None:
            raise query.exception()
    finally:
        query.stop()


def _seen(spark, path: str, count: Callable[[DataFrame], int]) -> int:
    return count(spark.read.parquet(path)) if History(spark, path, "pane").units() else 0


@register("stream_batches",
          "SELECT event_type, count(*) AS n, true AS sizes_ok, CAST(sum(event_id) AS BIGINT) AS keys, "
          "round(sum(value), 2) AS total FROM events GROUP BY 1")
def stream_batches(spark, d):
    """Batches of at most 300 rows per type, full or after a second, from five files:
    list state and timers."""
    out = f"{checkpoint_root(spark)}/strata-batches-{uuid.uuid4().hex}"
    stream = _event_files(spark, d, out, F.pmod("event_id", F.lit(5)), 5)
    batches = stream_group_into_batches(stream, "event_type", 300, max_wait="1 second", shards=4)

    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/out/pane={batch_id}")

    total = read_table(spark, d, "events").count()
    q = (batches.writeStream.foreachBatch(write).option("checkpointLocation", f"{out}/_checkpoint")
         .trigger(availableNow=True).start())
    _run_until(q, lambda: _seen(spark, f"{out}/out", lambda df: df.count()) >= total)
    got = spark.read.parquet(f"{out}/out").drop("pane")
    sums = got.groupBy("event_type").agg(F.sum("event_id").alias("keys"), F.round(F.sum("value"), 2).alias("total"))
    return batch_sizes(got, "event_type", 300).select("event_type", "n", "sizes_ok").join(sums, "event_type")


@register("stream_count_or_time",
          profile_sql("events", [(PERIOD_COLUMN, label_sql("D", "ts"))], where="ts IS NOT NULL"))
def stream_count_or_time(spark, d):
    """Panes that close after 100 rows of a day or after a second, merged."""
    out = f"{checkpoint_root(spark)}/strata-panes-{uuid.uuid4().hex}"
    stream = _event_files(spark, d, out, F.pmod("event_id", F.lit(3)), 3)
    total = read_table(spark, d, "events").where("ts IS NOT NULL").count()
    q = profile_stream(stream, out, "ts", "D", checkpoint=f"{out}/_checkpoint", pane_rows=100, pane_wait="1 second",
                       shards=2, trigger={"availableNow": True})
    rows = lambda df: df.where("column = 'event_id'").agg(F.sum("n")).first()[0] or 0
    _run_until(q, lambda: _seen(spark, f"{out}/panes", rows) >= total)
    return exact_metrics(merge_panes(spark, out), _fmt("D"))


# Rows of file (7 * event_id) % 5 are late if they are 12 days older than all rows of the files before.
_ON_TIME = ("(SELECT e.* FROM events e WHERE ts >= coalesce((SELECT max(o.ts) - INTERVAL 12 DAY FROM events o "
            "WHERE (o.event_id * 7) % 5 < (e.event_id * 7) % 5), ts)) t")


def _late_events(spark, d) -> str:
    out = f"{checkpoint_root(spark)}/strata-late-{uuid.uuid4().hex}"
    stream = _event_files(spark, d, out, F.pmod(F.col("event_id") * 7, F.lit(5)), 5)
    profile_stream(stream, out, "ts", "D", checkpoint=f"{out}/_checkpoint", lateness="12 days", late="keep",
                   trigger={"availableNow": True}).awaitTermination()
    return out


@register("stream_late_on_time", profile_sql("events", [(PERIOD_COLUMN, label_sql("D", "ts"))], source=_ON_TIME))
def stream_late_on_time(spark, d):
    """Shuffled files under a lateness: the panes hold what was on time."""
    return exact_metrics(merge_panes(spark, _late_events(spark, d)), _fmt("D"))


@register("stream_late_corrected",
          profile_sql("events", [(PERIOD_COLUMN, label_sql("D", "ts"))], where="ts IS NOT NULL"))
def stream_late_corrected(spark, d):
    """The same stream with its corrections merged: all rows; the panes compacted before."""
    out = _late_events(spark, d)
    correct_panes(spark, out, "ts", "D")
    compact_panes(spark, out)
    pane_history(spark, out).vacuum()
    return exact_metrics(merge_panes(spark, out, corrections=True), _fmt("D"))


# --------------------------------------------------------------------------
# Heavy hitters, checked rows, type changes, sinks
# --------------------------------------------------------------------------

def _heavy_sql(columns: list[tuple[str, str, str]], size: int) -> str:
    """Values above the bound per (table, column, SQL text of the value)."""
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", {text} AS item, count(*) AS count, any_value(t.rows) AS rows, "
        f"CAST(floor(7.0 * any_value(t.rows) / {size}) AS BIGINT) AS bound "
        f"FROM {table}, (SELECT count({c}) AS rows FROM {table}) t WHERE {c} IS NOT NULL GROUP BY 2 "
        f"HAVING count(*) > floor(7.0 * any_value(t.rows) / {size})" for table, c, text in columns)


@register("heavy_hitters", _heavy_sql([
    ("documents", "text", "text"), ("documents", "source", "source"), ("lineitem", "l_discount", "CAST(l_discount AS VARCHAR)"),
    ("lineitem", "l_suppkey", "CAST(l_suppkey AS VARCHAR)"), ("lineitem", "l_shipdate", "strftime(l_shipdate, '%Y-%m-%d %H:%M:%S')")],
    heavy.map_size(8192)))
def heavy_hitters_q(spark, d):
    """Texts, doubles, integers and times that more rows hold than the bound, counted exactly."""
    found = [heavy.heavy_hitters(read_table(spark, d, t), columns, capacity=8192) for t, columns in (
        ("documents", ["text", "source"]), ("lineitem", ["l_discount", "l_suppkey", "l_shipdate"]))]
    return found[0].unionByName(found[1])


_CHECKED_SCHEMA = "event_id int NOT NULL, ts timestamp_ntz, user_id tinyint, value int, props string NOT NULL"
_CHECKED_SQL = ("(SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 'no date' END AS bad_ts, user_id, value, "
                "CASE WHEN event_id % 11 = 0 THEN NULL ELSE props END AS props FROM events)")


def _checked_events(spark, d) -> DataFrame:
    ev = read_table(spark, d, "events")
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return ev.select("event_id", F.when(F.col("event_id") % 7 == 0, F.lit("no date")).otherwise(text).alias("ts"), "user_id",
                     "value", F.when(F.col("event_id") % 11 > 0, F.col("props")).alias("props"))


@register("rejected_rows", f"""
WITH r AS (SELECT CASE WHEN bad_ts IS NOT NULL THEN 'cast:ts' END AS a, CASE WHEN user_id NOT BETWEEN -128 AND 127 THEN 'cast:user_id' END AS b,
  CASE WHEN value <> trunc(value) THEN 'inexact:value' END AS c, CASE WHEN props IS NULL THEN 'null:props' END AS e FROM {_CHECKED_SQL})
SELECT concat_ws(',', a, b, c, e) AS reasons, count(*) AS n FROM r GROUP BY 1""")
def rejected_rows(spark, d):
    """Rows per combination of reasons (none: accepted), from one reading of the input."""
    out = f"{checkpoint_root(spark)}/strata-checked-{uuid.uuid4().hex}"
    good, bad = split_rows(_checked_events(spark, d), _CHECKED_SCHEMA, out)
    kinds = bad.select(F.array_join("reasons", ",").alias("reasons")).unionByName(good.select(F.lit("").alias("reasons")))
    return kinds.groupBy("reasons").agg(F.count(F.lit(1)).alias("n"))


@register("types_across_runs",
          "SELECT 'v' AS \"column\", 3 * count(*) AS n, 3 * count(*) - count(*) FILTER (o_orderkey IS NULL) - count(*) FILTER (o_totalprice IS NULL) "
          "- count(*) FILTER (o_orderpriority IS NULL) AS nonnull, count(o_orderkey) AS whole, count(o_totalprice) AS fractions, "
          "count(o_orderpriority) AS texts, CAST(least(min(o_orderkey), min(o_totalprice)) AS DOUBLE) AS least, "
          "CAST(greatest(max(o_orderkey), max(o_totalprice)) AS DOUBLE) AS greatest FROM orders")
def types_across_runs(spark, d):
    """A column that was whole, then fractional, then text: one row."""
    orders = read_table(spark, d, "orders")
    runs = [profile(orders.select(F.col(c).alias("v"))) for c in ("o_orderkey", "o_totalprice", "o_orderpriority")]
    r = across_types(merge_stores(runs))
    return r.select("column", "n", "nonnull", F.col("types")["integral"].alias("whole"), F.col("types")["fractional"].alias("fractions"),
                    F.col("types")["string"].alias("texts"), F.col("least").cast("double").alias("least"),
                    F.col("greatest").cast("double").alias("greatest"))


@register("exact_extrema", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", CAST(min({e}) AS VARCHAR) AS minimum, CAST(max({e}) AS VARCHAR) AS maximum FROM lineitem"
    for c, e in (("price", "CAST(l_extendedprice * 100 AS BIGINT) * 1000000007"), ("flag", "hex(l_returnflag || l_linestatus)"))))
def exact_extrema_q(spark, d):
    """Extrema of decimals beyond 15 digits and of binary values, after a merge."""
    li = read_table(spark, d, "lineitem")
    wide = li.select("l_shipdate", (F.round(F.col("l_extendedprice") * 100).cast("decimal(28,10)") * F.lit(1000000007)).cast("decimal(38,10)").alias("price"),
                     F.concat("l_returnflag", "l_linestatus").cast("binary").alias("flag"))
    store = profile(wide, "l_shipdate", "A", columns=["price", "flag"])
    return exact_extrema(merge_profiles(store.drop(PERIOD_COLUMN))).select("column", "minimum", "maximum")


def _sniff_sql(table: str, columns: list[tuple[str, str]]) -> str:
    """Counts per kind of value of the text expressions of a table."""
    out = []
    for name, text in columns:
        kind = "CASE WHEN b = '' THEN 'blank' " + " ".join(
            f"WHEN regexp_full_match(b, '{p[1:-1]}') THEN '{k}'" for k, p in sniff.PATTERNS.items()) + " ELSE 'text' END"
        counts = ", ".join(f"count(*) FILTER (kind = '{k}') AS \"{k}\"" for k in sniff.KINDS)
        out.append(
            f"SELECT '{name}' AS \"column\", {counts}, CASE WHEN count(*) FILTER (kind <> 'blank') = 0 THEN NULL "
            + " ".join(f"WHEN bool_and(kind IN ({kinds})) THEN '{k}'" for k, kinds in (
                ("integral", "'integral', 'blank'"), ("boolean", "'boolean', 'blank'"), ("date", "'date', 'blank'"),
                ("fractional", "'integral', 'fractional', 'blank'")))
            + f" ELSE 'text' END AS fits FROM (SELECT {kind} AS kind FROM (SELECT trim({text}, ' ' || chr(9) || chr(10) || chr(11) "
            f"|| chr(12) || chr(13)) AS b FROM {table}) x WHERE b IS NOT NULL) y")
    return "\nUNION ALL\n".join(out)


@register("value_kinds", _sniff_sql("events", [
    ("props", "props"), ("id", "CAST(event_id AS VARCHAR)"), ("day", "strftime(ts, '%Y-%m-%d')"),
    ("mixed", "CASE event_id % 6 WHEN 0 THEN ' ' WHEN 1 THEN '-12' WHEN 2 THEN '3.5e2' WHEN 3 THEN 'true' WHEN 4 THEN '2024-02-30T10:00Z' "
              "ELSE event_type END"),
    ("price", "CASE WHEN event_id % 2 = 0 THEN '7' ELSE ' 7.25' END")]) + "\nUNION ALL\n" + _sniff_sql("pages", [("url", "url")]))
def value_kinds(spark, d):
    """What text columns hold, counted per day and folded."""
    k = F.col("event_id") % 6
    ev = read_table(spark, d, "events")
    texts = ev.select(
        "ts", "props", F.col("event_id").cast("string").alias("id"), F.date_format("ts", "yyyy-MM-dd").alias("day"),
        F.when(k == 0, " ").when(k == 1, "-12").when(k == 2, "3.5e2").when(k == 3, "true").when(k == 4, "2024-02-30T10:00Z")
        .otherwise(F.col("event_type")).alias("mixed"), F.when(F.col("event_id") % 2 == 0, "7").otherwise(" 7.25").alias("price"))
    daily = sniff.sniff(texts, "ts", "D", null_dates="keep").drop(PERIOD_COLUMN)
    pages = sniff.sniff(read_table(spark, d, "pages"), columns=["url"])
    return sniff.sniffed(merge_user(daily)).unionByName(sniff.sniffed(pages))


# Nulls, NaN and infinities put into given rows (all rows kept).
_ODD_SQL = ("(SELECT event_id, CASE WHEN event_id % 5 > 0 THEN ts END AS ts, CASE event_id % 13 WHEN 0 THEN 'NaN'::DOUBLE "
            "WHEN 1 THEN 'Infinity'::DOUBLE WHEN 2 THEN '-Infinity'::DOUBLE WHEN 3 THEN NULL ELSE value END AS value, "
            "CASE WHEN event_id % 4 > 0 THEN event_type END AS event_type FROM events) e")
_ODD_COLUMNS = [("event_id", "integral"), ("ts", "datetime"), ("value", "fractional"), ("event_type", "string")]


def _odd_events(spark, d) -> DataFrame:
    ev, k = read_table(spark, d, "events"), F.col("event_id") % 13
    value = (F.when(k == 0, F.lit(float("nan"))).when(k == 1, F.lit(float("inf"))).when(k == 2, F.lit(float("-inf")))
             .when(k != 3, F.col("value")))
    return ev.select("event_id", F.when(F.col("event_id") % 5 > 0, F.col("ts")).alias("ts"), value.alias("value"),
                     F.when(F.col("event_id") % 4 > 0, F.col("event_type")).alias("event_type"))


@register("profile_nulls_and_nan",
          profile_sql("events", [(PERIOD_COLUMN, label_sql("W", "ts"))], source=_ODD_SQL, columns=_ODD_COLUMNS, where="ts IS NOT NULL"))
def profile_nulls_and_nan(spark, d):
    """Rows without a date are left out; nulls, NaN and infinities are counted apart."""
    return exact_metrics(rollup(profile(_odd_events(spark, d), "ts", "D"), "W"), _fmt("W"))


@register("profile_without_date_column",
          profile_sql("events", [(PERIOD_COLUMN, label_sql("M", "ts"))], source=_ODD_SQL, columns=_ODD_COLUMNS[2:], where="ts IS NOT NULL"))
def profile_without_date_column(spark, d):
    """The date column makes the period and is not profiled itself."""
    return exact_metrics(profile(_odd_events(spark, d), "ts", "M", columns=["value", "event_type"]), _fmt("M"))


@register("profile_identity", profile_sql("orders"))
def profile_identity(spark, d):
    """The profile of no rows is the identity of merging."""
    orders = read_table(spark, d, "orders")
    none = profile(orders.where(F.lit(False)))
    return exact_metrics(merge_stores([none, profile(orders), none]))


@register("csv_round_trip", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_round_trip(spark, d):
    """A table written as CSV with a header, read with declared types and enforced."""
    out = f"{checkpoint_root(spark)}/strata-csv-{uuid.uuid4().hex}"
    cust = read_table(spark, d, "customer")
    cust.write.option("header", True).csv(out)
    schema = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    return enforce_schema(read_csv(spark, out, schema), schema)


@register("readable_profile", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", '{tc}' AS type_class, count(*) AS n, count({c}) AS typed, round(avg({x}), 4) AS mean, "
    f"{top} AS top_item, {top_n} AS top_count FROM region"
    for c, tc, x, top, top_n in (
        ("r_regionkey", "integral", "r_regionkey", "CAST(min(r_regionkey) AS VARCHAR)", "1"),
        ("r_name", "string", "length(r_name)", "min(r_name)", "1"))))
def readable_profile(spark, d):
    """The readable table of a profile: types, mean and frequent items decoded."""
    t = profile_table(profile(read_table(spark, d, "region")), top_k=10)
    items = F.array_sort(F.transform("frequent_items", lambda x: F.struct(x["item"].alias("item"), x["count"].alias("count"))))
    return t.select("column", "type_class", "n", F.col("types")[F.col("type_class")].alias("typed"), F.round("mean", 4).alias("mean"),
                    items[0]["item"].alias("top_item"), items[0]["count"].cast("int").alias("top_count"))


@register("fan_out_sinks",
          profile_sql("orders", [(PERIOD_COLUMN, label_sql("Q", "o_orderdate"))], where="o_orderdate IS NOT NULL"))
def fan_out_sinks(spark, d):
    """One profile written once and fed to two more sinks; the answer is the JSON sink's."""
    out = f"{checkpoint_root(spark)}/strata-fan-{uuid.uuid4().hex}"
    store = profile(read_table(spark, d, "orders"), "o_orderdate", "Q")
    fan_out(store, f"{out}/parquet", [lambda s: write_text(s, f"{out}/text"), lambda s: write_profiles(s, f"{out}/each", layout="period")])
    return exact_metrics(read_text_profiles(spark, f"{out}/text"), _fmt("Q"))


def queries() -> dict[str, QueryFn]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
