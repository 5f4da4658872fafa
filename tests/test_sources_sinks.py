import glob
import os

import pytest

from strata import exact_metrics, merge_stores, profile
from strata.plans.jobs import profile_job
from strata.sinks import fan_out, read_profiles, write_each, write_profiles, write_text
from strata.sources import (
    enforce_schema, from_records, is_table_reference, read_csv, read_input, register_tables,
)
from tests.conftest import SF001

# The reference's sample rows (header and values as published).
SAMPLE_CSV = """id,by,author,time,time_ts,text,parent,deleted,dead,ranking
9734136,,,1434565400,2015-06-17 18:23:20.000000 UTC,,9733698,true,,0
4921158,,,1434565400,2012-12-14 14:56:06.000000 UTC,,4921100,true,,0
7500568,,,1434065400,2014-03-31 10:19:18.000000 UTC,,7499385,true,,0
"""
SAMPLE_SCHEMA = ("id bigint, by string, author string, time bigint, time_ts string, text string, "
                 "parent bigint, deleted boolean, dead boolean, ranking int")


def test_table_reference_resolution():
    assert is_table_reference("lineitem")
    assert is_table_reference("db.lineitem")
    assert is_table_reference("my-project:dataset.table")
    assert not is_table_reference("select 'a:b' from ds.t")
    assert not is_table_reference("p:d.t where 1")
    assert not is_table_reference("select * from lineitem")


def test_read_input(spark):
    register_tables(spark, SF001, ["nation", "region"])
    assert read_input(spark, "nation").count() == 25
    assert read_input(spark, "select * from region where r_regionkey < 2").count() == 2
    assert read_input(spark, table="region").count() == 5
    assert read_input(spark, path=f"{SF001}/region.parquet").count() == 5
    with pytest.raises(ValueError):
        read_input(spark, "nation", table="nation")


def test_csv_records_and_schema(spark, tmp_dir):
    p = os.path.join(tmp_dir, "sample.csv")
    with open(p, "w") as f:
        f.write(SAMPLE_CSV)
    df = read_csv(spark, p, schema=SAMPLE_SCHEMA)
    assert df.count() == 3 and df.where("by IS NULL").count() == 3
    by_ts = {r.dataset_ts.date() for r in profile(df, "time_ts", "D", columns=["id"]).collect()}
    assert len(by_ts) == 3  # text timestamps with a zone suffix are parsed
    recs = from_records(spark, [{"a": 1, "b": "x"}, {"a": 2}], "a int, b string")
    assert recs.collect()[1].b is None
    wide = enforce_schema(recs, "b string, a bigint")
    assert wide.columns == ["b", "a"] and dict(wide.dtypes)["a"] == "bigint"
    with pytest.raises(Exception):
        enforce_schema(recs, "a int, missing string")


def test_partitioned_store_one_file_per_period(spark, tmp_dir):
    events = spark.read.parquet(f"{SF001}/events.parquet")
    store = profile(events, "ts", "D")
    out = os.path.join(tmp_dir, "store")
    write_profiles(store, out, layout="period")
    dirs = glob.glob(os.path.join(out, "period=*"))
    assert len(dirs) == store.select("dataset_ts").distinct().count()
    assert all(len(glob.glob(os.path.join(d, "*.parquet"))) == 1 for d in dirs)
    back = read_profiles(spark, out)
    assert sorted(map(tuple, exact_metrics(back).collect())) == \
        sorted(map(tuple, exact_metrics(store).collect()))
    # sketches survive the round trip: merging the read copy with itself works
    assert merge_stores([back, back]).count() == store.count()
    monthly = os.path.join(tmp_dir, "monthly")
    write_profiles(store, monthly)
    assert len(glob.glob(os.path.join(monthly, "period=*"))) == 1  # events span one month... or two
    assert read_profiles(spark, monthly).count() == store.count()


def test_text_sink_and_writer(spark, tmp_dir):
    events = spark.read.parquet(f"{SF001}/events.parquet")
    store = profile(events, "ts", "W")
    write_text(store, os.path.join(tmp_dir, "json"))
    assert spark.read.json(os.path.join(tmp_dir, "json")).count() == store.count()

    acc = spark.sparkContext.accumulator(0)

    def writer(pairs):
        keys = set()
        for key, row in pairs:
            assert key not in keys
            keys.add(key)
            acc.add(1)

    written = fan_out(store, os.path.join(tmp_dir, "fan"), [lambda s: write_each(s, writer, "ds")])
    assert acc.value == store.count() == written.count()


def test_profile_job(spark, tmp_dir):
    out = os.path.join(tmp_dir, "job")
    seen = spark.sparkContext.accumulator(0)

    def writer(pairs):
        for _ in pairs:
            seen.add(1)

    t = profile_job(spark, table_path=f"{SF001}/orders.parquet", date_column="o_orderdate",
                    freq="M", output=out, writer=writer, dataset_id="orders", readable=True)
    assert t.count() == seen.value > 0
    assert {"distinct_est", "quantiles", "frequent_items"} <= set(t.columns)
    with pytest.raises(ValueError):
        profile_job(spark, table_path=f"{SF001}/orders.parquet", date_column="nope")
    with pytest.raises(ValueError):
        profile_job(spark, table_path=f"{SF001}/orders.parquet", date_column="o_orderdate",
                    freq="fortnight")


def test_incremental_runs_fold_into_history(spark, tmp_dir):
    from strata.sinks import read_merged, write_run

    orders = spark.read.parquet(f"{SF001}/orders.parquet")
    early = orders.where("o_orderdate < TIMESTAMP_NTZ'1995-06-15 00:00:00'")
    late = orders.where("o_orderdate >= TIMESTAMP_NTZ'1995-06-15 00:00:00'")
    out = os.path.join(tmp_dir, "history")
    write_run(profile(early, "o_orderdate", "D"), out, "run1")
    write_run(profile(late, "o_orderdate", "D"), out, "run2")
    write_run(profile(late, "o_orderdate", "D"), out, "run2")  # a retried run replaces itself
    merged = read_merged(spark, out)
    direct = profile(orders, "o_orderdate", "D")
    assert sorted(map(tuple, exact_metrics(merged).collect())) == \
        sorted(map(tuple, exact_metrics(direct).collect()))
    june = read_merged(spark, out, start="1995-06", end="1995-06")
    assert {r.dataset_ts.month for r in june.select("dataset_ts").distinct().collect()} == {6}


def test_command_line_job(spark, tmp_dir):
    from strata.plans.cli import main, parse_args
    from strata.sinks import read_profiles

    out = os.path.join(tmp_dir, "cli")
    main(["--path", f"{SF001}/orders.parquet", "--date-column", "o_orderdate", "--freq", "M",
          "--output", out, "--columns", "o_totalprice,o_orderstatus", "--logging-level", "warn"],
         spark=spark)
    store = read_profiles(spark, out)
    assert {r.column for r in store.select("column").distinct().collect()} == {"o_totalprice", "o_orderstatus"}
    for bad in (["--input", "t", "--output", "o", "--freq", "fortnight"],
                ["--input", "t", "--output", "o", "--logging-level", "LOUD"],
                ["--output", "o"]):
        with pytest.raises(SystemExit):
            parse_args(bad)


def test_all_feeding_styles_give_the_same_profile(spark, tmp_dir):
    """Table, in-memory records, CSV files and a stream of the same rows."""
    from strata.streaming import merge_panes, profile_stream

    orders = spark.read.parquet(f"{SF001}/orders.parquet")
    schema = orders.schema
    fmt = {"dataset_ts": "yyyy-MM-dd"}
    direct = sorted(map(tuple, exact_metrics(profile(orders, "o_orderdate", "M"), fmt).collect()))

    recs = from_records(spark, [r.asDict() for r in orders.collect()], schema)
    assert sorted(map(tuple, exact_metrics(profile(recs, "o_orderdate", "M"), fmt).collect())) == direct

    csv_dir = os.path.join(tmp_dir, "csv")
    orders.write.option("header", True).csv(csv_dir)
    from_csv = read_csv(spark, csv_dir, schema=schema)
    assert sorted(map(tuple, exact_metrics(profile(from_csv, "o_orderdate", "M"), fmt).collect())) == direct

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).csv(csv_dir, header=True)
    out = os.path.join(tmp_dir, "panes")
    profile_stream(stream, out, "o_orderdate", "M", checkpoint=os.path.join(tmp_dir, "ck"),
                   trigger={"availableNow": True}).awaitTermination()
    assert sorted(map(tuple, exact_metrics(merge_panes(spark, out), fmt).collect())) == direct


def test_profile_job_appends_runs(spark, tmp_dir):
    orders_path = f"{SF001}/orders.parquet"
    register_tables(spark, SF001, ["orders"])
    out = os.path.join(tmp_dir, "runs")
    q1 = "select * from orders where o_orderdate < TIMESTAMP_NTZ'1996-01-01 00:00:00'"
    q2 = "select * from orders where o_orderdate >= TIMESTAMP_NTZ'1996-01-01 00:00:00'"
    profile_job(spark, q1, date_column="o_orderdate", freq="M", output=out, run_id="a")
    merged = profile_job(spark, q2, date_column="o_orderdate", freq="M", output=out, run_id="b")
    direct = profile(spark.read.parquet(orders_path), "o_orderdate", "M")
    assert sorted(map(tuple, exact_metrics(merged).collect())) == \
        sorted(map(tuple, exact_metrics(direct).collect()))


def test_service_sink_through_the_writer_api(spark, tmp_dir):
    import json
    import uuid

    from strata.sinks.service import ProfileServiceSink

    inbox = os.path.join(tmp_dir, "inbox")
    os.makedirs(inbox)

    class FileUpload(ProfileServiceSink):
        @classmethod
        def name(cls):
            return "test_file_upload"

        def send(self, records):
            with open(os.path.join(inbox, uuid.uuid4().hex + ".jsonl"), "w") as f:
                for r in records:
                    f.write(json.dumps({"key": r["key"], "n": r["n"]}) + "\n")

        def on_commit(self, delivered):
            with open(os.path.join(inbox, "_COMMITTED"), "w") as f:
                f.write(str(delivered))

    spark.dataSource.register(FileUpload)
    store = profile(spark.read.parquet(f"{SF001}/orders.parquet"), "o_orderdate", "M")
    (store.write.format("test_file_upload").option("dataset_id", "orders")
     .option("batch_size", "7").mode("append").save())
    lines = [json.loads(x) for p in glob.glob(os.path.join(inbox, "*.jsonl")) for x in open(p)]
    assert len(lines) == store.count() == len({x["key"] for x in lines})
    assert all(x["key"].startswith("orders/") for x in lines)
    assert int(open(os.path.join(inbox, "_COMMITTED")).read()) == len(lines)


def test_service_sink_requires_dataset_id(spark):
    from strata.sinks.service import ProfileServiceSink

    class NoopUpload(ProfileServiceSink):
        @classmethod
        def name(cls):
            return "test_noop_upload"

        def send(self, records):
            pass

    spark.dataSource.register(NoopUpload)
    store = profile(spark.read.parquet(f"{SF001}/region.parquet"))
    with pytest.raises(Exception, match="dataset_id"):
        store.write.format("test_noop_upload").mode("append").save()
