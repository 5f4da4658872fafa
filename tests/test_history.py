"""Compaction of a history: same answers, whole versions, nothing lost."""

import pytest
from pyspark.sql import functions as F

from strata.operators.merge import rollup
from strata.operators.profile import profile
from strata.operators.views import exact_metrics
from strata import files
from strata.sinks.history import BASES, Conflict, History, compact, read_history
from strata.sinks.writers import read_merged, run_path, write_run
from tests.conftest import SF001


@pytest.fixture(scope="module")
def orders(spark):
    return spark.read.parquet(f"{SF001}/orders.parquet").where(F.date_format("o_orderdate", "yyyy-MM").isin("1995-01", "1995-03", "1996-02"))


COLUMNS = ["o_orderkey", "o_totalprice"]


def part(orders, k, n=4):
    return profile(orders.where(F.col("o_orderkey") % n == k), "o_orderdate", "D", columns=COLUMNS)


def answer(store):
    return sorted(map(tuple, exact_metrics(rollup(store, "M"), {"dataset_ts": "yyyy-MM"}).collect()), key=repr)


def test_compaction_changes_no_answer(spark, orders, tmp_dir):
    want = answer(profile(orders, "o_orderdate", "D", columns=COLUMNS))
    h = History(spark, tmp_dir)
    for k in (0, 1):
        write_run(part(orders, k), tmp_dir, f"r{k}")
    half = answer(read_merged(spark, tmp_dir))
    assert compact(spark, tmp_dir).version == 1
    assert answer(read_merged(spark, tmp_dir)) == answer(read_history(spark, tmp_dir)) == half
    for k in (2, 3):
        write_run(part(orders, k), tmp_dir, f"r{k}")
    assert answer(read_history(spark, tmp_dir)) == want
    m = h.compact()
    assert m.version == 2 and len(m.folded) == 4 and h.compact() == m  # nothing new: no new version
    assert answer(read_history(spark, tmp_dir)) == want
    # one row per period and column, in one base
    rows = spark.read.parquet(f"{tmp_dir}/{BASES}/{next(iter(set(m.bases.values())))}")
    assert rows.groupBy("dataset_ts", "column").count().where("count > 1").count() == 0
    assert answer(h.read(version=1)) == want  # the first bases and the runs since
    gone = h.vacuum()
    assert sum(g.startswith("run=") for g in gone) == 4 and answer(read_merged(spark, tmp_dir)) == want


def test_interrupted_compaction_leaves_the_old_version(spark, orders, tmp_dir):
    for k in (0, 1):
        write_run(part(orders, k), tmp_dir, k)
    want = answer(read_merged(spark, tmp_dir))

    def fail():
        raise KeyboardInterrupt

    h = History(spark, tmp_dir)
    with pytest.raises(KeyboardInterrupt):
        h.compact(before_commit=fail)
    assert h.versions() == [] and answer(read_history(spark, tmp_dir)) == want
    assert len(files.children(spark, f"{tmp_dir}/{BASES}")) == 1
    m = h.compact()
    assert answer(read_history(spark, tmp_dir)) == want
    left = set(files.children(spark, f"{tmp_dir}/{BASES}")) - set(m.bases.values())
    assert {f"{BASES}/{f}" for f in left} <= set(h.vacuum()) and answer(read_history(spark, tmp_dir)) == want


def test_of_two_compactions_one_wins(spark, orders, tmp_dir):
    write_run(part(orders, 0), tmp_dir, "a")
    h, other = History(spark, tmp_dir), History(spark, tmp_dir)
    with pytest.raises(Conflict):
        h.compact(before_commit=lambda: other.compact())
    assert h.versions() == [1] and answer(h.read()) == answer(part(orders, 0))


def test_only_touched_months_are_folded_again(spark, orders, tmp_dir):
    early = orders.where(F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz"))
    h = History(spark, tmp_dir)
    write_run(profile(early, "o_orderdate", "D", columns=COLUMNS), tmp_dir, "early")
    one = h.compact()
    march = orders.where(F.date_format("o_orderdate", "yyyy-MM") == "1995-03")
    write_run(profile(march, "o_orderdate", "D", columns=COLUMNS), tmp_dir, "again")
    two = h.compact()
    assert {k for k in two.bases if two.bases[k] != one.bases.get(k)} == {"1995-03"}
    n = lambda df: df.where("column = 'o_orderkey'").agg(F.sum("n")).first()[0]
    assert n(h.read()) == early.count() + march.count()
    assert n(h.read("1995-03", "1995-03")) == 2 * march.count()
    assert n(h.read("1995-02")) == 2 * march.count() and h.read("1996-01").count() == 0
    with pytest.raises(ValueError):
        h.read("1995")


def test_folded_runs_are_not_replaced_and_versions_come_back(spark, orders, tmp_dir):
    write_run(part(orders, 0), tmp_dir, "a")
    h = History(spark, tmp_dir)
    h.compact()
    with pytest.raises(ValueError):
        write_run(part(orders, 1), tmp_dir, "a")
    h.revert(0)
    write_run(part(orders, 1), tmp_dir, "a")
    assert answer(h.read()) == answer(part(orders, 1))
    h.compact()
    h.vacuum()
    with pytest.raises(ValueError):
        h.revert(1)
    with pytest.raises(ValueError):
        h.revert(9)


def test_unfinished_units_and_the_newest_are_left(spark, orders, tmp_dir):
    for k in (9, 10):
        write_run(part(orders, k - 9), tmp_dir, k)
    h = History(spark, tmp_dir)
    files.delete(spark, f"{run_path(tmp_dir, '10')}/_SUCCESS")
    assert h.units() == ["run=9"]
    write_run(part(orders, 1), tmp_dir, 10)
    assert h.compact(keep_newest=1).folded == {"run=9"}
    assert answer(h.read()) == answer(profile(orders.where(F.col("o_orderkey") % 4 < 2), "o_orderdate", "D", columns=COLUMNS))


def test_runs_without_rows(spark, orders, tmp_dir):
    write_run(part(orders.where("false"), 0), tmp_dir, "none")
    assert compact(spark, tmp_dir).folded == {"run=none"}
    write_run(part(orders, 0), tmp_dir, "some")
    assert answer(read_history(spark, tmp_dir)) == answer(part(orders, 0))


def test_rows_without_a_period_and_odd_keys(spark, orders, tmp_dir):
    df = orders.select("*", F.lit("k").alias("period"), F.lit("m").alias("month")).withColumn(
        "o_orderdate", F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderdate")))
    keys = dict(by="period", columns=["o_orderkey"], null_dates="keep")
    for k in (0, 1):
        write_run(profile(df.where(F.col("o_orderkey") % 2 == k), "o_orderdate", "M", **keys), tmp_dir, k)
    before = sorted(map(tuple, exact_metrics(read_merged(spark, tmp_dir)).collect()), key=repr)
    compact(spark, tmp_dir)
    assert sorted(map(tuple, exact_metrics(read_merged(spark, tmp_dir)).collect()), key=repr) == before
    direct = exact_metrics(profile(df, "o_orderdate", "M", **keys))
    assert sorted(map(tuple, direct.collect()), key=repr) == before and {r[1] for r in before} == {"k"}
