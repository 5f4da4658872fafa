import datetime as dt
import warnings

import pandas as pd
import pytest
from pyspark.sql import functions as F

from strata.functions.periods import (
    as_wall_clock, day_start_epoch, from_epoch, parse_frequency, parse_timestamp, period_label,
)

# Edge timestamps: midnight, last microsecond of a day, month end, leap day,
# Sunday/Monday around a week boundary, year end, mid-month.
EDGES = [
    "2024-01-01 00:00:00", "2023-12-31 23:59:59.999999", "2024-02-29 12:00:00",
    "2024-03-31 23:00:00", "2024-03-03 10:00:00", "2024-03-04 00:00:00", "2024-06-15 08:30:00",
    "2024-06-14 23:59:59", "2024-06-30 00:00:01", "2020-02-15 00:00:00", "2024-11-30 18:00:00",
    "2024-12-28 07:00:00", "2024-12-29 07:00:00", "1999-12-31 23:59:59", "2024-07-06 12:00:00",
    "2024-07-07 12:00:00", "2024-05-01 00:00:00", "2024-09-30 12:00:00", "2024-10-01 00:00:00",
]

# Our frequency -> the pandas 2.x spelling of the same rule.
PANDAS_NAME = {"D": "D", "H": "h", "T": "min", "W": "W", "W-MON": "W-MON", "W-WED": "W-WED",
               "W-SAT": "W-SAT", "M": "ME", "MS": "MS", "Q": "QE", "QS": "QS", "A": "YE",
               "AS": "YS", "SM": "SME", "SMS": "SMS", "B": "B",
               "Q-OCT": "QE-OCT", "QS-FEB": "QS-FEB", "A-JUN": "YE-JUN", "AS-APR": "YS-APR",
               "BM": "BME", "BMS": "BMS", "BQ": "BQE", "BQ-NOV": "BQE-NOV", "BQS": "BQS", "BA": "BYE",
               "BAS": "BYS", "BAS-JUL": "BYS-JUL", "ms": "ms"}


def pandas_label(ts: str, freq: str):
    s = pd.Series([1], index=pd.DatetimeIndex([pd.Timestamp(ts)]))
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        g = s.groupby(pd.Grouper(freq=PANDAS_NAME[freq])).count()
    return g[g > 0].index[0].to_pydatetime()


@pytest.mark.parametrize("freq", list(PANDAS_NAME))
def test_labels_match_pandas(spark, freq):
    df = spark.createDataFrame([(e,) for e in EDGES], "t string").select(
        F.col("t"), F.to_timestamp_ntz("t").alias("ts"))
    got = {r.t: r.lab for r in df.select(
        "t", period_label(F.col("ts"), freq).cast("timestamp_ntz").alias("lab")).collect()}
    for e in EDGES:
        want = pandas_label(e, freq)
        assert got[e] == want, (freq, e, got[e], want)


def test_parse_frequency():
    assert parse_frequency("D").unit == "D"
    assert parse_frequency("2D").n == 2
    assert parse_frequency("W").weekday == 6
    assert parse_frequency("W-MON").weekday == 0
    assert parse_frequency("min").unit == "T"
    assert parse_frequency("Q-DEC").unit == "Q"
    assert parse_frequency("YS").unit == "AS"
    assert parse_frequency("ms").unit == "L" and parse_frequency("MS").unit == "MS"
    assert parse_frequency("2Q-MAR").months == 6
    for bad in ["", "X", "2B", "W-XYZ", "Q-XYZ", "M-MAR", "0D"]:
        with pytest.raises(ValueError):
            parse_frequency(bad)


@pytest.mark.parametrize("freq,name", [("2M", "2ME"), ("3MS", "3MS"), ("2Q-JAN", "2QE-JAN"), ("2AS", "2YS"),
                                       ("5BM", "5BME"), ("2BQS", "2BQS")])
def test_calendar_multiples_count_from_the_epoch(spark, freq, name):
    marks = pd.date_range("1970-01-01", "2040-01-01", freq=name)
    df = spark.createDataFrame([(e,) for e in EDGES], "t string")
    got = {r.t: r.lab for r in df.select("t", period_label(F.to_timestamp_ntz("t"), freq).alias("lab")).collect()}
    for e in EDGES:
        day = pd.Timestamp(e).normalize()
        want = marks[marks <= day][-1] if parse_frequency(freq).unit.endswith("S") else marks[marks >= day][0]
        assert got[e] == want.date(), (freq, e)


def test_which_periods_nest():
    f = parse_frequency
    for fine, coarse in [("D", "W"), ("D", "BM"), ("H", "D"), ("M", "Q-OCT"), ("MS", "AS-APR"), ("Q-JAN", "A-APR"),
                         ("QS", "A"), ("W", "2W"), ("SMS", "M"), ("12H", "D"), ("ms", "T"), ("BM", "BQ"), ("M", "2M")]:
        assert f(fine).nests_in(f(coarse)), (fine, coarse)
    for fine, coarse in [("W", "M"), ("W", "W-MON"), ("Q", "A-APR"), ("M", "D"), ("36H", "D"), ("5H", "D"), ("2D", "M"),
                         ("B", "M"), ("SM", "M"), ("BM", "M"), ("M", "BM"), ("2M", "Q"), ("D", "H")]:
        assert not f(fine).nests_in(f(coarse)), (fine, coarse)


def test_multi_unit_bins_are_anchored_on_epoch(spark):
    df = spark.createDataFrame([("2024-01-04 10:00:00",), ("2024-01-05 10:00:00",)], "t string")
    ts = F.to_timestamp_ntz("t")
    r = df.select(period_label(ts, "2D").alias("d2"), period_label(ts, "36H").alias("h36"),
                  period_label(ts, "2D", anchor="2024-01-05").alias("d2a")).collect()
    # 2024-01-04 is day 19726 since epoch (even): both rows share the bin.
    assert r[0].d2 == r[1].d2 == dt.date(2024, 1, 4)
    assert r[0].d2a == dt.date(2024, 1, 3) and r[1].d2a == dt.date(2024, 1, 5)
    # 36-hour bins from the epoch: hour 473434 lies in [473400, 473436).
    assert r[0].h36 == dt.datetime(2024, 1, 3, 0, 0)
    assert r[1].h36 == dt.datetime(2024, 1, 4, 12, 0)


def test_day_start_epoch(spark):
    # The reference's own example value; our day is the UTC day.
    r = spark.createDataFrame([(1665114166,), (None,)], "t bigint").select(
        day_start_epoch(F.col("t")).alias("d")).collect()
    assert r[0].d == 1665100800
    assert r[1].d == 0


def test_wall_clock_is_independent_of_session_zone(spark):
    rows = [(dt.datetime(2024, 3, 10, 9, 30),)]  # a US DST switch day
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        df = spark.createDataFrame(rows, "ts timestamp_ntz")
        a = df.select(period_label(F.col("ts"), "H").alias("h"), period_label(F.col("ts"), "D").alias("d")).first()
        ltz = spark.sql("SELECT TIMESTAMP'2024-03-10 09:30:00+00:00' AS ts")
        b = ltz.select(as_wall_clock(F.col("ts"), ltz.schema["ts"].dataType).alias("w")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert a.h == dt.datetime(2024, 3, 10, 9, 0) and a.d == dt.date(2024, 3, 10)
    assert b.w == dt.datetime(2024, 3, 10, 9, 30)


def test_integral_dates_need_a_unit(spark):
    df = spark.createDataFrame([(1434565400,)], "time bigint")
    with pytest.raises(ValueError):
        as_wall_clock(F.col("time"), df.schema["time"].dataType)
    r = df.select(from_epoch(F.col("time"), "s").alias("a"),
                  from_epoch(F.col("time") * 1000, "ms").alias("b")).first()
    assert r.a == r.b == dt.datetime(2015, 6, 17, 18, 23, 20)


def test_parse_timestamp(spark):
    df = spark.createDataFrame([("2015-06-17 18:23:20.000000 UTC",), ("2015-06-17T20:23:20+02:00",),
                                ("2015-06-17 18:23:20",), ("not a date",), (None,)], "t string")
    r = df.select(parse_timestamp(F.col("t"), errors="coerce").alias("p")).collect()
    want = dt.datetime(2015, 6, 17, 18, 23, 20)
    assert [x.p for x in r] == [want, want, want, None, None]
    with pytest.raises(Exception):
        df.select(parse_timestamp(F.col("t"))).collect()


@pytest.mark.parametrize("freq,pandas_freq", [("2D", "2D"), ("3H", "3h"), ("5H", "5h"),
                                              ("36H", "36h"), ("90T", "90min"), ("7D", "7D")])
def test_multi_unit_labels_match_pandas_epoch_origin(spark, freq, pandas_freq):
    df = spark.createDataFrame([(e,) for e in EDGES], "t string").select(
        F.col("t"), F.to_timestamp_ntz("t").alias("ts"))
    got = {r.t: r.lab for r in df.select(
        "t", period_label(F.col("ts"), freq).cast("timestamp_ntz").alias("lab")).collect()}
    for e in EDGES:
        s = pd.Series([1], index=pd.DatetimeIndex([pd.Timestamp(e)]))
        g = s.groupby(pd.Grouper(freq=pandas_freq, origin="epoch")).count()
        assert got[e] == g[g > 0].index[0].to_pydatetime(), (freq, e)


def _random_timestamps(n=200, seed=7):
    import random
    rng = random.Random(seed)
    lo = dt.datetime(1990, 1, 1).timestamp()
    hi = dt.datetime(2030, 12, 31).timestamp()
    out = []
    for _ in range(n):
        t = dt.datetime.fromtimestamp(rng.uniform(lo, hi), dt.timezone.utc).replace(tzinfo=None)
        out.append(t.strftime("%Y-%m-%d %H:%M:%S.%f"))
    return out


@pytest.mark.parametrize("freq", list(PANDAS_NAME))
def test_labels_match_pandas_on_random_timestamps(spark, freq):
    stamps = _random_timestamps()
    df = spark.createDataFrame([(e,) for e in stamps], "t string").select(
        F.col("t"), F.to_timestamp_ntz("t").alias("ts"))
    got = {r.t: r.lab for r in df.select(
        "t", period_label(F.col("ts"), freq).cast("timestamp_ntz").alias("lab")).collect()}
    bad = [(e, got[e], pandas_label(e, freq)) for e in stamps if got[e] != pandas_label(e, freq)]
    assert not bad, bad[:3]


def test_fixed_bins_are_exact_far_from_the_epoch(spark):
    df = spark.createDataFrame([("9999-12-31 23:59:59.999999",), ("1901-03-04 05:06:07.000001",)], "t string")
    r = df.select(period_label(F.to_timestamp_ntz("t"), "S").alias("s"),
                  period_label(F.to_timestamp_ntz("t"), "3H").alias("h")).collect()
    assert r[0].s == dt.datetime(9999, 12, 31, 23, 59, 59)
    assert r[1].s == dt.datetime(1901, 3, 4, 5, 6, 7)
    assert r[1].h == dt.datetime(1901, 3, 4, 3, 0)  # pandas: Grouper(freq="3h", origin="epoch")


def test_parse_timestamp_with_format(spark):
    df = spark.createDataFrame([("17/06/2015 18:23",), ("bad",), ("17/06/2015 20:23 +02:00",)], "t string")
    fmt = "dd/MM/yyyy HH:mm"
    r = df.select(parse_timestamp(F.col("t"), fmt=fmt, errors="coerce").alias("p")).collect()
    assert r[0].p == dt.datetime(2015, 6, 17, 18, 23) and r[1].p is None
    z = df.where("t like '%+02:00'").select(
        parse_timestamp(F.col("t"), fmt=fmt + " XXX").alias("p")).first()
    assert z.p == dt.datetime(2015, 6, 17, 18, 23)


def test_frequency_units_match_case():
    # "ms" is milliseconds, "MS" is the month start
    assert parse_frequency("MS").unit == "MS"
    assert parse_frequency("ms").unit == "L"
    for freq in ("Ms", "qs", "sm"):
        with pytest.raises(ValueError):
            parse_frequency(freq)
