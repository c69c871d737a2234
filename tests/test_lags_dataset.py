"""W1, W2, two-level lag; P17-P23, A7; feature table."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from scenecast.operators import dataset as ds
from scenecast.operators import lags

T = dt.datetime


def _series(spark, times, values=None):
    values = values or [float(i) for i in range(len(times))]
    rows = [(f"f{i:04d}", t, v) for i, (t, v) in enumerate(zip(times, values))]
    df = spark.createDataFrame(rows, "file string, ts timestamp_ntz, v double")
    return df.withColumn("year", F.year("ts"))


def test_two_level_equals_window_random(spark):
    rnd = random.Random(11)
    start = T(2020, 12, 25)
    times = []
    # dense hot day, sparse days (fewer rows than k) and empty days
    for i in range(300):
        times.append(start + dt.timedelta(minutes=rnd.randrange(0, 60 * 24 * 14)))
    times += [T(2020, 12, 31, 23, 59), T(2021, 1, 1, 0, 0), T(2021, 1, 1, 0, 0)]
    times += [T(2021, 1, 3, 12) + dt.timedelta(seconds=i) for i in range(200)]
    df = _series(spark, times).withColumn("grp", F.pmod(F.hash("file"), F.lit(2)))
    for part in (["year"], ["grp"], []):
        a = lags.add_lags(df, "v", 3, partition_by=part, order_by=["ts", "file"])
        b = lags.add_lags(df, "v", 3, partition_by=part, order_by=["ts", "file"],
                          bucket=F.date_trunc("day", "ts"))
        ra = {r["file"]: tuple(r[f"v_lag{k}"] for k in (1, 2, 3)) for r in a.collect()}
        rb = {r["file"]: tuple(r[f"v_lag{k}"] for k in (1, 2, 3)) for r in b.collect()}
        assert ra == rb, part


def test_two_level_materialized(spark):
    times = [T(2021, 1, 1) + dt.timedelta(hours=7 * i) for i in range(50)]
    df = _series(spark, times)
    a = lags.add_lags(df, "v", 3, partition_by=[], order_by=["ts", "file"])
    b = lags.add_lags(df, "v", 3, partition_by=[], order_by=["ts", "file"],
                      bucket=F.date_trunc("day", "ts"), materialize=True)
    key = lambda d: sorted((r["file"], r["v_lag1"], r["v_lag3"]) for r in d.collect())
    assert key(a) == key(b)


@pytest.mark.parametrize("rows_per_bucket", [1, 7, 10_000])
def test_balanced_carry_in_groups_of_groups(spark, rows_per_bucket, monkeypatch):
    """Any number of buckets to a group gives the plain window, also over empty groups."""
    monkeypatch.setattr(lags, "FANOUT", 3)
    rnd = random.Random(5)
    times = [T(2021, 1, 1) + dt.timedelta(minutes=rnd.randrange(5_000)) for _ in range(90)]
    df = _series(spark, times).withColumn("grp", F.when(F.col("v") < 80, F.lit("hot")))
    for part in (["grp"], []):
        a = lags.add_lags(df, "v", 3, partition_by=part, order_by=["ts", "file"])
        staged = lags.balanced_buckets(df, ["ts", "file"], rows_per_bucket)
        groups = lags.balanced_groups(staged, 3)
        assert len(groups) == {1: 5, 7: 3, 10_000: 1}[rows_per_bucket]
        b = lags.add_lags(staged, "v", 3, partition_by=part, order_by=["ts", "file"],
                          bucket=F.col("__tbucket"), coarser=groups)
        rows = [sorted((r["file"], r["v_lag1"], r["v_lag2"], r["v_lag3"]) for r in d.collect())
                for d in (a, b)]
        assert [str(r) for r in rows[0]] == [str(r) for r in rows[1]]


def test_no_window_holds_all_buckets(spark):
    times = [T(2020, 1, 1) + dt.timedelta(hours=i) for i in range(60)]
    df = _series(spark, times)
    staged = lags.balanced_buckets(df, ["ts", "file"], 10)
    for out in (lags.add_lags(staged, "v", 3, partition_by=[], order_by=["ts", "file"],
                              bucket=F.col("__tbucket"), coarser=lags.balanced_groups(staged)),
                lags.add_time_delta(df, "ts", bucket=F.date_trunc("hour", "ts"))):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        windows = [line for line in plan.split("\n") if "Window [" in line]
        assert windows and all("__bucket" in w.split("], [")[1] for w in windows)


def test_lags_restart_each_year(spark):
    times = [T(2020, 12, 31, 21), T(2020, 12, 31, 22), T(2020, 12, 31, 23),
             T(2021, 1, 1, 0), T(2021, 1, 1, 1), T(2021, 1, 1, 2), T(2021, 1, 1, 3)]
    df = _series(spark, times).withColumn("timestamp_ms", F.unix_millis(F.col("ts").cast("timestamp")))
    out = {r["file"]: r for r in lags.add_lags(df, "v", 3, bucket=F.date_trunc("day", "ts")).collect()}
    assert [out[f"f000{i}"]["v_lag1"] for i in (3, 4, 5)] == [None, 3.0, 4.0]
    assert out["f0004"]["v_lag2"] is None and out["f0005"]["v_lag2"] == 3.0
    assert out["f0005"]["v_lag3"] is None
    assert out["f0006"]["v_lag3"] == 3.0
    assert out["f0002"]["v_lag2"] == 0.0


def test_delta_minutes_global(spark):
    times = [T(2020, 12, 31, 23), T(2021, 1, 1, 1), T(2021, 1, 1, 1, 10)]
    df = _series(spark, times)
    for bucket in (None, F.date_trunc("day", "ts")):
        out = {r["file"]: r["delta_minutes"] for r in
               lags.add_time_delta(df, "ts", bucket=bucket, order_by=["ts", "file"]).collect()}
        assert out == {"f0000": 0.0, "f0001": 120.0, "f0002": 10.0}


def _features(spark):
    rows = []
    for i, d in enumerate(["2021-06-15", "2021-06-16", "2021-06-17", "2021-06-18", "2021-06-19",
                           "2021-06-20", "2021-06-27", "2021-06-28"]):
        t = dt.datetime.fromisoformat(d + " 10:00:00")
        rows.append((f"f{i}", float(i), float(i), 0.1, 0.5, t.year, t.month, t.day, t.hour,
                     int(t.replace(tzinfo=dt.timezone.utc).timestamp() * 1000),
                     t.strftime("%Y-%m-%d %H:%M:%S"), 1440.0))
    from scenecast.schemas import FEATURES
    return spark.createDataFrame(rows, FEATURES)


def test_split_keeps_lags(spark):
    pre = ds.prepare(_features(spark))
    train, test = ds.time_split(pre, 2020, "2021-06-20", "2021-06-27")
    got = {r["date"].isoformat(): r for r in test.collect()}
    assert sorted(got) == ["2021-06-20", "2021-06-27"]
    assert got["2021-06-20"]["mean_rr_lag1"] == 4.0      # from 06-19, outside the window
    assert train.count() == 0
    sp = ds.split_frame(pre, 2021, "2021-06-20", "2021-06-27")
    counts = {r["split"]: r["rows_raw"] for r in ds.split_counts(sp).collect()}
    assert counts == {"train": 8, "test": 2}


def test_halo_read_is_exact(spark):
    f = _features(spark)
    full = ds.prepare(f).filter(ds.in_window("2021-06-20", "2021-06-27"))
    halo = ds.load_window(f, "2021-06-20", "2021-06-27")
    assert sorted(r["mean_rr_lag3"] for r in full.collect()) == \
        sorted(r["mean_rr_lag3"] for r in halo.collect())


def test_cyclic_hour(spark):
    from scenecast.functions.calendar import add_cyclical
    df = spark.createDataFrame([(0,), (6,), (12,)], "hour int")
    out = add_cyclical(df).orderBy("hour").collect()
    assert out[1]["hour_sin"] == pytest.approx(1.0) and out[2]["hour_cos"] == pytest.approx(-1.0)
    assert isinstance(out[0]["hour"], float)


def test_model_frame_drops_nan(spark):
    df = spark.createDataFrame([(1.0, 2.0), (float("nan"), 1.0), (None, 1.0), (3.0, 4.0)],
                               "mean_rr double, x double")
    mf = ds.model_frame(df, features=["x"])
    assert sorted(r["label"] for r in mf.collect()) == [1.0, 3.0]


def test_profile(spark):
    df = spark.createDataFrame([(1, None), (2, "a")], "a int, b string")
    got = {r["column"]: (r["type"], r["rows"], r["non_null"]) for r in ds.profile(df).collect()}
    assert got == {"a": ("int", 2, 2), "b": ("string", 2, 1)}


def test_feature_table_from_stats(spark):
    stats = spark.createDataFrame(
        [("b.nc", T(2021, 1, 1, 1), 2.0, 2.0, 0.0, 1.0), ("a.nc", T(2020, 12, 31, 23), 1.0, 1.0, 0.0, 0.0)],
        "file string, timestamp timestamp_ntz, mean_rr double, max_rr double, std_rr double, "
        "frac_rainy double")
    ft = ds.feature_table(stats, delta_bucket=F.date_trunc("day", "timestamp"))
    rows = {r["file"]: r for r in ft.collect()}
    assert rows["a.nc"]["delta_minutes"] == 0.0 and rows["b.nc"]["delta_minutes"] == 120.0
    assert rows["b.nc"]["timestamp_ms"] == 1609462800000
    assert rows["b.nc"]["timestamp_str"] == "2021-01-01 01:00:00"
    assert ft.columns == ds.FEATURE_TABLE_COLS


def test_balanced_buckets_split_a_hot_period(spark):
    # a third of all rows fall on one instant; the tie-break splits them
    base = T(2021, 3, 1)
    df = _series(spark, [base + dt.timedelta(hours=i) for i in range(400)]
                 + [base + dt.timedelta(hours=5)] * 200)
    for rows_per_bucket in (20, 50, 200):
        b = lags.balanced_buckets(df, ["ts", "file"], rows_per_bucket=rows_per_bucket)
        per = {r["__tbucket"]: r["count"] for r in b.groupBy("__tbucket").count().collect()}
        assert len(per) >= 0.7 * 600 / rows_per_bucket
        assert max(per.values()) <= 2 * rows_per_bucket
        # bucket ids increase with the ordering
        rows = sorted((r["ts"], r["file"], r["__tbucket"]) for r in b.collect())
        assert all(x[2] <= y[2] for x, y in zip(rows, rows[1:]))
    a = lags.add_lags(df, "v", 3, partition_by=[], order_by=["ts", "file"])
    c = lags.add_lags(df, "v", 3, partition_by=[], order_by=["ts", "file"], bucket="balanced",
                      rows_per_bucket=50)
    key = lambda d: sorted((r["file"], r["v_lag1"], r["v_lag2"], r["v_lag3"]) for r in d.collect())
    assert key(a) == key(c) and "__tbucket" not in c.columns


def test_balanced_single_bucket(spark):
    df = _series(spark, [T(2021, 1, 1) + dt.timedelta(hours=i) for i in range(10)])
    b = lags.balanced_buckets(df, ["ts", "file"], rows_per_bucket=1000)
    assert {r["__tbucket"] for r in b.collect()} == {0}
    out = lags.add_lags(df, "v", 2, partition_by=[], order_by=["ts", "file"], bucket="balanced",
                        rows_per_bucket=1000)
    assert sorted(r["v_lag2"] for r in out.collect() if r["v_lag2"] is not None) == \
        [float(i) for i in range(8)]


def test_two_level_with_null_times_and_keys(spark):
    rows = [(f"f{i:03d}", None if i % 17 == 0 else T(2021, 1, 1) + dt.timedelta(hours=3 * i),
             float(i), None if i % 11 == 0 else f"g{i % 3}") for i in range(120)]
    df = spark.createDataFrame(rows, "file string, ts timestamp_ntz, v double, grp string")
    for part in (["grp"], []):
        a = lags.add_lags(df, "v", 3, partition_by=part, order_by=["ts", "file"])
        b = lags.add_lags(df, "v", 3, partition_by=part, order_by=["ts", "file"],
                          bucket=F.date_trunc("day", "ts"))
        key = lambda d: sorted((r["file"], r["v_lag1"], r["v_lag2"], r["v_lag3"]) for r in d.collect())
        assert key(a) == key(b), part


def test_gaps_by_spans_equal_one_window_per_series(spark):
    rnd = random.Random(4)
    rows = [(s, f"f{i:04d}", T(2018, 12, 1) + dt.timedelta(hours=rnd.randrange(24 * 1500)))
            for i in range(200) for s in (1, 2, None) if s == 1 or rnd.random() < 0.05]
    # a series without rows in 2020, rows of one instant, rows without a time
    rows += [(7, f"g{t}", T(t, 12, 31, 23)) for t in (2018, 2019, 2021, 2022)]
    rows += [(8, c, T(2020, 1, 1)) for c in "ab"] + [(8, "c", None), (9, "d", None)]
    df = spark.createDataFrame(rows, "s int, file string, ts timestamp_ntz"
                               ).withColumn("year", F.year("ts"))
    order = ["ts", "file"]
    want = lags.add_time_delta(df, "ts", "gap", ["s"], order)
    got = lags.add_time_delta_spans(df, "ts", "gap", ["s"], order, "year")
    assert got.columns == want.columns
    key = lambda d: sorted(map(tuple, d.collect()), key=str)
    assert key(got) == key(want) and got.count() == len(rows)
