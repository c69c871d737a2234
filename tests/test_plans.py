"""Physical-plan properties that the design relies on (regression guards)."""

import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from scenecast.plans import catalog, series
from scenecast.sources import listing as ls

MODEL_QUERIES = {"linreg_nine", "tree", "forest", "boosted", "importance_rank",
                 "linreg_coefficients", "backtest_saved", "linreg_one_feature", "tree_stump",
                 "standardized", "forest_stump", "boosted_two_rounds", "backtest_linear",
                 "linreg_two_coefficients", "linreg_by_series", "job_train_backtest"}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_udfs_anywhere(spark):
    for name, fn in catalog.QUERIES.items():
        if name in MODEL_QUERIES:
            continue
        p = _plan(fn(spark, SF_SMALL))
        for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct",
                    "BroadcastNestedLoopJoin"):
            assert bad not in p, (name, bad)


def test_array_scene_stats_do_not_shuffle(spark):
    p = _plan(catalog.QUERIES["scene_stats"](spark, SF_SMALL))
    assert "Exchange" not in p


def test_series_aggregate_is_partial_and_pruned(spark):
    df = catalog.QUERIES["series_hourly"](spark, SF_SMALL)
    p = _plan(df)
    assert "partial_avg" in p and "SortAggregate" not in p
    assert "ReadSchema: struct<ts:timestamp_ntz,value:double>" in p


def test_nearest_pick_reads_the_listing_once(spark):
    p = _plan(catalog.QUERIES["nearest_hour_files"](spark, SF_SMALL))
    # one scan, summed per (day, minute) before the shuffle, and no join
    assert p.count("FileScan parquet") == 1 and "Join" not in p and "partial_min" in p


def test_variable_choice_stays_in_the_row(spark):
    p = _plan(catalog.QUERIES["pick_variable"](spark, SF_SMALL))
    assert "Exchange" not in p and "Join" not in p
    p = _plan(catalog.QUERIES["scene_rejects"](spark, SF_SMALL))
    assert p.count("FileScan parquet") == 1 and "Join" not in p


def test_all_models_score_in_one_scan(spark, tmp_path):
    from scenecast.operators import models as mdl
    rows = [(float(i), float(i % 7), 2.0 * i) for i in range(40)]
    spark.createDataFrame(rows, "a double, b double, label double").write.parquet(
        str(tmp_path / "f"))
    frame = spark.read.parquet(str(tmp_path / "f"))
    fitted = {n: mdl.linear_pipeline([n]).fit(frame) for n in ("a", "b")}
    pred = mdl.predict(fitted, frame)
    assert _plan(pred).count("FileScan parquet") == 1 and pred.count() == 80


def test_many_series_have_bucketed_windows(spark):
    p = _plan(catalog.QUERIES["feature_table_by_series"](spark, SF_SMALL))
    assert "l_suppkey" in p and "__bucket" in p


def test_heavy_lag_window_is_bucketed(spark):
    p = _plan(catalog.QUERIES["lag_two_level"](spark, SF_SMALL))
    # the per-row window is partitioned by (series, bucket), not by series alone
    assert "__bucket" in p


def test_read_listing_metadata_only(spark, tmp_path):
    for d, name in [("2021/06/01/0000", "a.nc"), ("2021/06/01/0010", "b.nc"),
                    ("2021/06/02/0000", "c.nc"), ("2021/06/02/0000", "skip.txt")]:
        os.makedirs(tmp_path / d, exist_ok=True)
        (tmp_path / d / name).write_bytes(b"x" * 10)
    lst = ls.read_listing(spark, str(tmp_path))
    assert "content" not in _plan(lst).split("ReadSchema:")[1].split("\n")[0]
    rows = lst.collect()
    assert sorted(r["url"].rsplit("/", 1)[-1] for r in rows) == ["a.nc", "b.nc", "c.nc"]
    f = {r["name"]: r for r in ls.with_listing_fields(lst).collect()}
    assert f["b.nc"]["minute"] == 10 and str(f["c.nc"]["day"]) == "2021-06-02"
    held = ls.held_names(lst)
    assert {r["name"] for r in held.collect()} == {"a.nc", "b.nc", "c.nc"}


@pytest.mark.parametrize("name", ["top_errors_per_model"])
def test_group_top_n_limits_before_shuffle(spark, name):
    p = _plan(catalog.QUERIES[name](spark, SF_SMALL))
    assert "WindowGroupLimit" in p


def _row_shuffles(df) -> int:
    """Shuffles of the table's rows; those of one row per series and span are left out."""
    return _plan(df).count("Exchange hashpartitioning(")


def test_many_series_are_shuffled_for_scenes_and_once_for_gaps_and_lags(spark):
    df = catalog.QUERIES["feature_table_by_series"](spark, SF_SMALL)
    p = _plan(df)
    # nothing is written on the way, and no join hands carries back to the rows
    assert p.count("FileScan parquet") == 2 and "Join" not in p and "Scan ExistingRDD" not in p
    # scenes (both branches), last times per series and year, per series; rows by series and year
    assert _row_shuffles(df) == 5


def test_one_reader_of_the_series_writes_nothing(spark):
    p = _plan(catalog.QUERIES["scores_by_series"](spark, SF_SMALL))
    assert "Scan ExistingRDD" not in p and "Join" not in p


def test_both_sets_of_the_series_are_written_without_other_rows(spark):
    train, test = catalog.s_frames(spark, SF_SMALL)
    p = _plan(train)
    assert "Scan ExistingRDD" in p and "FileScan" not in p and "timestamp_str" not in p
    years = {r["y"] for f in (train, test) for r in f.select(
        F.year("timestamp").alias("y")).distinct().collect()}
    assert years == {catalog.D_TRAIN_YEAR, 2001}


def test_series_fits_read_the_split_rows(spark):
    # one read of the written rows each for the fits, the test rows and the fits joined to them
    p = _plan(catalog.QUERIES["linreg_per_series"](spark, SF_SMALL))
    assert "FileScan" not in p and "timestamp_str" not in p


def _scene_filters(plan: str) -> str:
    """What the scan under the scenes' aggregate filters by (the first scan in the plan's text)."""
    return plan.split("FileScan parquet")[1].split("DataFilters: ")[1].split("Format:")[0]


def test_scenes_outside_the_years_of_the_sets_are_not_shuffled(spark, monkeypatch):
    df = catalog.QUERIES["scores_by_series"](spark, SF_SMALL)
    assert "year(" in _scene_filters(_plan(df))
    # last times by supplier and year, by supplier; scenes; rows by supplier and year; scores
    assert _row_shuffles(df) == 5
    written = []
    monkeypatch.setattr(catalog, "materialize", lambda p: written.append(_plan(p)) or p)
    catalog.s_frames(spark, SF_SMALL)
    assert "year(" in _scene_filters(written[0])
    # the last times before a year come from the pixels of all years, without another aggregate of scenes
    for p in (_plan(df), written[0]):
        assert "year(" not in p.split("FileScan parquet")[2].split("DataFilters: ")[1].split(
            "Format:")[0]
        assert p.count("Exchange hashpartitioning(l_suppkey#") >= 3
        assert p.count("partial_stddev_pop") == 1 and p.count("partial_max(timestamp") == 1


@pytest.mark.parametrize("name", ["scores_by_series", "feature_table_by_series"])
def test_pixels_of_the_suppliers_are_shuffled_before_they_are_grouped(spark, monkeypatch, name):
    import re
    monkeypatch.setattr(series, "ROWS_PER_BUCKET", 250)
    p = _plan(catalog.QUERIES[name](spark, SF_SMALL))
    rows = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    # a partial aggregate of scenes would hold a group for nearly every row of a split
    dealt = re.findall(r"hashpartitioning\(l_suppkey#\d+L?, timestamp#\d+, (\d+)\), (\w+)", p)
    assert dealt and set(dealt) == {(str(-(-rows // 250)), "REPARTITION_BY_NUM")}
    assert "partial_stddev_pop" in p.split("REPARTITION_BY_NUM")[0]


def test_scenes_of_the_suppliers_equal_those_of_the_plain_aggregate(spark):
    import datetime as dt
    import itertools
    prices = [5.0, 60000.0, 7.5, -1.0, float("nan"), None]
    days = [dt.datetime(2000, 1, 1, 5), dt.datetime(2000, 1, 1), dt.datetime(2001, 3, 3), None]
    rows = [(s, t, v) for s, t in itertools.product((1, 2, None), days) for v in prices] * 2
    rows += [(4, days[0], None), (4, days[2], float("nan"))]
    df = spark.createDataFrame(
        rows, "l_suppkey long, l_shipdate timestamp_ntz, l_extendedprice double")
    plain = series.series_stats(df, "l_shipdate", "l_extendedprice", "day", "D",
                                series.D_THRESHOLD, ["l_suppkey"])

    def key(d):
        return sorted(([round(x, 9) if isinstance(x, float) else x for x in r]
                       for r in d.collect()), key=str)
    got = key(series.supplier_stats(df))
    assert got == key(plain) and len(got) == 11


def test_last_times_before_the_years_of_the_sets_are_one_a_supplier(spark, tmp_path, monkeypatch):
    import datetime as dt
    from scenecast.operators import dataset as ds
    rows = [(s, dt.datetime(y, m, 3), float(m)) for s in (1, 2, None) for y in range(1990, 2003)
            for m in (2, 9)] + [(1, None, 4.0), (4, dt.datetime(1991, 5, 5), 5.0),
                                (4, dt.datetime(2002, 5, 5), 5.0), (None, None, 1.0)]
    spark.createDataFrame(rows, "l_suppkey long, l_shipdate timestamp_ntz, l_extendedprice double"
                          ).write.parquet(str(tmp_path / "lineitem.parquet"))
    spans = []
    plain = ds.add_time_delta_spans

    def seen(*args):
        spans.append(args[-1])
        return plain(*args)
    monkeypatch.setattr(ds, "add_time_delta_spans", seen)
    catalog.s_frames(spark, str(tmp_path), shared=False)
    # 1990 to 1999 as one, then 2000, 2001 and 2002
    assert spans[0].select("l_suppkey", "year").distinct().count() == 3 * 4 + 2

    whole = catalog.s_prepared(spark, str(tmp_path)).filter("year >= 2000").collect()
    got = catalog.s_prepared(spark, str(tmp_path), from_year=2000).collect()
    assert sorted(got, key=str) == sorted(whole, key=str) and len(got) == 19


def test_frames_of_the_series_equal_the_split_of_all_rows(spark, tmp_path):
    import datetime as dt
    import random
    from scenecast.operators import dataset as ds
    rnd = random.Random(6)
    prices = [10.0, 60000.0, 7.5, -1.0, float("nan"), None]
    days = [dt.datetime(y, 1, 1) + dt.timedelta(days=d) for y in (1998, 2000, 2001, 2002)
            for d in (0, 1, 2, 5, 9, 200, 364)]
    rows = [(s, t, rnd.choice(prices)) for s in (1, 2, None) for t in [*days, None]
            for _ in range(3) if rnd.random() < 0.8]
    # a supplier whose only valid rows before 2001 are of 1998
    rows += [(3, dt.datetime(1998, 5, 5), 5.0), (3, dt.datetime(2000, 5, 5), -5.0)]
    rows += [(3, dt.datetime(2001, 1, d), float(d)) for d in range(1, 7)]
    spark.createDataFrame(rows, "l_suppkey long, l_shipdate timestamp_ntz, l_extendedprice double"
                          ).write.parquet(str(tmp_path / "lineitem.parquet"))

    def key(d):
        return sorted(map(tuple, d.collect()), key=str)
    whole = catalog.s_prepared(spark, str(tmp_path))
    assert key(catalog.s_prepared(spark, str(tmp_path), pixel_times=True)) == key(whole)
    want = [ds.model_frame(f, keys=catalog.S_KEYS)
            for f in ds.time_split(whole, catalog.D_TRAIN_YEAR, *catalog.S_TEST)]
    assert all(f.count() for f in want)
    for shared in (True, False):
        got = catalog.s_frames(spark, str(tmp_path), shared)
        assert [key(f) for f in got] == [key(f) for f in want]
