"""Nearest-to-hour pick, skip existing, day report."""

import datetime as dt
import random

from scenecast.operators import nearest
from scenecast.sources import listing as ls


def _url(day: str, minute: int, name: str) -> str:
    y, m, d = day.split("-")
    return f"gs://b/{y}/{m}/{d}/{minute // 60:02d}{minute % 60:02d}/{name}.nc"


def _picks(spark, urls):
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    return {(r["day"].isoformat(), r["url"]) for r in nearest.nearest_per_hour(df).collect()}


def test_hour_tie_earlier_wins(spark):
    urls = [_url("2021-06-01", 55, "a"), _url("2021-06-01", 65, "b")]
    got = spark.createDataFrame([(u,) for u in urls], "url string")
    rows = {r["url"]: r["hours"] for r in nearest.nearest_per_hour(got).collect()}
    assert 1 in rows[urls[0]] and 1 not in rows[urls[1]]


def test_one_file_a_day(spark):
    urls = [_url("2021-06-01", 600, "only")]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    rows = nearest.nearest_per_hour(df).collect()
    assert len(rows) == 1 and rows[0]["hours"] == list(range(24))


def test_near_midnight_stays_in_day(spark):
    urls = [_url("2021-06-01", 1430, "late"), _url("2021-06-02", 10, "early")]
    got = _picks(spark, urls)
    assert ("2021-06-02", urls[1]) in got and ("2021-06-01", urls[0]) in got
    assert len(got) == 2


def test_unmatched_path_dropped(spark):
    urls = ["gs://b/2021/06/01/f.nc", _url("2021-06-01", 0, "ok")]
    assert _picks(spark, urls) == {("2021-06-01", urls[1])}


def test_same_minute_tie_by_url(spark):
    urls = [_url("2021-06-01", 0, "zz"), _url("2021-06-01", 0, "aa")]
    assert _picks(spark, urls) == {("2021-06-01", urls[1])}


def test_table_of_picks(spark):
    """Worked by hand: the nearest file to every hour, and which hours chose it."""
    files = {"a": 20, "b": 45, "c": 100, "d": 410, "e": 1439}
    urls = {n: _url("2021-06-05", m, n) for n, m in files.items()}
    df = spark.createDataFrame([(u,) for u in urls.values()], "url string")
    got = {r["url"]: r["hours"] for r in nearest.nearest_per_hour(df).collect()}
    # 01:00 is 15 from b; 02:00 20 and 03:00 80 and 04:00 140 from c; 04:15 is half way to d;
    # from 15:24.5 on, half way from d to e, e is nearer
    assert got == {urls["a"]: [0], urls["b"]: [1], urls["c"]: [2, 3, 4],
                   urls["d"]: list(range(5, 16)), urls["e"]: list(range(16, 24))}


def test_properties_on_random_days(spark):
    rnd = random.Random(7)
    urls = [_url(f"2021-06-{d:02d}", rnd.randrange(1440), f"f{d}_{i}")
            for d, n in ((1, 1), (2, 3), (3, 40), (4, 200)) for i in range(n)]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    rows = nearest.nearest_per_hour(df).collect()
    assert {r["url"] for r in rows} <= set(urls)
    for d in (1, 2, 3, 4):
        own = [r for r in rows if r["day"] == dt.date(2021, 6, d)]
        assert 1 <= len(own) <= 24
        assert sorted(h for r in own for h in r["hours"]) == list(range(24))    # each hour once


def test_skip_existing_and_day_report(spark):
    urls = [_url("2021-06-01", 0, "a"), _url("2021-06-01", 720, "b"),
            _url("2021-06-02", 0, "a"),          # same basename again next day
            _url("2021-06-02", 600, "c")]
    lst = spark.createDataFrame([(u,) for u in urls], "url string")
    held = spark.createDataFrame([("b.nc",), ("old.nc",)], "name string")
    fresh = nearest.skip_existing(nearest.nearest_per_hour(lst), held)
    assert {r["name"] for r in fresh.collect()} == {"a.nc", "c.nc"}
    days = ls.day_range(spark, "2021-05-31", "2021-06-03")
    rep = {r["day"]: r for r in nearest.day_report(days, lst, held).collect()}
    assert rep[dt.date(2021, 5, 31)]["available"] == 0
    assert rep[dt.date(2021, 5, 31)]["local_now"] == 2
    d1, d2 = rep[dt.date(2021, 6, 1)], rep[dt.date(2021, 6, 2)]
    assert (d1["available"], d1["chosen"], d1["new_requested"], d1["local_now"]) == (2, 2, 1, 3)
    # "a.nc" was fetched on day 1, so day 2 only requests "c.nc"
    assert (d2["available"], d2["chosen"], d2["new_requested"], d2["local_now"]) == (2, 2, 1, 4)
    assert rep[dt.date(2021, 6, 3)]["local_now"] == 4


def test_day_report_counts(spark):
    """Totals that any listing must keep: held names plus distinct new ones, day by day."""
    rnd = random.Random(21)
    urls = sorted({_url(f"2021-06-{d:02d}", rnd.randrange(1440), f"n{rnd.randrange(40)}")
                   for d in (1, 2, 3, 5, 6) for _ in range(rnd.randint(1, 30))})
    lst = spark.createDataFrame([(u,) for u in urls], "url string")
    held = spark.createDataFrame([(f"n{i}.nc",) for i in range(0, 40, 5)], "name string")
    days = ls.day_range(spark, "2021-05-31", "2021-06-07")
    rep = nearest.day_report(days, lst, held).orderBy("day").collect()
    chosen = nearest.nearest_per_hour(lst)
    fresh = nearest.skip_existing(chosen, held)
    assert len(rep) == 8 and sum(r["available"] for r in rep) == len(urls)
    assert sum(r["chosen"] for r in rep) == chosen.count()
    assert all(r["new_requested"] <= r["chosen"] <= min(24, r["available"]) for r in rep)
    assert rep[-1]["local_now"] == 8 + fresh.select("name").distinct().count()
    total = 8
    for r in rep:
        total += r["delta"]
        assert r["local_now"] == total


def test_files_below_a_part_that_is_no_time_are_available(spark):
    urls = ["gs://b/2021/06/01/0055/a.nc", "gs://b/2021/06/01/full/b.nc",
            "gs://b/2021/06/02/full/c.nc"]
    lst = spark.createDataFrame([(u,) for u in urls], "url string")
    held = spark.createDataFrame([], "name string")
    days = ls.day_range(spark, "2021-06-01", "2021-06-02")
    got = [(r["available"], r["chosen"]) for r in
           nearest.day_report(days, lst, held).orderBy("day").collect()]
    assert got == [(2, 1), (1, 0)]
