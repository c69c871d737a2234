"""File-name times and listing fields (hand-made cases)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from scenecast.functions import names as nm
from scenecast.sources import listing as ls

T = dt.datetime


@pytest.mark.parametrize("name,expected", [
    ("a_s202007171350001_e.nc", T(2020, 7, 17, 13, 50, 0)),          # first 14 digits
    ("a_s20201399000000_2020199_1350_.nc", None),                     # style 1 bad, no fall-back
    ("h_2020199_1350_x.nc", T(2020, 7, 17, 13, 50, 0)),               # style 2
    ("h_2021366_0000_x.nc", T(2022, 1, 1, 0, 0, 0)),                  # day 366 rolls over
    ("h_2021000_0000_x.nc", T(2020, 12, 31, 0, 0, 0)),                # day 000 rolls back
    ("h_2021001_2500_x.nc", None),                                    # bad hour
    ("h_2021001_1260_x.nc", None),                                    # bad minute
    ("x.nc", None),                                                   # no pattern
    ("a_s20210229000000.nc", None),                                   # no 29 Feb in 2021
    ("a_s20200229235959.nc", T(2020, 2, 29, 23, 59, 59)),
    ("a_s20200101000060.nc", None),                                   # second 60
    ("a_s00000101000000.nc", None),                                   # year 0
    ("h_0000001_0000_x.nc", None),                                    # year 0
])
def test_file_timestamp(spark, name, expected):
    df = spark.createDataFrame([(name,)], "name string")
    got = df.select(nm.file_timestamp("name").alias("t")).first()["t"]
    assert got == expected


def test_listing_fields(spark):
    urls = [
        ("gs://b/2021/06/01/0055/f1.nc",),
        ("gs://b/2021/06/01/2359/f2.nc",),
        ("gs://b/2021/06/01/f3.nc",),        # no HHmm segment
        ("gs://b/2021/06/01/9999/f4.nc",),   # no range check
    ]
    df = ls.with_listing_fields(spark.createDataFrame(urls, "url string"))
    rows = {r["name"]: r for r in df.collect()}
    assert rows["f1.nc"]["minute"] == 55 and rows["f1.nc"]["day"] == dt.date(2021, 6, 1)
    assert rows["f2.nc"]["minute"] == 23 * 60 + 59
    assert rows["f3.nc"]["minute"] is None
    assert rows["f4.nc"]["minute"] == 99 * 60 + 99


def test_day_prefix_and_range(spark):
    days = ls.day_range(spark, "2021-06-29", "2021-07-02")
    out = ls.day_prefixes(days, "gs://bucket/x/").orderBy("day").collect()
    assert [r["prefix"] for r in out] == ["gs://bucket/x/2021/06/29", "gs://bucket/x/2021/06/30",
                                          "gs://bucket/x/2021/07/01", "gs://bucket/x/2021/07/02"]


def test_basename(spark):
    df = spark.createDataFrame([("a/b/c.nc",), ("c2.nc",)], "p string")
    assert [r[0] for r in df.select(nm.basename("p")).collect()] == ["c.nc", "c2.nc"]


def test_time_parse_is_null_safe(spark):
    from scenecast.functions.calendar import parse_time_text
    df = spark.createDataFrame([("2021-06-01 10:00:00",), ("garbage",)], "s string")
    got = [r[0] for r in df.select(parse_time_text("s")).collect()]
    assert got == [T(2021, 6, 1, 10), None]
    assert df.select(nm.file_timestamp(F.lit("zz"))).first()[0] is None


def test_names_built_from_known_times(spark):
    """Names are written from times, so the time to read back is known."""
    import random
    rnd = random.Random(5)
    rows = []
    for k in range(300):
        t = T(1990, 1, 1) + dt.timedelta(seconds=rnd.randrange(10 ** 9))
        minute = t.replace(second=0)
        rows.append((f"a_s{t:%Y%m%d%H%M%S}{k % 10}_x.nc", t))
        rows.append((f"c_{t:%Y%j}_{t:%H%M}_v.nc", minute))
        rows.append((f"d_{t:%Y%j}_{t:%H%M}_s{t:%Y%m%d%H%M%S}.nc", t))     # style 1 decides
        rows.append((f"e_{t:%Y%j}_{t:%H%M}_s{t:%Y}99{t:%d%H%M%S}.nc", None))
        rows.append((f"f_{k}.nc", None))
    df = spark.createDataFrame(rows, "name string, want timestamp_ntz")
    got = df.select("name", "want", nm.file_timestamp("name").alias("t"))
    assert got.filter(~F.col("t").eqNullSafe(F.col("want"))).count() == 0
