"""Variable choice, crop, mask, clean, statistics."""

import math
import random

import pytest
from pyspark.sql import functions as F

from scenecast.operators import scenes as sc
from scenecast.schemas import SCENE_ARRAY, VAR_CATALOG


@pytest.mark.parametrize("n,win,lo,hi", [(8, 4, 2, 6), (9, 5, 2, 6), (3, 200, 0, 3), (1, 200, 0, 1)])
def test_crop_bounds(spark, n, win, lo, hi):
    df = spark.createDataFrame([(n,)], "n int")
    a, b = sc.crop_bounds("n", win)
    got = df.select(a.alias("a"), b.alias("b")).first()
    assert (got["a"], got["b"]) == (lo, hi)


def _scene(spark, scene_id, values, quality, ny=2, nx=2, file="a_s20200101000000.nc"):
    return spark.createDataFrame([(scene_id, file, ny, nx, values, quality)], SCENE_ARRAY)


def test_stats_fixture_array_and_long(spark):
    # pixels 2, 0, -1 and one masked cell: mean 1, max 2, std 1, frac 0.25
    df = _scene(spark, "s", [2.0, 0.0, -1.0, 5.0], [0, 0, 0, 1])
    for out in (sc.scene_stats_arrays(df, win=200),
                sc.scene_stats_long(sc.long_from_arrays(df), win=200)):
        r = out.first()
        assert (r["n_pixels"], r["n_valid"]) == (4, 2)
        assert r["mean_rr"] == pytest.approx(1.0)
        assert r["max_rr"] == pytest.approx(2.0)
        assert r["std_rr"] == pytest.approx(1.0)
        assert r["frac_rainy"] == pytest.approx(0.25)
        assert r["reject_reason"] is None


def test_mask_null_flag_vs_no_grid(spark):
    masked = _scene(spark, "m", [1.0, 1.0, 1.0, 1.0], [0, None, 0, 0])
    nogrid = _scene(spark, "n", [1.0, 1.0, 1.0, 1.0], None)
    assert sc.scene_stats_arrays(masked, 200).first()["n_valid"] == 3
    assert sc.scene_stats_arrays(nogrid, 200).first()["n_valid"] == 4
    assert sc.scene_stats_long(sc.long_from_arrays(masked), 200).first()["n_valid"] == 3


def test_nan_and_negative_removed(spark):
    df = _scene(spark, "x", [float("nan"), -3.0, 4.0, float("inf")], None)
    r = sc.scene_stats_arrays(df, 200).first()
    assert r["n_valid"] == 2 and r["n_finite"] == 1 and r["max_rr"] == math.inf


def test_all_invalid_rejected(spark):
    df = _scene(spark, "x", [-1.0, -2.0, 3.0, 4.0], [0, 0, 1, 1])
    r = sc.scene_stats_arrays(df, 200).first()
    assert r["reject_reason"] == sc.REJECT_NO_PIXEL
    assert sc.accepted(sc.scene_stats_arrays(df, 200)).count() == 0


def test_no_timestamp_rejected(spark):
    df = _scene(spark, "x", [1.0, 1.0, 1.0, 1.0], None, file="x.nc")
    assert sc.scene_stats_arrays(df, 200).first()["reject_reason"] == sc.REJECT_NO_TIME


def test_crop_selects_centre(spark):
    vals = [float(i) for i in range(64)]
    df = _scene(spark, "c", vals, None, ny=8, nx=8)
    cells = sc.center_crop_arrays(df, 4).first()["value"]
    expect = [float(r * 8 + c) for r in range(2, 6) for c in range(2, 6)]
    assert cells == expect
    long = sc.center_crop_long(sc.long_from_arrays(df), win=4)
    assert sorted(r["value"] for r in long.collect()) == expect


def test_array_equals_long_random(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(40):
        ny, nx = rnd.randint(1, 9), rnd.randint(1, 9)
        vals = [rnd.choice([rnd.uniform(-1, 5), float("nan"), 0.0]) for _ in range(ny * nx)]
        q = None if i % 4 == 0 else [rnd.choice([0, 0, 1, None]) for _ in range(ny * nx)]
        rows.append((f"s{i}", "a_s20200101000000.nc", ny, nx, vals, q))
    df = spark.createDataFrame(rows, SCENE_ARRAY)
    a = {r["scene_id"]: r for r in sc.scene_stats_arrays(df, 4, 0.5).collect()}
    b = {r["scene_id"]: r for r in sc.scene_stats_long(sc.long_from_arrays(df), 4, 0.5).collect()}
    assert a.keys() == b.keys()
    for k in a:
        for c in ("n_pixels", "n_valid", "reject_reason"):
            assert a[k][c] == b[k][c], (k, c)
        for c in ("mean_rr", "max_rr", "std_rr", "frac_rainy"):
            if a[k][c] is None:
                assert b[k][c] is None
            else:
                assert a[k][c] == pytest.approx(b[k][c], abs=1e-9), (k, c)


def test_pick_variable(spark):
    rows = [
        ("s1", "DQF", 2, "int8", 0), ("s1", "RRQPE", 2, "float32", 1),
        ("s2", "lat", 2, "float32", 0), ("s2", "latitude", 2, "float32", 1),
        ("s2", "b", 2, "int16", 2), ("s2", "c", 2, "float32", 3),
        ("s3", "d", 1, "float64", 0),
        ("s4", "RRQPE", 3, "float32", 5), ("s4", "e", 2, "float32", 0),
    ]
    got = {r["scene_id"]: r["var"] for r in
           sc.pick_variable(spark.createDataFrame(rows, VAR_CATALOG)).collect()}
    # "lat" is not latitude/longitude, so it is a valid 2-D float candidate first
    want = {"s1": "RRQPE", "s2": "lat", "s3": None, "s4": "RRQPE"}
    assert got == want
    # the same catalogue as an array in each scene's row; no variables at all give none
    per_scene = {s: [r[1:] for r in rows if r[0] == s] for s in want} | {"s5": [], "s6": None}
    scenes = spark.createDataFrame(list(per_scene.items()), (
        "scene_id string, variables array<struct<var:string,ndims:int,dtype:string,ordinal:int>>"))
    inside = sc.pick_variable_arrays(scenes).collect()
    assert {r["scene_id"]: r["var"] for r in inside} == want | {"s5": None, "s6": None}
    assert {r["scene_id"]: r["ndims"] for r in inside}["s4"] == 3


def test_build_report_and_rejects(spark):
    df = spark.createDataFrame([(2020, 1.0), (2021, 3.0), (2020, 2.0)], "year int, mean_rr double")
    r = sc.build_report(df).first()
    assert (r["rows"], r["years"], r["min_mean_rr"], r["max_mean_rr"]) == (3, [2020, 2021], 1.0, 3.0)
    st = spark.createDataFrame([("a", None), ("b", "no_finite_pixel"), ("c", None)],
                               "scene_id string, reject_reason string")
    got = {r["outcome"]: r["scenes"] for r in sc.reject_counts(st).collect()}
    assert got == {"accepted": 2, "no_finite_pixel": 1}


def test_float_value_kept_as_double(spark):
    df = _scene(spark, "f", [0.1, 0.2, 0.3, 0.4], None)
    r = sc.scene_stats_arrays(df, 200).first()
    assert r["mean_rr"] == pytest.approx(0.25, rel=1e-6)
    assert df.select(F.col("value")[0]).first()[0] == pytest.approx(0.1, rel=1e-6)


def test_long_crop_derives_dims(spark):
    vals = [float(i) for i in range(36)]
    df = _scene(spark, "d", vals, None, ny=6, nx=6)
    long = sc.long_from_arrays(df).drop("ny", "nx")
    cropped = sc.center_crop_long(long, win=2)          # 6x6 -> rows/cols [2, 4)
    assert sorted(r["value"] for r in cropped.collect()) == [14.0, 15.0, 20.0, 21.0]
    dims = spark.createDataFrame([("d", 6, 6)], "scene_id string, ny int, nx int")
    given = sc.center_crop_long(long, dims=dims, win=2)
    assert given.count() == 4
    st = sc.scene_stats_long(long, win=2).first()
    assert st["mean_rr"] == pytest.approx(17.5) and st["n_pixels"] == 4


def test_missing_and_short_grids_are_rejected(spark):
    rows = [("a", "h_2020199_1350_a.nc", 4, 4, None, None),
            ("b", "h_2020199_1350_b.nc", 4, 4, [1.0, 2.0, 3.0], None),
            ("c", "h_2020199_1350_c.nc", None, 4, [1.0] * 16, None),
            ("d", "h_2020199_1350_d.nc", 4, 4, [1.0] * 16, None),
            ("e", "h_2020199_1350_e.nc", 4, 4, [None] * 16, None)]
    df = spark.createDataFrame(rows, "scene_id string, file string, ny int, nx int, "
                                     "value array<float>, quality array<int>")
    got = {r["scene_id"]: r["reject_reason"] for r in sc.scene_stats_arrays(df, 4).collect()}
    assert got == {"a": sc.REJECT_BAD_GRID, "b": sc.REJECT_BAD_GRID, "c": sc.REJECT_BAD_GRID,
                   "d": None, "e": sc.REJECT_NO_PIXEL}
