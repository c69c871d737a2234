"""Loads, runs, tiles, fits per series and stateful streams: seams, pruning, restarts, late rows."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from scenecast.operators import scenes as sc
from scenecast.operators import series_fit, tiles
from scenecast.plans import series
from scenecast.schemas import RUN
from scenecast.session import shared_dir
from scenecast.sources import feature_store as fs
from scenecast.sources import runs
from scenecast.streaming import stateful
from tests.conftest import SF_SMALL

STATS = ("s long, file string, timestamp timestamp_ntz, mean_rr double, max_rr double, "
         "std_rr double, frac_rainy double")


def stats(spark, rows):
    return spark.createDataFrame([(s, f"f{s}_{t:%Y%m%d%H}", t, float(v), v + 1.0, 0.5, 0.25)
                                  for s, t, v in rows], STATS)


def table_rows(spark, path, sample):
    df = fs.read_store(spark, path, [sample.schema["s"]])
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_any_sequence_of_loads_is_one_load(spark):
    rng = random.Random(8)
    start = dt.datetime(2020, 9, 1)
    days = sorted(rng.sample(range(260), 70))
    rows = [(s, start + dt.timedelta(days=d, hours=s), rng.randrange(100))
            for d in days for s in (1, 2) if s == 1 or d % 3]
    whole = stats(spark, rows)
    one = shared_dir(spark, "one-load")
    fs.load_features(spark, one, whole, ["s"])
    want = table_rows(spark, one, whole)
    assert len(want) == len(rows)
    rng.shuffle(rows)
    parts = [rows[:40], rows[40:41], rows[41:60] + rows[:3], rows[60:]]
    many = shared_dir(spark, "many-loads")
    for part in parts:
        fs.load_features(spark, many, stats(spark, part), ["s"])
    assert table_rows(spark, many, whole) == want


def test_a_load_writes_the_months_of_its_seam(spark):
    rows = [(1, dt.datetime(2021, m, d), m + d) for m in (1, 2, 4, 5, 8) for d in (1, 9)]
    path = shared_dir(spark, "seam")
    fs.load_features(spark, path, stats(spark, rows), ["s"])
    written = fs.load_features(spark, path, stats(spark, [(1, dt.datetime(2021, 9, 1), 0)]), ["s"])
    assert written == [(2021, 9)]
    # three rows behind the late one stand in the next two months
    written = fs.load_features(spark, path, stats(spark, [(1, dt.datetime(2021, 2, 20), 0)]), ["s"])
    assert sorted(written) == [(2021, 2), (2021, 4), (2021, 5)]


def test_a_file_that_comes_again_replaces_its_row(spark):
    path = shared_dir(spark, "again")
    rows = [(1, dt.datetime(2021, m, 1), m) for m in range(1, 8)]
    first = stats(spark, rows)
    fs.load_features(spark, path, first, ["s"])
    moved = first.filter("mean_rr = 3").withColumns({
        "mean_rr": F.lit(30.0), "timestamp": F.lit("2021-05-20").cast("timestamp_ntz")})
    fs.load_features(spark, path, moved, ["s"])
    got = fs.read_store(spark, path, [first.schema["s"]]).orderBy("timestamp_ms").collect()
    assert [r["mean_rr"] for r in got] == [1, 2, 4, 5, 30, 6, 7]
    assert got[2]["mean_rr_lag1"] == 2 and got[5]["mean_rr_lag1"] == 30
    assert got[2]["delta_minutes"] == 59 * 24 * 60


def test_first_load_writes_nothing_on_the_way(spark, monkeypatch):
    calls, plain = [], fs.materialize
    monkeypatch.setattr(fs, "materialize", lambda df: calls.append(df) or plain(df))
    rows = [(s, dt.datetime(y, m, 3), y + m) for s in (1, None) for y in (2019, 2020)
            for m in (1, 6, 12)]
    path = shared_dir(spark, "first-load")
    whole = stats(spark, rows)
    again = whole.withColumn("timestamp", F.col("timestamp") - F.expr("INTERVAL 1 DAY"))
    written = fs.load_features(spark, path, whole.unionByName(again), ["s"])
    assert not calls and sorted(written) == [(y, m) for y in (2019, 2020) for m in (1, 6, 12)]
    got = table_rows(spark, path, whole)
    assert len(got) == len(rows)
    seam = [r for r in fs.read_store(spark, path, [whole.schema["s"]]).collect()
            if (r["year"], r["month"]) == (2020, 1)]
    assert [(r["delta_minutes"], r["mean_rr_lag1"]) for r in seam] == [(31 * 1440.0, None)] * 2


def test_a_load_without_rows_changes_nothing(spark):
    path = shared_dir(spark, "no-rows")
    whole = stats(spark, [(1, dt.datetime(2020, m, 3), m) for m in (1, 2)])
    fs.load_features(spark, path, whole, ["s"])
    want = table_rows(spark, path, whole)
    assert fs.load_features(spark, path, whole.limit(0), ["s"]) == []
    assert table_rows(spark, path, whole) == want


def test_runs_table(spark):
    root = shared_dir(spark, "runs-table")
    assert runs.read_runs(spark, root).count() == 0
    assert runs.latest_run(runs.read_runs(spark, root)).count() == 0
    for run_id, rmse in (("20240102_000000", 2.0), ("20240101_000000", 3.0),
                         ("20240103_000000", 2.5)):
        runs.append_run(spark.createDataFrame([(run_id, 2020, "a", "b", ["x"], False, 0,
                                                {"m": (rmse, None)})], RUN), root)
    table = runs.read_runs(spark, root)
    assert table.count() == 3
    assert runs.latest_run(table).first()["run_id"] == "20240103_000000"
    got = [(r["run_id"][7], r["rmse_change"], r["best"])
           for r in runs.score_history(table).orderBy("run_id").collect()]
    assert got == [("1", None, True), ("2", -1.0, True), ("3", 0.5, False)]


@pytest.mark.parametrize("tile", [1, 3, 5, 64])
def test_tiles_equal_whole_grids(spark, tile):
    rng = np.random.default_rng(tile)
    rows = []
    for i, (ny, nx) in enumerate([(8, 8), (7, 11), (12, 5), (3, 3), (1, 9)]):
        value = rng.normal(1e6 if i == 1 else 1, 2, ny * nx)
        value[rng.random(ny * nx) < 0.2] = np.nan
        flags = [int(f) if f < 3 else None for f in rng.integers(0, 4, ny * nx)]
        rows.append((str(i), f"x_s2024010100000{i}_.nc", ny, nx, [float(v) for v in value],
                     flags if i % 2 else None))
    rows.append(("empty", "x_s20240101000009_.nc", 4, 4, [-1.0] * 16, None))
    df = spark.createDataFrame(rows, "scene_id string, file string, ny int, nx int, "
                                     "value array<float>, quality array<int>")
    want = {r["scene_id"]: r for r in sc.scene_stats_arrays(df, 6, 1.0).collect()}
    path = tiles.write_tiles(tiles.tiles_from_arrays(df, tile), shared_dir(spark, "tiles"))
    got = {r["scene_id"]: r for r in tiles.scene_stats_tiles(
        tiles.read_tiles(spark, path), 6, 1.0).collect()}
    assert set(got) == set(want)
    for k, r in got.items():
        for c in ("n_pixels", "n_valid", "n_finite", "reject_reason", "timestamp"):
            assert r[c] == want[k][c], (k, c)
        for c in ("mean_rr", "max_rr", "std_rr", "frac_rainy"):
            w = want[k][c]
            assert r[c] == (w if w is None else pytest.approx(w, rel=1e-7)), (k, c)


def test_tiles_outside_the_crop_are_not_read(spark):
    grid = [float(i) for i in range(64)]
    df = spark.createDataFrame([("a", "f", 8, 8, grid, None)], "scene_id string, file string, "
                               "ny int, nx int, value array<float>, quality array<int>")
    path = tiles.write_tiles(tiles.tiles_from_arrays(df, 2), shared_dir(spark, "tiles"))
    cropped = tiles.crop_tiles(tiles.read_tiles(spark, path), 4)
    cropped.collect()
    scan = cropped._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert scan.metrics().get("numPartitions").get().value() == 4       # of 16 folders
    assert sorted(v for r in cropped.collect() for v in r["value"]) == sorted(
        grid[y * 8 + x] for y in range(2, 6) for x in range(2, 6))


def test_fit_per_series_equals_numpy(spark):
    rng = np.random.default_rng(2)
    rows, want = [], {}
    for s in range(4):
        x = rng.normal(100 * s, 1 + s, (40, 3))
        y = x @ rng.normal(0, 2, 3) + 5 + rng.normal(0, 0.1, 40)
        rows += [(s, *map(float, r), float(v)) for r, v in zip(x, y)]
        want[s] = np.linalg.lstsq(np.column_stack([np.ones(40), x]), y, rcond=None)[0]
    # a constant feature, one that follows from another, missing values
    rows += [(9, 1.0, float(i), 2.0 * i, 3.0 * i + 1) for i in range(10)]
    rows += [(9, None, 1.0, 1.0, 50.0), (9, 1.0, float("nan"), 1.0, 50.0), (None, 1.0, 2.0, 3.0, 4.0)]
    df = spark.createDataFrame(rows, "s int, a double, b double, c double, label double")
    fits = series_fit.fit_per_series(df, ["a", "b", "c"], ["s"])
    got = {r["s"]: r for r in fits.collect()}
    for s, w in want.items():
        assert [got[s][c] for c in ("intercept", "coef_a", "coef_b", "coef_c")] == pytest.approx(
            list(w), rel=1e-6)
    nine = got[9]
    assert (nine["n"], nine["coef_a"], nine["coef_c"]) == (10, 0.0, 0.0)
    assert (nine["coef_b"], nine["intercept"]) == (pytest.approx(3), pytest.approx(1))
    assert got[None]["intercept"] == 4.0 and got[None]["coef_a"] == 0.0
    pred = series_fit.predict_per_series(df, fits, ["a", "b", "c"], ["s"])
    assert pred.filter("s < 4").select(F.max(F.abs(F.col("prediction") - F.col("label")))
                                       ).first()[0] < 1


def test_streamed_lags_equal_batch_lags_over_a_restart(spark):
    rng = random.Random(3)
    rows = [(s, f"f{i}", dt.datetime(2020, 12, 30) + dt.timedelta(minutes=17 * i), float(i * s))
            for i in range(300) for s in (1, 2) if s == 1 or rng.random() < 0.02]
    df = spark.createDataFrame(rows, "s int, file string, timestamp timestamp_ntz, mean_rr double"
                               ).withColumn("year", F.year("timestamp"))
    src, sink, state, ck = (shared_dir(spark, n) for n in ("l-src", "l-sink", "l-state", "l-ck"))
    cuts = [dt.datetime(2020, 12, 31, 5), dt.datetime(2021, 1, 1, 0, 1), dt.datetime(2030, 1, 1)]
    low = dt.datetime(2000, 1, 1)
    for k, cut in enumerate(cuts):
        df.filter((F.col("timestamp") >= F.lit(low)) & (F.col("timestamp") < F.lit(cut))
                  ).write.mode("append").parquet(src)
        low = cut
        stateful.lag_stream(spark, src, df.schema, sink, state, ck, ["s"]).awaitTermination()
    cols = ["s", "file", "delta_minutes", "mean_rr_lag1", "mean_rr_lag2", "mean_rr_lag3"]
    got = sorted(map(tuple, spark.read.parquet(sink).select(*cols).collect()), key=str)
    batch, _ = stateful.lag_batch(None, df, ["s"])
    assert got == sorted(map(tuple, batch.select(*cols).collect()), key=str)
    assert len(got) == len(rows)


def test_long_scenes_are_emitted_once_and_late_pixels_counted(spark):
    g = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").filter("vec_id < 40")
    pixels = sc.long_from_arrays(series.grid_scenes(g)).withColumn(
        "timestamp", series.grid_time(F.col("scene_id").cast("long")))
    src, sink, ck = (shared_dir(spark, n) for n in ("p-src", "p-sink", "p-ck"))
    vec = F.col("scene_id").cast("long")
    first = pixels.filter((vec < 20) & ((vec >= 10) | (F.col("x") != 3)))
    rest = pixels.filter((vec >= 20) | ((vec < 10) & (F.col("x") == 3)))
    late = pixels.filter((vec == 1) & (F.col("x") == 4))
    end = pixels.filter("scene_id = '39'").withColumns({
        "scene_id": F.lit("end"), "timestamp": F.lit("2030-01-01").cast("timestamp_ntz")})
    seen = 0
    for part in (first, rest, late, end):
        part.write.mode("append").parquet(src)
        query = stateful.ingest_long_scenes(spark, src, pixels.schema, sink, ck, 4,
                                            delay="300 minutes")
        query.awaitTermination()
        seen += stateful.late_pixels(query)
    assert seen > 0
    got = stateful.finished_scenes(spark.read.parquet(sink)).collect()
    want = {r["scene_id"]: r for r in sc.scene_stats_long(pixels, 4).collect()}
    assert len(got) == 40 and {r["scene_id"] for r in got} == set(want)
    for r in got:
        assert r["n_pixels"] == 16 and r["n_valid"] == want[r["scene_id"]]["n_valid"]
        assert r["std_rr"] == pytest.approx(want[r["scene_id"]]["std_rr"])
