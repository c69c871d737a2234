"""Fitting, persistence, end-to-end jobs, streaming."""

import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_MID, SF_SMALL
from scenecast.operators import dataset as ds
from scenecast.operators import evaluate as ev
from scenecast.operators import models as mdl
from scenecast.plans import backtest as bt
from scenecast.plans import catalog, ingest, series
from scenecast.plans import train as tr
from scenecast.session import shared_dir
from scenecast.sources import store, tables
from scenecast.streaming import incremental

FEATS = catalog._H9


@pytest.fixture(scope="module")
def h_features_path(spark):
    path = shared_dir(spark, "h-features")
    tables.write_features(series.hourly_features(catalog.table(spark, SF_MID, "events")), path)
    return path


def test_one_feature_lr_equals_regr(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.regression import LinearRegression
    train, _ = catalog.h_frames(spark, SF_MID)
    m = Pipeline(stages=[mdl.assembler(["mean_rr_lag1"]),
                         LinearRegression(featuresCol="features", labelCol="label")]).fit(train)
    r = train.agg(F.regr_slope("label", "mean_rr_lag1").alias("b"),
                  F.regr_intercept("label", "mean_rr_lag1").alias("a")).first()
    lr = m.stages[-1]
    assert lr.coefficients[0] == pytest.approx(r["b"], rel=1e-9)
    assert lr.intercept == pytest.approx(r["a"], rel=1e-9)


def test_train_save_reload_backtest(spark, h_features_path):
    features = tables.read_features(spark, h_features_path)
    specs = mdl.default_specs(FEATS, boosted_rounds=3, forest_trees=5)
    root = shared_dir(spark, "runs")
    res = tr.train_run(spark, features, root, 2024, "2024-01-24", "2024-01-31",
                       FEATS, specs, train_until="2024-01-24", run_id="20240101_000000")
    scores = {r["model"]: r for r in res.scores.collect()}
    assert set(scores) == set(mdl.MODEL_NAMES)
    assert all(r["n"] > 0 and r["rmse"] > 0 for r in scores.values())
    counts = {r["split"]: r for r in res.counts.collect()}
    assert counts["train"]["rows_complete"] == counts["train"]["rows_raw"] - 3

    # run record round trip and latest run
    rec = store.read_run_record(spark, res.run_dir).first()
    assert rec["train_year"] == 2024 and rec["feature_cols"] == FEATS
    assert set(rec["results"]) == set(mdl.MODEL_NAMES)
    assert store.latest_run(spark, root) == res.run_dir

    # reloaded models score exactly like the in-memory ones
    rep = bt.backtest(spark, features, res.run_dir, "2024-01-24", "2024-01-31",
                      feature_cols=FEATS)
    again = {r["model"]: r for r in rep["scores"].collect()}
    for m in mdl.MODEL_NAMES:
        assert again[m]["rmse"] == pytest.approx(scores[m]["rmse"], rel=1e-12)
        assert again[m]["n"] == scores[m]["n"]
    assert rep["target_histogram"].agg(F.sum("count")).first()[0] == scores["decision_tree"]["n"]
    assert rep["top_errors"].groupBy("model").count().agg(F.max("count")).first()[0] <= 20
    assert rep["importances"].select("model").distinct().count() == 3
    assert rep["coefficients"].count() == len(FEATS) + 1
    assert len(rep["overlay"].columns) == 2 + len(mdl.MODEL_NAMES)

    out = bt.write_report(spark, rep, shared_dir(spark, "report"), res.run_dir,
                          "2024-01-24", "2024-01-31")
    summ = spark.read.json(f"{out}/metrics_summary").first()
    assert summ["date_range"]["start"] == "2024-01-24"
    preds = spark.read.option("header", True).csv(f"{out}/predictions")
    assert preds.select("model").distinct().count() == len(mdl.MODEL_NAMES)

    # missing models are skipped by the report and fail the strict re-scoring
    assert set(store.load_models(spark, res.run_dir, ["decision_tree", "nope"])) == {"decision_tree"}
    with pytest.raises(Exception):
        store.load_models(spark, res.run_dir, ["nope"], missing="error")


def test_ingest_grid_scenes(spark):
    scenes = series.grid_scenes(catalog.table(spark, SF_SMALL, "embeddings"))
    path, report = ingest.ingest(spark, scenes, shared_dir(spark, "g-features"), win=4)
    r = report.first()
    feats = tables.read_features(spark, path)
    assert r["rows"] == feats.count() > 0
    assert os.path.isdir(os.path.join(path.removeprefix("file:"), f"year={r['years'][0]}"))
    # long shape gives the same table
    f2, _ = ingest.scenes_to_features(
        series.grid_scenes(catalog.table(spark, SF_SMALL, "embeddings")).transform(
            lambda d: __import__("scenecast.operators.scenes", fromlist=["x"]).long_from_arrays(d)),
        win=4, shape="long")
    a = sorted((x["file"], round(x["mean_rr"], 9), x["delta_minutes"]) for x in feats.collect())
    b = sorted((x["file"], round(x["mean_rr"], 9), x["delta_minutes"]) for x in f2.collect())
    assert a == b


def test_choose_files(spark):
    lst = series.events_listing(catalog.table(spark, SF_SMALL, "events"))
    held = spark.createDataFrame([("nothing.nc",)], "name string")
    fetch, rep = ingest.choose_files(spark, lst, held, "2024-01-02", "2024-01-03")
    days = {r["day"].isoformat() for r in fetch.collect()}
    assert days <= {"2024-01-02", "2024-01-03"}
    got = {r["day"].isoformat(): r["chosen"] for r in rep.collect()}
    assert sum(got.values()) == fetch.count()


def test_streaming_ingest_and_score(spark, h_features_path):
    src = shared_dir(spark, "scene-src")
    scenes = series.grid_scenes(catalog.table(spark, SF_SMALL, "embeddings"))
    scenes.filter("cast(scene_id as int) < 100").write.parquet(f"{src}/batch1")
    sink, ck = shared_dir(spark, "scene-sink"), shared_dir(spark, "scene-ck")
    q = incremental.ingest_scene_stats(spark, f"{src}/*", sink, ck, win=4)
    q.awaitTermination()
    first = spark.read.parquet(sink).count()
    assert first == 100
    # a second run only processes the new file
    scenes.filter("cast(scene_id as int) >= 100").write.parquet(f"{src}/batch2")
    q = incremental.ingest_scene_stats(spark, f"{src}/*", sink, ck, win=4)
    q.awaitTermination()
    assert spark.read.parquet(sink).count() == scenes.count()

    # A saved pipeline scores rows arriving as files
    features = tables.read_features(spark, h_features_path)
    train, test = ds.time_split(ds.prepare(features), 2024, "2024-01-24", "2024-01-31",
                                train_until="2024-01-24")
    m = mdl.fit_models(ds.model_frame(train, features=FEATS),
                       {"linear_regression": lambda: mdl.linear_pipeline(FEATS)})
    mpath = shared_dir(spark, "lr")
    m["linear_regression"].write().overwrite().save(mpath)
    frame = ds.model_frame(test, features=FEATS, keys=["timestamp"])
    fsrc = shared_dir(spark, "feat-src")
    frame.write.parquet(fsrc)
    psink, pck = shared_dir(spark, "pred-sink"), shared_dir(spark, "pred-ck")
    incremental.score_new_rows(spark, mpath, fsrc, frame.schema, psink, pck,
                               keep=["timestamp"]).awaitTermination()
    streamed = spark.read.parquet(psink)
    batch = mdl.predict(m, frame, ["timestamp"])
    assert streamed.count() == frame.count()
    joined = streamed.join(batch, "timestamp").select(
        F.max(F.abs(streamed["prediction"] - batch["prediction"]))).first()[0]
    assert joined < 1e-9


def test_predict_leaves_a_row_out_only_where_an_input_is_missing(spark):
    rows = [(float(i), float(i % 5), 3.0 * i) for i in range(20)]
    frame = spark.createDataFrame(rows, "a double, b double, label double")
    fitted = {n: mdl.linear_pipeline([n]).fit(frame) for n in ("a", "b")}
    new = spark.createDataFrame([(1, 2.0, None, 6.0), (2, None, 1.0, 3.0), (3, 4.0, float("nan"), 12.0),
                                 (4, 1.0, 1.0, 3.0)], "id int, a double, b double, label double")
    pred = mdl.predict(fitted, new, ["id"])
    assert pred.columns == ["model", "id", "label", "prediction"]
    got = {(r["model"], r["id"]): r["prediction"] for r in pred.collect()}
    assert set(got) == {("a", 1), ("a", 3), ("a", 4), ("b", 2), ("b", 4)}
    assert got["a", 1] == pytest.approx(6.0) and got["a", 3] == pytest.approx(12.0)
    assert mdl.predict({}, new, ["id"]).collect() == []


def test_series_do_not_share_lags_or_gaps(spark):
    import datetime as dt
    times = [dt.datetime(2024, 1, 1, h) for h in range(4)]
    rows = [(k, f"f{i}", t, float(10 * (k or 7) + i), 1.0, 1.0, 0.5)
            for k in (1, 2, None) for i, t in enumerate(times)]
    stats = spark.createDataFrame(rows, "k int, file string, timestamp timestamp_ntz, mean_rr double,"
                                  " max_rr double, std_rr double, frac_rainy double")
    table = ds.feature_table(stats, series_cols=["k"])
    out = ds.prepare(table, series_cols=["k"]).collect()
    assert len(out) == 12
    for r in out:
        i = int(r["file"][1:])
        assert r["delta_minutes"] == (60.0 if i else 0.0)
        assert r["mean_rr_lag1"] == (r["mean_rr"] - 1 if i else None)


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_models_do_not_depend_on_being_fitted_side_by_side(spark, h_features_path):
    features = tables.read_features(spark, h_features_path)
    train, test = ds.time_split(ds.prepare(features), 2024, "2024-01-24", "2024-01-31",
                                train_until="2024-01-24")
    train = ds.model_frame(train, features=FEATS)
    test = ds.model_frame(test, features=FEATS, keys=["timestamp"])
    specs = mdl.default_specs(FEATS, boosted_rounds=2, forest_trees=5)
    alone, beside = (
        {tuple(r) for r in mdl.predict(mdl.fit_models(train, specs, partitions=2, threads=t),
                                       test, ["timestamp"])
         .select("model", "timestamp", F.round("prediction", 9)).collect()} for t in (1, 4))
    assert alone == beside and len(alone) == 4 * test.count()
