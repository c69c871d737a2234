"""Step 3 of the reference as one Spark job: prepare, split, fit, score, save."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession

from scenecast.operators import dataset as ds
from scenecast.operators import evaluate as ev
from scenecast.operators import models as mdl
from scenecast.schemas import FEATURE_COLS, TARGET
from scenecast.session import materialize
from scenecast.sources import store


@dataclass
class TrainResult:
    run_dir: str
    models: dict[str, PipelineModel]
    scores: DataFrame
    counts: DataFrame


def train_run(spark: SparkSession, features: DataFrame, run_root: str, train_year: int,
              test_start: str, test_end: str, feature_cols: list[str] | None = None,
              specs: dict | None = None, lag_bucket: Column | str | None = "day",
              train_until: str | None = None, run_id: str | None = None,
              series_cols: list[str] | None = None) -> TrainResult:
    """Fit the model set on ``train_year`` and score ``test_start..test_end``.

    Lags are added before the split (test rows keep their history), rows
    with a missing value are dropped, every model is fitted on one cached
    frame, all scores come from one aggregate, and models plus the run
    record are written under ``run_root/run_id``.
    """
    feature_cols = list(feature_cols or FEATURE_COLS)
    specs = specs or mdl.default_specs(feature_cols)
    # read three times below: computed once
    prepared = materialize(ds.prepare(features, TARGET, lag_bucket=lag_bucket,
                                      series_cols=series_cols))
    train, test = ds.time_split(prepared, train_year, test_start, test_end, train_until)
    counts = ds.split_counts(ds.split_frame(prepared, train_year, test_start, test_end,
                                            train_until), [TARGET] + feature_cols)
    train_f = ds.model_frame(train, TARGET, feature_cols)
    keys = [*(series_cols or []), "timestamp"]
    test_f = ds.model_frame(test, TARGET, feature_cols, keys=keys).cache()
    models = mdl.fit_models(train_f, specs)
    scores = materialize(ev.score(mdl.predict(models, test_f, keys)))
    test_f.unpersist()
    run_id = run_id or store.new_run_id()
    run_dir = f"{run_root.rstrip('/')}/{run_id}"
    store.save_models(models, run_dir)
    store.write_run_record(store.run_record(run_id, train_year, test_start, test_end,
                                            feature_cols, scores), run_dir)
    return TrainResult(run_dir, models, scores, counts)
