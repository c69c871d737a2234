"""Step 4 of the reference as Spark jobs: reload saved models, score another
window and build every report table.

The reference pulls each model's predictions to pandas and draws pictures;
here the predictions stay a distributed long table and each picture's data
is an aggregate over it (the pictures themselves are not drawn).
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession

from scenecast.operators import dataset as ds
from scenecast.operators import evaluate as ev
from scenecast.operators import models as mdl
from scenecast.operators import reports as rp
from scenecast.schemas import FEATURE_COLS
from scenecast.sources import store, tables


def backtest(spark: SparkSession, features: DataFrame, run_dir: str, start: str, end: str,
             names: list[str] | None = None, missing: str = "skip",
             feature_cols: list[str] | None = None, lag_bucket: Column | str | None = "day"
             ) -> dict[str, DataFrame]:
    """M9 + reports: all tables of the report for one window.

    ``missing='skip'`` ignores absent models (report behaviour); ``'error'``
    fails on them (re-scoring behaviour).
    """
    feature_cols = list(feature_cols or FEATURE_COLS)
    names = names or mdl.MODEL_NAMES
    models = store.load_models(spark, run_dir, names, missing)
    window = ds.load_window(features, start, end, feature_cols=feature_cols,
                            keys=["timestamp"], lag_bucket=lag_bucket
                            ).persist(StorageLevel.MEMORY_AND_DISK)
    pred = mdl.predict(models, window, ["timestamp"]).persist(StorageLevel.MEMORY_AND_DISK)
    scores = ev.score(pred)
    present = list(models)
    out = {
        "window": window,
        "predictions": pred,
        "scores": scores,
        "comparison": ev.compare_models(scores),
        "scores_by_day": ev.scores_by_day(pred),
        "residual_histogram": rp.histogram(rp.with_errors(pred), "error", rp.RESIDUAL_BINS,
                                           ["model"]),
        "target_histogram": rp.histogram(window, "label", rp.TARGET_BINS),
        "correlation": rp.correlation(window, feature_cols),
        "value_range": rp.value_range(pred, group_cols=["model"]),
        "top_errors": rp.top_errors(pred, rp.TOP_ERRORS, ["model"]),
        "series": rp.prediction_series(pred),
        "overlay": rp.overlay(pred, present) if present else None,
        "importances": mdl.importances(models, feature_cols, spark),
    }
    if "linear_regression" in models:
        out["coefficients"] = mdl.coefficients(models["linear_regression"], feature_cols,
                                               spark=spark)
    return out


def write_report(spark: SparkSession, report: dict[str, DataFrame], out_dir: str,
                 run_dir: str, start: str, end: str) -> str:
    """S12 + S13: predictions CSV per model, metrics summary JSON, tables as Parquet."""
    base = out_dir.rstrip("/")
    tables.write_predictions(report["predictions"], f"{base}/predictions")
    store.write_json(store.metrics_summary(spark, report["scores"], run_dir, start, end),
                     f"{base}/metrics_summary")
    for name, df in report.items():
        if df is not None and name not in ("window", "predictions"):
            df.write.mode("overwrite").parquet(f"{base}/{name}")
    return base
