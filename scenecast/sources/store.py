"""Model store and run records.

A run is a folder ``<root>/<run_id>/`` holding one saved ``PipelineModel``
per model name and a ``run_info`` JSON table.  Paths live on the shared file
system the cluster uses (see :func:`scenecast.session.shared_dir`).
"""

from __future__ import annotations

import datetime as dt

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scenecast.schemas import METRICS_SUMMARY, RUN
from scenecast.session import side_by_side


def _join(root: str, *parts: str) -> str:
    return "/".join([root.rstrip("/")] + [p.strip("/") for p in parts])


def new_run_id(now: dt.datetime | None = None) -> str:
    """Run ids sort by time: ``yyyyMMdd_HHmmss``."""
    return (now or dt.datetime.now()).strftime("%Y%m%d_%H%M%S")


def save_models(models: dict[str, PipelineModel], run_dir: str) -> list[str]:
    """Save each fitted pipeline, overwriting; the pipelines are written side by side."""
    paths = {name: _join(run_dir, name) for name in models}
    side_by_side(SparkSession.active(), {
        name: lambda m=m, p=paths[name]: m.write().overwrite().save(p)
        for name, m in models.items()})
    return list(paths.values())


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hpath)


def load_models(spark: SparkSession, run_dir: str, names: list[str],
                missing: str = "skip") -> dict[str, PipelineModel]:
    """Load saved pipelines; ``missing='skip'`` (report) or ``'error'`` (test)."""
    paths = {n: _join(run_dir, n) for n in names}
    if missing == "skip":
        paths = {n: p for n, p in paths.items() if _exists(spark, p)}
    return side_by_side(spark, {n: lambda p=p: PipelineModel.load(p) for n, p in paths.items()})


def run_record(run_id: str, train_year: int, test_start: str,
               test_end: str, feature_cols: list[str], scores: DataFrame) -> DataFrame:
    """The run record as a one-row DataFrame; results come from ``scores``."""
    results = scores.agg(F.map_from_entries(F.collect_list(F.struct(
        F.col("model"), F.struct(F.col("rmse").alias("rmse"), F.col("r2").alias("r2"))
    ))).alias("results"))
    return results.select(
        F.lit(run_id).alias("run_id"), F.lit(train_year).cast("int").alias("train_year"),
        F.lit(test_start).alias("test_start"), F.lit(test_end).alias("test_end"),
        F.array(*[F.lit(c) for c in feature_cols]).alias("feature_cols"),
        F.lit(False).alias("use_gpu_for_xgb"), F.lit(0).alias("gpu_id"),
        "results").select(*[f.name for f in RUN.fields])


def write_run_record(record: DataFrame, run_dir: str) -> str:
    """Write as JSON under the run folder."""
    p = _join(run_dir, "run_info")
    record.coalesce(1).write.mode("overwrite").json(p)
    return p


def read_run_record(spark: SparkSession, run_dir: str) -> DataFrame | None:
    """The run record, or None when absent."""
    p = _join(run_dir, "run_info")
    if not _exists(spark, p):
        return None
    return spark.read.schema(RUN).json(p)


def latest_run(spark: SparkSession, root: str) -> str | None:
    """Newest run folder under ``root`` by name (run ids sort by time)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(root)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return None
    names = [s.getPath().getName() for s in fs.listStatus(hpath) if s.isDirectory()]
    return _join(root, sorted(names)[-1]) if names else None


def metrics_summary(spark: SparkSession, scores: DataFrame, run_dir: str, start: str,
                    end: str) -> DataFrame:
    """One-row summary (rmse and r2 maps per model) built from ``scores``."""
    agg = scores.agg(
        F.map_from_entries(F.collect_list(F.struct("model", "rmse"))).alias("rmse"),
        F.map_from_entries(F.collect_list(F.struct("model", "r2"))).alias("r2"))
    return agg.select(
        F.lit(run_dir).alias("run_dir"),
        F.struct(F.lit(start).alias("start"), F.lit(end).alias("end")).alias("date_range"),
        "rmse", "r2",
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("generated_at"),
    ).select(*[f.name for f in METRICS_SUMMARY.fields])


def write_json(df: DataFrame, path: str) -> str:
    df.coalesce(1).write.mode("overwrite").json(path)
    return path
