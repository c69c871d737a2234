"""The ``runs`` table: every run record as a row, appended (S10 + S11 + T6).

A run appends one row; a commit makes it visible whole or not at all.  Which run is the
latest, and how scores changed, are queries over the rows and need no listing of folders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scenecast.schemas import RUN
from scenecast.sources.store import _exists, _join

TABLE = "runs"


def append_run(record: DataFrame, root: str) -> str:
    """Append a run record (see ``store.run_record``) to the table under ``root``."""
    path = _join(root, TABLE)
    record.select(*RUN.names).coalesce(1).write.mode("append").parquet(path)
    return path


def read_runs(spark: SparkSession, root: str) -> DataFrame:
    """All run records; no rows before the first append."""
    path = _join(root, TABLE)
    if not _exists(spark, path):
        return spark.createDataFrame([], RUN)
    return spark.read.schema(RUN).parquet(path)


def latest_run(runs: DataFrame) -> DataFrame:
    """The record of the newest run (run ids sort by time)."""
    return runs.orderBy(F.col("run_id").desc()).limit(1)


def score_history(runs: DataFrame) -> DataFrame:
    """(model, run_id, rmse, r2, rmse_change, best): scores of every run, oldest first per model.

    ``rmse_change`` is against the model's run before; ``best`` marks its smallest error so far.
    """
    flat = runs.select("run_id", F.explode("results").alias("model", "s")).select(
        "model", "run_id", "s.rmse", "s.r2")
    w = Window.partitionBy("model").orderBy("run_id")
    least = F.min("rmse").over(w.rowsBetween(Window.unboundedPreceding, -1))
    return flat.withColumns({"rmse_change": F.col("rmse") - F.lag("rmse").over(w),
                             "best": F.coalesce(F.col("rmse") < least, F.lit(True))})
