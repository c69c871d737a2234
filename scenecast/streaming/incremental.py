"""Incremental ingest and scoring with Structured Streaming.

The reference re-runs its scripts and skips what it already holds.  The
Spark form of that habit is a file-source stream: the checkpoint records
which files were processed, so each run handles only new files, and
``trigger(availableNow=True)`` processes everything new and stops (a batch
job with exactly-once bookkeeping).  Both jobs are stateless row maps:

* X1 - array-shaped scene files -> per-scene statistics (crop, mask and
  reduce are row-local for array scenes, so no state store is involved);
* X2 - feature rows that already carry their lag columns -> predictions of
  a saved pipeline (lag windows are not allowed on streams).
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from scenecast.operators.scenes import DEFAULT_WINDOW, scene_stats_arrays
from scenecast.schemas import SCENE_ARRAY


def scene_stats_stream(spark: SparkSession, source: str, win: int = DEFAULT_WINDOW,
                       threshold: float = 0.0, schema: StructType = SCENE_ARRAY,
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """X1 source side: a stream of per-scene statistics over new scene files."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return scene_stats_arrays(reader.parquet(source), win, threshold)


def ingest_scene_stats(spark: SparkSession, source: str, sink: str, checkpoint: str,
                       win: int = DEFAULT_WINDOW, threshold: float = 0.0,
                       available_now: bool = True) -> StreamingQuery:
    """Append statistics of scene files not seen before to a Parquet table."""
    stream = scene_stats_stream(spark, source, win, threshold)
    writer = (stream.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint).option("path", sink))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()


def score_stream(model: PipelineModel, features: DataFrame) -> DataFrame:
    """Predictions of a saved pipeline on a streaming frame."""
    return model.transform(features)


def score_new_rows(spark: SparkSession, model_path: str, source: str, schema: StructType,
                   sink: str, checkpoint: str, keep: list[str] | None = None
                   ) -> StreamingQuery:
    """Score feature rows arriving as files, append predictions to ``sink``."""
    model = PipelineModel.load(model_path)
    stream = spark.readStream.schema(schema).parquet(source)
    out = score_stream(model, stream)
    cols = (keep or []) + ["label", "prediction"]
    return (out.select(*cols).writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", checkpoint).option("path", sink)
            .trigger(availableNow=True).start())
