"""Feature-table and scene-table sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scenecast.schemas import FEATURES, SCENE_ARRAY, SCENE_LONG


def write_features(features: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Parquet partitioned by ``year`` so year filters prune directories.

    Rows are range-partitioned on (year, time, file) before the write: each
    task writes a contiguous time range (few files, sorted by time), and a
    year holding most rows is split over several tasks instead of one.
    """
    (features.repartitionByRange("year", "timestamp_ms", "file")
     .sortWithinPartitions("year", "timestamp_ms", "file")
     .write.mode(mode).partitionBy("year").parquet(path))
    return path


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """The feature table with its declared schema (no inference)."""
    return spark.read.schema(FEATURES).parquet(path).select(*[f.name for f in FEATURES.fields])


def read_scenes(spark: SparkSession, path: str, shape: str = "array") -> DataFrame:
    """Scene table in array or long shape, with the declared schema."""
    schema = SCENE_ARRAY if shape == "array" else SCENE_LONG
    return spark.read.schema(schema).parquet(path)


def write_predictions(pred: DataFrame, path: str) -> str:
    """Predictions as CSV with header, one folder per model.

    Range partitioning on (model, time) keeps a large model's rows spread
    over several writer tasks, each writing one time range.
    """
    (pred.repartitionByRange("model", "timestamp").sortWithinPartitions("model", "timestamp")
     .write.mode("overwrite").partitionBy("model").option("header", True).csv(path))
    return path


def normalize_scene_arrays(df: DataFrame) -> DataFrame:
    """Coerce an array-shaped scene table to the declared types."""
    return df.select(
        F.col("scene_id").cast("string").alias("scene_id"),
        F.col("file").cast("string").alias("file"),
        F.col("ny").cast("int").alias("ny"), F.col("nx").cast("int").alias("nx"),
        F.col("value").cast("array<float>").alias("value"),
        F.col("quality").cast("array<int>").alias("quality"),
    )
