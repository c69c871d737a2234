"""Declared schemas of every table the library reads or writes."""

from pyspark.sql.types import (
    ArrayType, BooleanType, DateType, DoubleType, FloatType, IntegerType,
    LongType, MapType, StringType, StructField, StructType, TimestampNTZType,
    TimestampType,
)

# File listing: one url per object, ``<prefix>/yyyy/MM/dd/HHmm/<name>.nc``.
LISTING = StructType([
    StructField("url", StringType(), False),
])

# Scene, long form: one row per pixel.  ``has_quality`` separates
# "flag grid present, flag null" (masked) from "no flag grid" (kept).
SCENE_LONG = StructType([
    StructField("scene_id", StringType(), False),
    StructField("file", StringType(), True),
    StructField("y", IntegerType(), False),
    StructField("x", IntegerType(), False),
    StructField("value", FloatType(), True),
    StructField("quality", IntegerType(), True),
    StructField("has_quality", BooleanType(), False),
])

# Scene, array form: one row per scene, grids row-major; quality null = no grid.
SCENE_ARRAY = StructType([
    StructField("scene_id", StringType(), False),
    StructField("file", StringType(), True),
    StructField("ny", IntegerType(), False),
    StructField("nx", IntegerType(), False),
    StructField("value", ArrayType(FloatType(), True), True),
    StructField("quality", ArrayType(IntegerType(), True), True),
])

# Variable catalogue of the scene files.
VAR_CATALOG = StructType([
    StructField("scene_id", StringType(), False),
    StructField("var", StringType(), False),
    StructField("ndims", IntegerType(), False),
    StructField("dtype", StringType(), False),
    StructField("ordinal", IntegerType(), False),
])

# Per-scene statistics, before calendar fields.
SCENE_STATS = StructType([
    StructField("file", StringType(), True),
    StructField("timestamp", TimestampNTZType(), True),
    StructField("mean_rr", DoubleType(), True),
    StructField("max_rr", DoubleType(), True),
    StructField("std_rr", DoubleType(), True),
    StructField("frac_rainy", DoubleType(), True),
])

# Feature table at rest (the time column itself is rebuilt from text).
FEATURES = StructType([
    StructField("file", StringType(), True),
    StructField("mean_rr", DoubleType(), True),
    StructField("max_rr", DoubleType(), True),
    StructField("std_rr", DoubleType(), True),
    StructField("frac_rainy", DoubleType(), True),
    StructField("year", IntegerType(), True),
    StructField("month", IntegerType(), True),
    StructField("day", IntegerType(), True),
    StructField("hour", IntegerType(), True),
    StructField("timestamp_ms", LongType(), True),
    StructField("timestamp_str", StringType(), True),
    StructField("delta_minutes", FloatType(), True),
])

# Default model inputs (fixed values of the published setup).
TARGET = "mean_rr"
FEATURE_COLS = [
    "max_rr", "std_rr", "frac_rainy",
    "delta_minutes",
    "hour_sin", "hour_cos",
    "mean_rr_lag1", "mean_rr_lag2", "mean_rr_lag3",
]
N_LAGS = 3

PREDICTIONS = StructType([
    StructField("model", StringType(), False),
    StructField("timestamp", TimestampType(), True),
    StructField("label", DoubleType(), True),
    StructField("prediction", DoubleType(), True),
])

RUN = StructType([
    StructField("run_id", StringType(), False),
    StructField("train_year", IntegerType(), True),
    StructField("test_start", StringType(), True),
    StructField("test_end", StringType(), True),
    StructField("feature_cols", ArrayType(StringType()), True),
    StructField("use_gpu_for_xgb", BooleanType(), True),
    StructField("gpu_id", IntegerType(), True),
    StructField("results", MapType(StringType(), StructType([
        StructField("rmse", DoubleType(), True),
        StructField("r2", DoubleType(), True),
    ])), True),
])

METRICS_SUMMARY = StructType([
    StructField("run_dir", StringType(), True),
    StructField("date_range", StructType([
        StructField("start", StringType(), True),
        StructField("end", StringType(), True),
    ]), True),
    StructField("rmse", MapType(StringType(), DoubleType()), True),
    StructField("r2", MapType(StringType(), DoubleType()), True),
    StructField("generated_at", StringType(), True),
])

DAY_REPORT = StructType([
    StructField("day", DateType(), False),
    StructField("available", LongType(), False),
    StructField("chosen", LongType(), False),
    StructField("new_requested", LongType(), False),
    StructField("local_now", LongType(), False),
    StructField("delta", LongType(), False),
])
