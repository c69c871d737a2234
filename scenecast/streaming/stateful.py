"""Stateful streams: lags of arriving rows, and scenes that arrive pixel by pixel.

* **Lags** (X2 + W1 + W2): every micro-batch is joined to the last ``n_lags`` rows of each series,
  kept as a table in the shared folder, one version per batch.  Lags and gaps come from the
  batch operators (bucketed windows, so a series with most rows of a batch is many tasks).  A
  batch that is run again reads the version before it and overwrites its own results, so each
  row is written once, also over restarts.
* **Long scenes** (X1 + A5): pixels of a scene arrive over several files.  A watermarked
  aggregate holds one small state per open scene and emits it once the watermark has passed
  the scene's time; pixels that come later are counted by the query's progress.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from scenecast.operators.lags import add_lags, add_time_delta
from scenecast.operators.scenes import _finish, center_crop_long, clean_long, stats_long
from scenecast.schemas import N_LAGS, TARGET
from scenecast.sources.store import _exists


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def lag_batch(held: DataFrame | None, batch: DataFrame, series_cols: list[str],
              target: str = TARGET, n_lags: int = N_LAGS) -> tuple[DataFrame, DataFrame]:
    """(rows of the batch with gap and lags, the rows to hold for the next one).

    ``held``: the last ``n_lags`` rows of every series before the batch.  Rows have file, timestamp
    and year; a row older than its series' held rows sees those held before it.
    """
    order = ["timestamp", "file"]
    rows = batch.withColumn("__new", F.lit(True))
    if held is not None:
        rows = rows.unionByName(held.withColumn("__new", F.lit(False)))
    day = F.date_trunc("day", F.col("timestamp"))
    out = add_time_delta(rows, "timestamp", "delta_minutes", partition_by=series_cols,
                         order_by=order, bucket=day)
    out = add_lags(out, target, n_lags, partition_by=[*series_cols, "year"], order_by=order,
                   bucket=day)
    last = Window.partitionBy(*series_cols).orderBy(*[F.col(c).desc() for c in order])
    keep = (rows.withColumn("__rank", F.row_number().over(last))
            .filter(F.col("__rank") <= max(1, n_lags)).drop("__rank", "__new"))
    return out.filter("__new").drop("__new"), keep


def lag_stream(spark: SparkSession, source: str, schema: StructType, sink: str, state: str,
               checkpoint: str, series_cols: list[str], target: str = TARGET,
               n_lags: int = N_LAGS, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Rows that arrive as files, with their gap and lags, appended to ``sink``.

    Files are read in the order of their time; within and over micro-batches the lags equal
    those of one batch over all rows, as long as no row is older than its series' held rows.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)

    def one(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        before = f"{state}/version={batch_id - 1}"
        held = session.read.schema(schema).parquet(before) if _exists(session, before) else None
        rows, keep = lag_batch(held, batch.select(*schema.names), series_cols, target, n_lags)
        rows.write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")
        keep.write.mode("overwrite").parquet(f"{state}/version={batch_id}")
        _delete(session, f"{state}/version={batch_id - 2}")

    return (reader.parquet(source).writeStream.foreachBatch(one)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def long_scene_stream(pixels: DataFrame, win: int, threshold: float = 0.0,
                      time_col: str = "timestamp", delay: str = "10 minutes") -> DataFrame:
    """Statistics of scenes whose pixels arrive in any order, emitted once the watermark passes them.

    ``pixels``: long-form pixels with ``ny``, ``nx`` and the scene's time.  The watermark is
    ``delay`` behind the latest time of a pixel inside the crop.
    """
    timed = pixels.withColumn(time_col, F.col(time_col).cast("timestamp"))
    cropped = center_crop_long(timed.withWatermark(time_col, delay), win=win)
    return stats_long(clean_long(cropped), threshold, ("scene_id", "file", time_col))


def ingest_long_scenes(spark: SparkSession, source: str, schema: StructType, sink: str,
                       checkpoint: str, win: int, threshold: float = 0.0,
                       delay: str = "10 minutes", max_files_per_trigger: int | None = None
                       ) -> StreamingQuery:
    """X1 on pixel files: append every finished scene once; ``late_pixels`` counts what came after."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stats = long_scene_stream(reader.parquet(source), win, threshold, delay=delay)
    return (stats.writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", checkpoint).option("path", sink)
            .trigger(availableNow=True).start())


def late_pixels(query: StreamingQuery) -> int:
    """Rows (combined per task and scene) that came behind the watermark."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress
               for op in p["stateOperators"])


def finished_scenes(stats: DataFrame, time_col: str = "timestamp") -> DataFrame:
    """The sink's rows with reject reasons, as the batch operator gives them."""
    timed = stats.withColumn(time_col, F.col(time_col).cast("timestamp_ntz"))
    return _finish(timed, time_col)
