"""Steps 1 and 2 of the reference as Spark jobs.

Step 1 (choose files): listing -> nearest file per hour -> skip held ->
day report.  The object-store copy itself is transport and stays outside
Spark; :func:`choose_files` returns the urls to fetch.

Step 2 (scenes -> features): scene table -> crop/mask/reduce -> accepted
scenes -> calendar fields and time gap -> Parquet partitioned by year.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scenecast.functions.names import url_day
from scenecast.operators import dataset as ds
from scenecast.operators import nearest
from scenecast.operators import scenes as sc
from scenecast.operators.dataset import feature_table
from scenecast.sources import listing as ls
from scenecast.sources import tables


def choose_files(spark: SparkSession, listing: DataFrame, held: DataFrame, start, end
                 ) -> tuple[DataFrame, DataFrame]:
    """Step 1: (urls to fetch, day report) for the days ``start..end``.

    ``listing`` has ``url``; ``held`` has ``name`` (basenames already held,
    e.g. :func:`scenecast.sources.listing.held_names` of the local folder).
    """
    days = ls.day_range(spark, start, end)
    s, e = ds.parse_day(start), ds.parse_day(end)
    in_range = listing.filter(url_day(F.col("url")).between(F.lit(s), F.lit(e)))
    fetch = nearest.skip_existing(nearest.nearest_per_hour(in_range), held)
    return fetch, nearest.day_report(days, in_range, held)


def scenes_to_features(scenes: DataFrame, win: int = sc.DEFAULT_WINDOW,
                       threshold: float = 0.0, shape: str = "array",
                       gap_bucket: str = "day") -> tuple[DataFrame, DataFrame]:
    """Step 2: (feature table, per-scene outcome counts).

    The time gap uses the two-level plan with ``gap_bucket`` buckets and
    checkpoints the per-scene rows once, so the pixel aggregate upstream runs
    a single time.
    """
    if shape == "array":
        stats = sc.scene_stats_arrays(scenes, win, threshold)
    else:
        stats = sc.scene_stats_long(scenes, win, threshold)
    features = feature_table(sc.accepted(stats),
                             delta_bucket=F.date_trunc(gap_bucket, F.col("timestamp")))
    return features, sc.reject_counts(stats)


def ingest(spark: SparkSession, scenes: DataFrame, out_path: str,
           win: int = sc.DEFAULT_WINDOW, threshold: float = 0.0, shape: str = "array"
           ) -> tuple[str, DataFrame]:
    """Step 2 end to end: write the feature table; return (path, build report)."""
    features, _ = scenes_to_features(scenes, win, threshold, shape)
    tables.write_features(features, out_path)
    written = tables.read_features(spark, out_path)
    return out_path, sc.build_report(written)
