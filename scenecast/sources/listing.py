"""Listings of scene files (S1-S4) and day ranges.

A listing is a DataFrame with one ``url`` per object.  It comes either from
an existing table (an inventory export, a catalogue) or from the file system
through the ``binaryFile`` source with the ``content`` column pruned, so only
file metadata is read.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scenecast.functions.names import basename, day_prefix, minute_of_day, url_day


def read_listing(spark: SparkSession, path: str, glob: str = "*.nc",
                 recursive: bool = True) -> DataFrame:
    """List files under ``path`` as ``url, length, modified``.

    Only ``path``, ``length`` and ``modificationTime`` are selected, so the
    scan never reads file contents.
    """
    return (spark.read.format("binaryFile")
            .option("pathGlobFilter", glob)
            .option("recursiveFileLookup", str(recursive).lower())
            .load(path)
            .select(F.col("path").alias("url"), F.col("length"),
                    F.col("modificationTime").alias("modified")))


def held_names(listing: DataFrame, url_col: str = "url") -> DataFrame:
    """S3: inventory of names already held (basename of each url), distinct."""
    return listing.select(basename(F.col(url_col)).alias("name")).distinct()


def with_listing_fields(listing: DataFrame, url_col: str = "url") -> DataFrame:
    """P4-P6 (+ day): ``day``, ``minute`` (HH*60+mm) and ``name`` per url.

    A ``day`` column already present (the listing of one day prefix) is kept;
    otherwise it is read from the ``yyyy/MM/dd`` part of the url.
    """
    u = F.col(url_col)
    cols = {"minute": minute_of_day(u), "name": basename(u)}
    if "day" not in listing.columns:
        cols["day"] = url_day(u)
    return listing.withColumns(cols)


def day_range(spark: SparkSession, start, end) -> DataFrame:
    """Every day from ``start`` to ``end``, both inclusive."""
    s = start if isinstance(start, dt.date) else dt.date.fromisoformat(str(start))
    e = end if isinstance(end, dt.date) else dt.date.fromisoformat(str(end))
    return spark.range(1).select(F.explode(F.sequence(F.lit(s), F.lit(e),
                                                      F.expr("INTERVAL 1 DAY"))).alias("day"))


def day_prefixes(days: DataFrame, prefix: str) -> DataFrame:
    """``<prefix>/yyyy/MM/dd`` for each day."""
    return days.withColumn("prefix", day_prefix(prefix, F.col("day")))
