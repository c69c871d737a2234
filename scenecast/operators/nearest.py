"""Choosing files and the daily download report.

J1 picks, for each day and each whole hour, the file whose minute of day is
nearest to ``60*h`` (ties: the earlier minute, then the smaller url).  It
reads the listing once, in two exact steps:

1. ``groupBy(day, minute)`` gives the number of files and the smallest url of each
   minute, summed on every task before the shuffle: a day with a third of all
   files leaves each task at most one row per minute;
2. over the minutes of a day (at most 6,040 rows, whatever the number of files) a window
   takes the smallest packed long ``distance * 2^14 + minute`` of every hour, and the
   minutes that hold one are the picks.

No file x hour product is ever materialised.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scenecast.sources.listing import with_listing_fields

HOURS = 24
_SHIFT = 1 << 14          # minute of day ("HHmm" without range check) is < 6040


def per_hour_picks(listing: DataFrame, url_col: str = "url", hours: int = HOURS
                   ) -> DataFrame:
    """Chosen files: ``day, available, minute, url, hours`` (the target hours each was
    chosen for).  ``available`` counts every listed file of the day; a day with no
    parseable url is one row with a null minute and url and no hours.
    """
    f = with_listing_fields(listing, url_col).select(
        F.col(url_col).alias("url"), "day", "minute")
    m = F.col("minute")
    slots = (f.filter(F.col("day").isNotNull()).groupBy("day", "minute")
             .agg(F.count(F.lit(1)).alias("files"),
                  F.min(F.when(m.isNotNull(), F.col("url"))).alias("url")))
    day = Window.partitionBy("day")
    keys = [F.abs(m - F.lit(60 * h)) * F.lit(_SHIFT) + m for h in range(hours)]
    won = [F.when(k == F.min(k).over(day), F.lit(h)) for h, k in enumerate(keys)]
    picked = slots.select("day", "minute", "url", F.sum("files").over(day).alias("available"),
                          F.max("minute").over(day).isNull().alias("__none"),
                          F.array_compact(F.array(*won)).alias("hours"))
    return picked.filter((F.size("hours") > 0) | F.col("__none")).drop("__none")


def nearest_per_hour(listing: DataFrame, url_col: str = "url", hours: int = HOURS
                     ) -> DataFrame:
    """J1 + U1: distinct chosen files per day: ``day, url, name, minute, hours``.

    ``hours`` lists the target hours each file was chosen for.  Urls without
    a ``/HHmm/`` segment are dropped; a day with one file picks it for every
    hour; hour 0 never looks at the previous day.
    """
    picks = per_hour_picks(listing, url_col, hours).filter(F.col("url").isNotNull())
    return picks.select("day", "url", "minute", "hours",
                        F.element_at(F.split("url", "/"), -1).alias("name"))


def skip_existing(chosen: DataFrame, held: DataFrame, name_col: str = "name"
                  ) -> DataFrame:
    """Chosen files whose basename is not held yet (left anti join).

    A plain anti join: adaptive execution broadcasts ``held`` when its
    measured size is small and shuffles both sides by name otherwise.
    """
    return chosen.join(held.select(F.col(name_col).alias(name_col)).distinct(),
                       name_col, "left_anti")


def day_report(days: DataFrame, listing: DataFrame, held: DataFrame,
               url_col: str = "url") -> DataFrame:
    """J3 + W3: one row per day of ``days`` (empty days included).

    ``available`` files, ``chosen`` files, ``new_requested`` (chosen, not
    held and not chosen on an earlier day - each copy is requested once),
    ``local_now`` = files held before + distinct new names so far (all
    copies assumed to succeed), ``delta`` = growth that day.

    One chain over the per-hour picks (at most 24 rows a day, plus one row
    with a null url for a day whose urls do not parse): held names are
    flagged with a left join, each name's first day comes from a window
    over the chosen rows, and one ``groupBy(day)`` counts everything.
    """
    chosen = per_hour_picks(listing, url_col).select(
        "day", "url", "available", F.element_at(F.split("url", "/"), -1).alias("name"))
    held_names = held.select(F.col("name").alias("name")).distinct().withColumn(
        "is_held", F.lit(True))
    flagged = chosen.join(held_names, "name", "left")
    fresh = F.col("url").isNotNull() & F.col("is_held").isNull()
    w_name = Window.partitionBy("name")
    first = F.min(F.when(fresh, F.col("day"))).over(w_name)
    marked = flagged.withColumn("first_day", first)
    is_new = fresh & (F.col("day") == F.col("first_day"))
    per_day = marked.groupBy("day").agg(
        F.max("available").alias("available"),
        F.count("url").alias("chosen"),
        F.count_if(is_new).alias("new_requested"),
        F.count_distinct(F.when(is_new, F.col("name"))).alias("new_names"))
    full = (days.select("day").join(per_day, "day", "left")
            .select("day", *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
                             for c in ["available", "chosen", "new_requested", "new_names"]]))
    # Running total over the per-day table (one row per day of the range)
    w = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    n_held = held.select("name").distinct().agg(F.count(F.lit(1))).scalar()
    return full.select(
        "day", "available", "chosen", "new_requested",
        (n_held + F.sum("new_names").over(w)).cast("long").alias("local_now"),
        F.col("new_names").alias("delta"))
