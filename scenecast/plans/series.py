"""Adapters from the driver's tables to the library's data model.

The reference's inputs (object-store listings, NetCDF rasters) are not
shipped; these views stand in for them and are derived row by row from the
given tables, so every job's work grows with the tables:

* **H** - ``events`` as an hourly series: a scene is one hour, its pixels are
  the ``value`` of the events in it;
* **D** - ``lineitem`` as a daily series: a scene is one ship day, its pixels
  are ``l_extendedprice``;
* **S** - ``lineitem`` as one daily series per ``l_suppkey``;
* **O** - ``orders`` as a daily series **with gaps** (days without orders):
  a scene is one order day, its pixels are ``o_totalprice``;
* **L** - ``events`` as a file listing: one url per event, in the
  ``<prefix>/yyyy/MM/dd/HHmm/<name>.nc`` layout;
* **G** - ``embeddings`` as 8x8 scenes (64 floats, negatives included) with
  a quality grid derived from ``vec_id``;
* a variable catalogue per G scene, derived from ``vec_id``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scenecast.functions.calendar import add_calendar
from scenecast.functions.metrics import frac_above
from scenecast.operators.dataset import feature_table
from scenecast.operators.lags import ROWS_PER_BUCKET
from scenecast.operators.scenes import clean_value

# Fixed values of the stand-in views.
LISTING_PREFIX = "gs://bucket/scenes"
H_THRESHOLD = 50.0        # "rainy" pixel threshold for the hourly series
D_THRESHOLD = 50000.0     # "rainy" pixel threshold for the daily series
O_THRESHOLD = 250000.0    # "rainy" pixel threshold for the gapped daily series
G_SIZE = 8                # embeddings are 64 = 8 x 8 cells
G_EPOCH = "2024-01-01 00:00:00"
G_STEP_MINUTES = 10


def scene_name(prefix: str, ts: Column) -> Column:
    """``<prefix>_s<yyyyMMddHHmmss>.nc``: a style-1 name for a scene time."""
    return F.concat(F.lit(prefix + "_s"), F.date_format(ts, "yyyyMMddHHmmss"), F.lit(".nc"))


def scene_pixels(pixels: DataFrame, time_col: str, value_col: str, unit: str,
                 series_cols: list[str]) -> DataFrame:
    """Pixels with their scene (series columns, ``timestamp``) and clean value ``v``."""
    t = F.date_trunc(unit, F.col(time_col)).cast("timestamp_ntz")
    v = clean_value(F.col(value_col).cast("double"))
    return pixels.select(*series_cols, t.alias("timestamp"), v.alias("v"))


def series_stats(pixels: DataFrame, time_col: str, value_col: str, unit: str,
                 prefix: str, threshold: float,
                 series_cols: list[str] | None = None, sparse: bool = False) -> DataFrame:
    """A1-A5 for a series whose scenes are time buckets (no grid, no crop).

    One ``groupBy(bucket)`` on a timestamp key (hash aggregate, partial
    aggregation before the shuffle).  Output: file, timestamp, n_valid,
    mean_rr, max_rr, std_rr, frac_rainy (+ series columns).

    ``sparse``: there are nearly as many scenes as pixels.  Partial aggregates would then hold a
    group for every row of a split, several times its size, and spill; so the narrow pixels are
    shuffled as they are, by series and scene, into tasks of a bounded number of rows on average.
    """
    series_cols = series_cols or []
    px = scene_pixels(pixels, time_col, value_col, unit, series_cols)
    if sparse:
        tasks = max(pixels.sparkSession.sparkContext.defaultParallelism,
                    -(-pixels.count() // ROWS_PER_BUCKET))
        px = px.repartition(tasks, *series_cols, "timestamp")
    stats = (px.groupBy(*series_cols, "timestamp")
             .agg(F.count("v").alias("n_valid"),
                  F.avg("v").alias("mean_rr"), F.max("v").alias("max_rr"),
                  F.stddev_pop("v").alias("std_rr"),
                  frac_above(F.col("v"), threshold).alias("frac_rainy")))
    return stats.withColumn("file", scene_name(prefix, F.col("timestamp")))


def hourly_stats(events: DataFrame, threshold: float = H_THRESHOLD) -> DataFrame:
    """H: per-hour scene statistics of ``events.value``."""
    return series_stats(events, "ts", "value", "hour", "H", threshold)


def daily_stats(lineitem: DataFrame, threshold: float = D_THRESHOLD) -> DataFrame:
    """D: per-day scene statistics of ``lineitem.l_extendedprice``."""
    return series_stats(lineitem, "l_shipdate", "l_extendedprice", "day", "D", threshold)


def supplier_stats(lineitem: DataFrame, threshold: float = D_THRESHOLD) -> DataFrame:
    """S: scene statistics per supplier and day; most such days hold a single line."""
    return series_stats(lineitem, "l_shipdate", "l_extendedprice", "day", "D", threshold,
                        ["l_suppkey"], sparse=True)


def supplier_features(lineitem: DataFrame, threshold: float = D_THRESHOLD,
                      keep_timestamp: bool = False, pixel_times: bool = False,
                      from_year: int | None = None) -> DataFrame:
    """S: one daily series per supplier; scenes and features grow with the table.

    Gaps are taken per supplier and year: a supplier with a third of all rows has at most
    366 scenes in one.  ``pixel_times``: the last time of each supplier and year comes straight
    from the valid pixels, not from a second aggregate of all scenes.
    ``from_year``: only the scenes of that year and later, with the gaps they have among all.  Their
    last times come from the pixels too, one for all years before, so that the scans' partial
    maxima, which hold a supplier in every split, do not also hold each of those years.
    """
    ok = supplier_stats(lineitem, threshold).filter(F.col("n_valid") > 0)
    times = None
    if pixel_times or from_year is not None:
        year = F.year("timestamp")
        if from_year is not None:
            ok = ok.filter(year >= from_year)
            year = F.greatest(year, F.lit(from_year - 1))
        times = (scene_pixels(lineitem, "l_shipdate", "l_extendedprice", "day", ["l_suppkey"])
                 .filter(F.col("v").isNotNull()).withColumn("year", year))
    return feature_table(ok, delta_bucket="year", keep_timestamp=keep_timestamp,
                         series_cols=["l_suppkey"], times=times)


def gap_stats(orders: DataFrame, threshold: float = O_THRESHOLD) -> DataFrame:
    """O: per-day scene statistics of ``orders.o_totalprice`` (days missing)."""
    return series_stats(orders, "o_orderdate", "o_totalprice", "day", "O", threshold)


def gap_features(orders: DataFrame, threshold: float = O_THRESHOLD,
                 keep_timestamp: bool = False) -> DataFrame:
    """O as a feature table; gaps (in minutes) show the missing days."""
    ok = gap_stats(orders, threshold).filter(F.col("n_valid") > 0)
    return feature_table(ok, delta_bucket=F.date_trunc("month", F.col("timestamp")),
                         keep_timestamp=keep_timestamp)


def series_table(stats: DataFrame) -> DataFrame:
    """Accepted scenes with calendar fields (before the time gap)."""
    ok = stats.filter(F.col("n_valid") > 0)
    return add_calendar(ok, "timestamp")


def hourly_features(events: DataFrame, threshold: float = H_THRESHOLD,
                    keep_timestamp: bool = False) -> DataFrame:
    """H as a feature table (step 2 output).

    The global time gap uses the two-level plan with day buckets.
    """
    ok = hourly_stats(events, threshold).filter(F.col("n_valid") > 0)
    return feature_table(ok, delta_bucket=F.date_trunc("day", F.col("timestamp")),
                         keep_timestamp=keep_timestamp)


def daily_features(lineitem: DataFrame, threshold: float = D_THRESHOLD,
                   keep_timestamp: bool = False) -> DataFrame:
    """D as a feature table; gaps bucketed by month."""
    ok = daily_stats(lineitem, threshold).filter(F.col("n_valid") > 0)
    return feature_table(ok, delta_bucket=F.date_trunc("month", F.col("timestamp")),
                         keep_timestamp=keep_timestamp)


def events_listing(events: DataFrame, prefix: str = LISTING_PREFIX) -> DataFrame:
    """L: one url per event, ``<prefix>/yyyy/MM/dd/HHmm/X_s<yyyyMMddHHmmss>0_<id>.nc``."""
    ts = F.col("ts")
    url = F.concat(F.lit(prefix.rstrip("/") + "/"), F.date_format(ts, "yyyy/MM/dd/HHmm"),
                   F.lit("/X_s"), F.date_format(ts, "yyyyMMddHHmmss"), F.lit("0_"),
                   F.col("event_id").cast("string"), F.lit(".nc"))
    return events.select(url.alias("url"), F.col("event_id"))


def grid_time(vec_id: Column) -> Column:
    """G: scene time = epoch + vec_id * 10 minutes."""
    return F.timestamp_add("MINUTE", vec_id * G_STEP_MINUTES,
                           F.lit(G_EPOCH).cast("timestamp_ntz"))


def grid_quality(vec_id: Column) -> Column:
    """G: flag grid ``pmod(vec_id + i, 5)`` (0 = good); null flag where
    ``pmod(3*vec_id + i, 11) = 0``; no grid at all when ``pmod(vec_id, 7) = 0``."""
    cells = F.transform(F.sequence(F.lit(0), F.lit(G_SIZE * G_SIZE - 1)),
                        lambda i: F.when(F.pmod(vec_id * 3 + i, F.lit(11)) != 0,
                                         F.pmod(vec_id + i, F.lit(5))).cast("int"))
    return F.when(F.pmod(vec_id, F.lit(7)) != 0, cells)


def grid_scenes(embeddings: DataFrame, variables: bool = False) -> DataFrame:
    """G: array-shaped scenes with a style-2 file name ``G_yyyyDDD_HHmm_<id>.nc``,
    with the file's ``variables`` where asked for."""
    v = F.col("vec_id")
    t = grid_time(v)
    name = F.concat(F.lit("G_"), F.date_format(t, "yyyyDDD"), F.lit("_"),
                    F.date_format(t, "HHmm"), F.lit("_"), v.cast("string"), F.lit(".nc"))
    return embeddings.select(
        v.cast("string").alias("scene_id"), name.alias("file"),
        F.lit(G_SIZE).alias("ny"), F.lit(G_SIZE).alias("nx"),
        F.col("embedding").cast("array<float>").alias("value"),
        grid_quality(v).alias("quality"), *([scene_variables(v).alias("variables")]
                                            if variables else []))


def scene_variables(vec_id: Column) -> Column:
    """Variables of a G scene's file; the kind of scene is ``pmod(vec_id, 6)``.

    0: RRQPE 2-D float; 1: RRQPE 1-D (chosen, later not 2-D); 2: int grid and
    float grid (float chosen); 3: LATITUDE 2-D and a 1-D float (none);
    4: Longitude 2-D and a float64 grid (grid chosen); 5: only DQF (none).
    Every scene also lists ``latitude`` and ``DQF``.
    """
    k = F.pmod(vec_id, F.lit(6))

    def var(cond, name, ndims, dtype, ordinal):
        return F.when(cond, F.struct(F.lit(name).alias("var"), F.lit(ndims).alias("ndims"),
                                     F.lit(dtype).alias("dtype"), F.lit(ordinal).alias("ordinal")))

    entries = F.array(
        var(F.lit(True), "latitude", 2, "float32", 0),
        var(F.lit(True), "DQF", 2, "int8", 1),
        var(k == 0, "RRQPE", 2, "float32", 2),
        var(k == 1, "RRQPE", 1, "float32", 2),
        var(k == 2, "b", 2, "int16", 2),
        var(k == 2, "c", 2, "float32", 3),
        var(k == 3, "LATITUDE", 2, "float32", 2),
        var(k == 3, "d", 1, "float64", 3),
        var(k == 4, "Longitude", 2, "float64", 2),
        var(k == 4, "e", 2, "float64", 3),
    )
    return F.filter(entries, lambda e: e.isNotNull())


def variable_catalog(embeddings: DataFrame) -> DataFrame:
    """Variable catalogue, one row per scene and variable (see :func:`scene_variables`)."""
    v = F.col("vec_id")
    return (embeddings.select(v.cast("string").alias("scene_id"),
                              F.explode(scene_variables(v)).alias("e"))
            .select("scene_id", "e.var", F.col("e.ndims").cast("int").alias("ndims"),
                    "e.dtype", F.col("e.ordinal").cast("int").alias("ordinal")))
