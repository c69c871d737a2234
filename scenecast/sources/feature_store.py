"""A feature table that grows by loads (S6 + W1 + W2).

At rest the table holds the feature columns, the gap to the scene before and the lags, in
folders by year and month.  A load adds the scenes of new files (a file that is there
already is replaced) and repairs the seam: the gap of the first row after each new
one, and the lags of the ``n_lags`` rows after it.  Only the months that hold such rows are
written again (dynamic partition overwrite); a load behind the end of the table writes
its own months and no others.  To know the rows before a month that is written,
the months that hold them are read; everything else is pruned at the scan.  A first load
replaces nothing and is written straight away.

Which months these are follows from one row per series and month (a count); the list of
months is all that comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from scenecast.functions.calendar import add_calendar
from scenecast.operators.dataset import SCENE_STATS
from scenecast.operators.lags import add_lags, add_time_delta, add_time_delta_spans
from scenecast.schemas import FEATURES, N_LAGS, TARGET
from scenecast.session import materialize

MONTH = ["year", "month"]


def lag_names(target: str = TARGET, n_lags: int = N_LAGS) -> list[str]:
    return [f"{target}_lag{k}" for k in range(1, n_lags + 1)]


def _schema(series: list[StructField], target: str, n_lags: int) -> StructType:
    return StructType([*series, *FEATURES.fields,
                       *[StructField(c, DoubleType()) for c in lag_names(target, n_lags)]])


def _folder(spark: SparkSession, path: str, act):
    """``act`` on the folder's file system and the folder."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return act(folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder)


def read_store(spark: SparkSession, path: str, series: list[StructField] | None = None,
               target: str = TARGET, n_lags: int = N_LAGS) -> DataFrame | None:
    """The table, or None before the first load.  ``series``: fields of the series columns."""
    if not _folder(spark, path, lambda fs, folder: fs.exists(folder)):
        return None
    schema = _schema(list(series or []), target, n_lags)
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def _months(counts: DataFrame, series_cols: list[str], n_lags: int) -> tuple[list, list]:
    """Months to write and months to read only, from (series, year, month, old, new) counts.

    A month is written if a series has new rows in it, or fewer than ``n_lags`` (at least one) rows
    between an earlier month with new rows and it.  The same rule backwards gives the
    months that hold the rows before a written one.
    """
    reach = max(1, n_lags)
    order = F.col("year") * 12 + F.col("month")
    w = Window.partitionBy(*series_cols).orderBy(order)
    back = Window.partitionBy(*series_cols).orderBy(order.desc())
    rows = F.col("old") + F.col("new")

    def near(flag: Column, window) -> tuple[Column, Column]:
        # rows up to this month, and up to the nearest flagged month before it
        total = F.sum(rows).over(window.rowsBetween(Window.unboundedPreceding, 0))
        upto = F.max(F.when(flag, F.col("__total"))).over(
            window.rowsBetween(Window.unboundedPreceding, -1))
        return total, upto

    total, upto = near(F.col("new") > 0, w)
    marked = (counts.withColumn("__total", total).withColumn("__upto", upto)
              .withColumn("write", (F.col("new") > 0) | F.coalesce(
                  F.col("__total") - rows - F.col("__upto") < reach, F.lit(False))))
    # a month is written for all series or for none
    marked = marked.withColumn("write", F.max("write").over(Window.partitionBy(*MONTH)))
    total, upto = near(F.col("write"), back)
    marked = (marked.withColumn("__total", total).withColumn("__upto", upto)
              .withColumn("read", F.coalesce(
                  F.col("__total") - rows - F.col("__upto") < reach, F.lit(False))))
    months = (marked.groupBy(*MONTH).agg(F.max("write").alias("write"), F.max("read").alias("read"))
              .filter("write OR read").collect())
    return ([(r["year"], r["month"]) for r in months if r["write"]],
            [(r["year"], r["month"]) for r in months if not r["write"]])


def _in(months: list[tuple[int, int]]) -> Column:
    """Condition on the partition columns: one of the months."""
    by_year: dict[int, list[int]] = {}
    for y, m in months:
        by_year.setdefault(y, []).append(m)
    cond = F.lit(False)
    for y, ms in sorted(by_year.items()):
        cond = cond | ((F.col("year") == y) & F.col("month").isin(sorted(ms)))
    return cond


def load_features(spark: SparkSession, path: str, stats: DataFrame,
                  series_cols: list[str] | None = None, target: str = TARGET,
                  n_lags: int = N_LAGS) -> list[tuple[int, int]]:
    """Add scene statistics to the table at ``path``; returns the (year, month)s written.

    ``stats``: the series columns, file, timestamp and the four statistics of accepted scenes; of
    rows that share series and file the last in time counts.  The result of any sequence of
    loads is the table of one load of all scenes.
    """
    series_cols = list(series_cols or [])
    fields = [f for f in stats.schema.fields if f.name in series_cols]
    key = [*series_cols, "file"]
    base = [*key, "timestamp", *SCENE_STATS]      # the calendar columns follow from the time
    month = [F.year("timestamp").alias("year"), F.month("timestamp").alias("month")]
    newest = Window.partitionBy(*key).orderBy(F.col("timestamp").desc(), *[
        F.col(c).desc() for c in SCENE_STATS])
    new = (stats.withColumn("__n", F.row_number().over(newest)).filter("__n = 1").select(*base))
    old = read_store(spark, path, fields, target, n_lags)
    if old is None:
        months, rows = None, new
    else:
        new = materialize(new)
        # a file that comes again leaves its old place, whose month has to be written too; the
        # scan skips what lies outside the new names
        low, high = new.agg(F.min("file"), F.max("file")).first()
        moved = old.filter(F.col("file").between(low, high)).select(*key, *MONTH).join(
            new.select(*key), [*key], "left_semi")
        touched = new.select(*series_cols, *month).unionByName(moved.select(*series_cols, *MONTH))
        counts = (old.select(*series_cols, *MONTH, F.lit(1).alias("old"), F.lit(0).alias("new"))
                  .unionByName(touched.select("*", F.lit(0).alias("old"), F.lit(1).alias("new")))
                  .groupBy(*series_cols, *MONTH).agg(F.sum("old").alias("old"),
                                                     F.sum("new").alias("new")))
        months, halo = _months(counts, series_cols, n_lags)
        kept = old.filter(_in(months + halo)).join(new.select(*key), [*key], "left_anti")
        time = F.to_timestamp_ntz("timestamp_str", F.lit("yyyy-MM-dd HH:mm:ss"))
        rows = kept.withColumn("timestamp", time).select(*base).unionByName(new)
    order = ["timestamp", "file"]
    rows = rows.withColumn("year", F.year("timestamp"))
    if series_cols:
        # one shuffle, by series and year, serves gaps and lags
        bucket = None
        out = add_time_delta_spans(rows, "timestamp", "delta_minutes", series_cols, order, "year")
    else:
        bucket = F.date_trunc("month", F.col("timestamp"))
        out = add_time_delta(rows, "timestamp", "delta_minutes", order_by=order, bucket=bucket)
    out = add_lags(out, target, n_lags, partition_by=[*series_cols, "year"], order_by=order,
                   bucket=bucket).withColumn("month", F.month("timestamp"))
    # the rows are read from the folders they are written to: fixed before the first is replaced
    fixed = out if months is None else materialize(out.filter(_in(months)))
    # by month, where large ones are many tasks
    (add_calendar(fixed.hint("rebalance", *MONTH), "timestamp")
     .select(*_schema(fields, target, n_lags).names)
     .sortWithinPartitions(*MONTH, *series_cols, "timestamp_ms", "file")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*MONTH).parquet(path))
    done = fixed if months is not None else read_store(spark, path, fields, target, n_lags)
    written = [tuple(r) for r in done.select(*MONTH).distinct().collect()]
    for y, m in set(months or []) - set(written):       # all its files moved elsewhere
        _folder(spark, f"{path}/year={y}/month={m}", lambda fs, folder: fs.delete(folder, True))
    return written
