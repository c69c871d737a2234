"""Feature table and model-frame operators (P13-P23, W1/W2 wiring, A7).

The reference writes a feature table (step 2) and every later step rebuilds
``timestamp``/``date`` from text, adds the cyclic hour and the per-year
lags, splits by time **after** the lags, drops incomplete rows and projects
``label`` + features.  These functions are those steps as DataFrame
transformations.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scenecast.functions.calendar import add_calendar, prepare_times
from scenecast.operators.lags import add_lags, add_time_delta, add_time_delta_spans
from scenecast.schemas import FEATURE_COLS, N_LAGS, TARGET

SCENE_STATS = ["mean_rr", "max_rr", "std_rr", "frac_rainy"]
FEATURE_TABLE_COLS = [
    "file", "mean_rr", "max_rr", "std_rr", "frac_rainy", "year", "month", "day", "hour",
    "timestamp_ms", "timestamp_str", "delta_minutes",
]


def time_bucket(bucket, time_col: str = "timestamp"):
    """Bucket spec for the two-level plans: a time unit (``"day"``,
    ``"month"``...) -> ``date_trunc`` of ``time_col``; a Column, ``"balanced"``
    or None (single window) pass through."""
    if isinstance(bucket, str) and bucket != "balanced":
        return F.date_trunc(bucket, F.col(time_col))
    return bucket


def feature_table(stats: DataFrame, delta_bucket: Column | str | None = "day",
                  keep_timestamp: bool = False, materialize: bool = True,
                  series_cols: list[str] | None = None, times: DataFrame | None = None
                  ) -> DataFrame:
    """Accepted scene statistics -> feature table.

    ``stats`` has ``file, timestamp, mean_rr, max_rr, std_rr, frac_rainy``.
    ``delta_minutes`` is the gap to the previous scene over the whole table
    ordered by (timestamp, file), 0 for the first.  It is computed with the
    two-level plan over ``delta_bucket`` (default: day buckets; ``None`` = one
    unpartitioned window, i.e. one task); the per-scene rows are then
    checkpointed once (``materialize``) so the pixel aggregate upstream is
    not recomputed by the two branches of that plan.  With ``series_cols`` the
    table holds many series: the columns come first and gaps restart per series.
    ``delta_bucket="year"`` then keeps the rows shuffled by series and ``year``, so that lags
    per series and year need no further shuffle, and nothing is checkpointed; ``times`` are then
    the series columns, ``timestamp`` and ``year`` of the same scenes (see
    :func:`add_time_delta_spans`); years before the first of ``stats`` may share one value.
    """
    series_cols = list(series_cols or [])
    if series_cols and isinstance(delta_bucket, str) and delta_bucket == "year":
        narrow = stats.select(*series_cols, "file", "timestamp", *SCENE_STATS,
                              F.year("timestamp").alias("year"))
        if times is not None:
            times = times.select(*series_cols, "timestamp", "year")
        df = add_time_delta_spans(narrow, "timestamp", "delta_minutes", series_cols,
                                  ["timestamp", "file"], "year", times)
        df = add_calendar(df, "timestamp", year="year")
        return df.select(*series_cols, *FEATURE_TABLE_COLS,
                         *(["timestamp"] if keep_timestamp else []))
    delta_bucket = time_bucket(delta_bucket)
    df = add_calendar(stats, "timestamp")
    df = add_time_delta(df, "timestamp", "delta_minutes", partition_by=series_cols,
                        order_by=["timestamp", "file"], bucket=delta_bucket,
                        materialize=materialize and delta_bucket is not None)
    cols = series_cols + FEATURE_TABLE_COLS + (["timestamp"] if keep_timestamp else [])
    return df.select(*cols)


def prepare(features: DataFrame, target: str = TARGET, n_lags: int = N_LAGS,
            partition_by: list[str] | None = None, lag_bucket: Column | str | None = "day",
            order_by: list[str] | None = None,
            series_cols: list[str] | None = None) -> DataFrame:
    """P17 + P18 + W1: timestamp/date from text, cyclic hour, per-year lags
    (per series and year with ``series_cols``).

    The lags use the two-level plan over ``lag_bucket`` (default: day
    buckets of ``timestamp``; ``"balanced"`` for equal-count buckets;
    ``None`` = one window per ``year``, i.e. one task per year).
    """
    df = prepare_times(features, "timestamp_str")
    return add_lags(df, target, n_lags,
                    partition_by=(list(series_cols or []) + ["year"] if partition_by is None
                                  else partition_by),
                    order_by=["timestamp_ms", "file"] if order_by is None else order_by,
                    bucket=time_bucket(lag_bucket))


def parse_day(text: str | dt.date) -> dt.date:
    """Window bounds are parsed in Python so malformed text fails early."""
    if isinstance(text, dt.date):
        return text
    return dt.date.fromisoformat(str(text))


def halo_filter(features: DataFrame, start, end=None) -> DataFrame:
    """Read-side filter that keeps lag history for a window starting at ``start``.

    Lags restart every ``year``, so rows before 1 January of the start's year
    can never be a lag of a window row: dropping them is exact.  The
    predicate is on ``year`` (a partition column at rest) and so prunes
    whole directories at the scan.
    """
    s = parse_day(start)
    cond = F.col("year") >= F.lit(s.year)
    if end is not None:
        cond = cond & (F.col("year") <= F.lit(parse_day(end).year))
    return features.filter(cond)


def in_window(start, end, date_col: str = "date") -> Column:
    """P20: inclusive date window."""
    s, e = parse_day(start), parse_day(end)
    return F.col(date_col).between(F.lit(s), F.lit(e))


def train_condition(train_year: int, train_until=None, date_col: str = "date") -> Column:
    """The training year, optionally cut before ``train_until`` (exclusive)."""
    cond = F.col("year") == F.lit(train_year)
    if train_until is not None:
        cond = cond & (F.col(date_col) < F.lit(parse_day(train_until)))
    return cond


def time_split(df: DataFrame, train_year: int, test_start, test_end, train_until=None
               ) -> tuple[DataFrame, DataFrame]:
    """(train, test) on a prepared frame; rows in neither vanish."""
    return (df.filter(train_condition(train_year, train_until)),
            df.filter(in_window(test_start, test_end)))


def split_frame(df: DataFrame, train_year: int, test_start, test_end,
                train_until=None) -> DataFrame:
    """P21 as one frame with a ``split`` column, one pass over the input.

    A row belonging to both sets (test window inside the train year) appears
    once per set, as with two separate filters.
    """
    train = train_condition(train_year, train_until)
    test = in_window(test_start, test_end)
    tags = F.array(F.when(train, F.lit("train")), F.when(test, F.lit("test")))
    return (df.filter(train | test)
            .withColumn("split", F.explode(F.filter(tags, lambda t: t.isNotNull()))))


def complete(cols: list[str]) -> Column:
    """True when none of the columns is null or NaN."""
    cond = F.lit(True)
    for c in cols:
        x = F.col(c)
        cond = cond & x.isNotNull() & ~F.isnan(x.cast("double"))
    return cond


def drop_incomplete(df: DataFrame, cols: list[str]) -> DataFrame:
    """``dropna(subset=cols)`` that also drops NaN (as MLlib would)."""
    return df.filter(complete(cols))


def split_counts(split_df: DataFrame, needed: list[str] | None = None) -> DataFrame:
    """Rows per split before and after the completeness filter, one pass."""
    needed = [TARGET] + FEATURE_COLS if needed is None else needed
    return (split_df.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows_raw"),
        F.count_if(complete(needed)).alias("rows_complete")))


def model_frame(df: DataFrame, target: str = TARGET, features: list[str] | None = None,
                keys: list[str] | None = None) -> DataFrame:
    """P22 + P23: complete rows only, ``label`` + features (+ keys first)."""
    features = FEATURE_COLS if features is None else features
    keys = keys or []
    return (drop_incomplete(df, [target] + features)
            .select(*keys, F.col(target).alias("label"), *features))


def load_window(features: DataFrame, start, end, target: str = TARGET,
                feature_cols: list[str] | None = None, keys: list[str] | None = None,
                lag_bucket: Column | str | None = "day",
                series_cols: list[str] | None = None) -> DataFrame:
    """M9 input: halo read -> prepare -> exact window -> complete rows -> frame.

    ``keys`` defaults to the series columns and ``timestamp``.
    """
    series_cols = list(series_cols or [])
    pre = prepare(halo_filter(features, start, end), target, lag_bucket=lag_bucket,
                  series_cols=series_cols)
    return model_frame(pre.filter(in_window(start, end)), target, feature_cols,
                       keys if keys is not None else [*series_cols, "timestamp"])


def profile(df: DataFrame) -> DataFrame:
    """Schema + row count: one row per column from a single aggregate."""
    cols = df.columns
    aggs = [F.count(F.lit(1)).alias("__rows")]
    aggs += [F.count(F.col(c)).alias(f"__nn_{i}") for i, c in enumerate(cols)]
    one = df.agg(*aggs)
    types = dict(df.dtypes)
    rows = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"),
                              F.lit(types[c]).alias("type"),
                              F.col(f"__nn_{i}").alias("non_null"))
                     for i, c in enumerate(cols)])
    return (one.select(F.col("__rows").alias("rows"), F.explode(rows).alias("c"))
            .select("c.position", "c.column", "c.type", "rows", "c.non_null"))
