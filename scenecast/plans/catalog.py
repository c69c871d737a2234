"""Query catalogue: every operator of the inventory as a named query.

``QUERIES[name](spark, sf_dir) -> DataFrame`` runs the library on the
driver's tables; ``ORACLE[name]`` is the same result in plain SQL (DuckDB
dialect) for the correctness check.  Doubles are rounded to 6 places and
integers widened to bigint on both sides so results compare exactly.
Queries without an SQL form (model fits, saved-model round trips) have no
``ORACLE`` entry and are checked by row count only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DoubleType, IntegerType, ShortType

from scenecast.functions import calendar as cal
from scenecast.functions import names as nm
from scenecast.operators import dataset as ds
from scenecast.operators import evaluate as ev
from scenecast.operators import lags
from scenecast.operators import models as mdl
from scenecast.operators import nearest
from scenecast.operators import reports as rp
from scenecast.operators import scenes as sc
from scenecast.plans import series
from scenecast.schemas import FEATURE_COLS, TARGET
from scenecast.session import materialize, shared_dir
from scenecast.sources import listing as ls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# Fixed values of the catalogue's windows.
H_TRAIN_YEAR, H_TRAIN_UNTIL = 2024, "2024-01-24"      # H: train before 24 Jan 2024
H_TEST = ("2024-01-24", "2024-01-31")                 # H: test 24-31 Jan 2024
D_TRAIN_YEAR = 2000                                   # D: train year 2000
D_TEST = ("2001-06-20", "2001-06-27")                 # D: test 20-27 June 2001
G_WINDOW = 4                                          # G: 8x8 grids cropped to 4x4
LISTING_RANGE = ("2023-12-30", "2024-02-02")          # L: report range, wider than data


def decimal_round(sql: str) -> str:
    """Rewrite every ``round(x, n)`` of the oracle SQL as a decimal rounding.

    ``round(x, n)`` becomes ``CAST(round(CAST(x AS DECIMAL(38,8)), n) AS
    DOUBLE)`` (NaN and infinities pass through), the same as
    :func:`round_decimal` on the Spark side.
    """
    out, i, key = [], 0, "round("
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        if j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_"):
            out.append(sql[i:j + len(key)])
            i = j + len(key)
            continue
        depth, k, comma = 0, j + len(key) - 1, None
        while True:
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                depth -= 1
                if depth == 0:
                    break
            elif ch == "," and depth == 1:
                comma = k
            k += 1
        x = decimal_round(sql[j + len(key):comma])
        n = sql[comma + 1:k].strip()
        out.append(sql[i:j])
        out.append(f"(CASE WHEN isnan({x}) OR isinf({x}) THEN ({x}) ELSE "
                   f"CAST(ROUND(CAST({x} AS DECIMAL(38,8)), {n}) AS DOUBLE) END)")
        i = k + 1


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = decimal_round(sql)
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def round_decimal(c, places: int = 6):
    """Round a double through DECIMAL(38,8), as the oracle SQL does.

    Spark's ``round`` works on the decimal text of a double, DuckDB's on its
    binary value, so an exact tie such as 264984.1259375 rounds up in one and
    down in the other; a mean whose exact value is such a tie also carries
    summation noise of a few ulps.  Rounding to 8 places first snaps every
    value within 5e-9 of a 6-place tie onto the tie in both engines, then
    HALF_UP decides the same way (and no -0.0 appears).
    """
    special = F.isnan(c) | (F.abs(c) == F.lit(float("inf")))
    return F.when(special, c).otherwise(
        F.round(c.cast("decimal(38,8)"), places).cast("double"))


def finish(df: DataFrame, places: int = 6) -> DataFrame:
    """Round doubles and widen small integers so both engines compare exactly."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, DoubleType):
            c = round_decimal(c, places)
        elif isinstance(f.dataType, (IntegerType, ShortType, ByteType)):
            c = c.cast("bigint")
        out.append(c.alias(f.name))
    return df.select(*out)


def r(expr: str, alias: str | None = None) -> str:
    return f"round({expr}, 6) AS {alias or expr}"


# ----------------------------------------------------------------- shared SQL

def _series_sql(src: str, time_col: str, value_col: str, unit: str, prefix: str,
                threshold: float, key: str = "") -> str:
    k = f"{key}, " if key else ""
    v = f"CASE WHEN NOT isnan({value_col}) AND {value_col} >= 0 THEN {value_col} END"
    return f"""
    SELECT {k}date_trunc('{unit}', {time_col}) AS t,
           count({v}) AS n_valid, avg({v}) AS mean_rr, max({v}) AS max_rr,
           stddev_pop({v}) AS std_rr,
           avg(CASE WHEN {v} > {threshold} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS frac_rainy
    FROM {src} GROUP BY ALL"""


def _features_sql(series_sql: str, prefix: str, key: str = "") -> str:
    """Feature table (with ``timestamp``) from a series CTE body; ``key`` names the series."""
    k, per = (f"{key}, ", f"PARTITION BY {key} ") if key else ("", "")
    return f"""
    s AS ({series_sql}),
    s2 AS (
      SELECT {k}'{prefix}_s' || strftime(t, '%Y%m%d%H%M%S') || '.nc' AS file, t AS timestamp,
             mean_rr, max_rr, std_rr, frac_rainy FROM s WHERE n_valid > 0),
    f AS (
      SELECT {k}file, timestamp, mean_rr, max_rr, std_rr, frac_rainy,
             year(timestamp) AS year, month(timestamp) AS month, day(timestamp) AS day,
             hour(timestamp) AS hour, epoch_ms(timestamp) AS timestamp_ms,
             strftime(timestamp, '%Y-%m-%d %H:%M:%S') AS timestamp_str,
             CAST(coalesce((epoch_ms(timestamp) - epoch_ms(lag(timestamp) OVER (
                   {per}ORDER BY timestamp, file))) / 60000.0, 0) AS FLOAT) AS delta_minutes
      FROM s2)"""


def _prepared_sql(features_cte: str, key: str = "") -> str:
    k = f"{key}, " if key else ""
    return f"""
    {features_cte},
    p AS (
      SELECT *, CAST(timestamp AS DATE) AS date,
             sin(2 * pi() * CAST(hour AS DOUBLE) / 24.0) AS hour_sin,
             cos(2 * pi() * CAST(hour AS DOUBLE) / 24.0) AS hour_cos,
             lag(mean_rr, 1) OVER w AS mean_rr_lag1,
             lag(mean_rr, 2) OVER w AS mean_rr_lag2,
             lag(mean_rr, 3) OVER w AS mean_rr_lag3
      FROM f WINDOW w AS (PARTITION BY {k}year ORDER BY timestamp_ms, file))"""


H_SERIES_SQL = _series_sql("events", "ts", "value", "hour", "H", series.H_THRESHOLD)
D_SERIES_SQL = _series_sql("lineitem", "l_shipdate", "l_extendedprice", "day", "D",
                           series.D_THRESHOLD)
H_FEATURES_CTE = _features_sql(H_SERIES_SQL, "H")
D_FEATURES_CTE = _features_sql(D_SERIES_SQL, "D")
H_PREPARED_CTE = _prepared_sql(H_FEATURES_CTE)
D_PREPARED_CTE = _prepared_sql(D_FEATURES_CTE)
S_PREPARED_CTE = _prepared_sql(_features_sql(_series_sql(
    "lineitem", "l_shipdate", "l_extendedprice", "day", "D", series.D_THRESHOLD, "l_suppkey"),
    "D", "l_suppkey"), "l_suppkey")

FEATURE_OUT_SQL = ", ".join([
    "file", r("mean_rr"), r("max_rr"), r("std_rr"), r("frac_rainy"), "year", "month", "day",
    "hour", "timestamp_ms", "timestamp_str", "delta_minutes"])

# ----------------------------------------------------------------- shared Spark

def h_features(spark, sf_dir, keep_timestamp=False) -> DataFrame:
    return series.hourly_features(table(spark, sf_dir, "events"), keep_timestamp=keep_timestamp)


def d_features(spark, sf_dir, keep_timestamp=False) -> DataFrame:
    return series.daily_features(table(spark, sf_dir, "lineitem"),
                                 keep_timestamp=keep_timestamp)


def h_prepared(spark, sf_dir, shared: bool = True) -> DataFrame:
    """H prepared: two-level per-year lags with day buckets.

    ``shared``: checkpoint it once (one row per scene) because the reports
    read it from several branches; a query that reads it once skips that.
    """
    p = ds.prepare(h_features(spark, sf_dir), lag_bucket="day")
    return materialize(p) if shared else p


def d_prepared(spark, sf_dir, shared: bool = True) -> DataFrame:
    """D prepared: two-level per-year lags with month buckets (see h_prepared)."""
    p = ds.prepare(d_features(spark, sf_dir), lag_bucket="month")
    return materialize(p) if shared else p


def s_prepared(spark, sf_dir, pixel_times: bool = False, from_year: int | None = None
               ) -> DataFrame:
    """S prepared: lags per supplier and year, in windows of at most 366 scenes.

    The rows are those of the table: what several branches read is written after the split.
    """
    return ds.prepare(series.supplier_features(table(spark, sf_dir, "lineitem"),
                                               pixel_times=pixel_times, from_year=from_year),
                      lag_bucket=None, series_cols=["l_suppkey"])


# ================================================================ A5, P13-P15

@query("series_hourly", f"""
    WITH {H_FEATURES_CTE.strip()}
    SELECT {FEATURE_OUT_SQL.replace(', delta_minutes', '')} FROM f""")
def q_series_hourly(spark, sf_dir):
    st = series.series_table(series.hourly_stats(table(spark, sf_dir, "events")))
    return finish(st.select(*[c for c in ds.FEATURE_TABLE_COLS if c != "delta_minutes"]))


@query("series_daily", f"""
    WITH {D_FEATURES_CTE.strip()}
    SELECT {FEATURE_OUT_SQL.replace(', delta_minutes', '')} FROM f""")
def q_series_daily(spark, sf_dir):
    st = series.series_table(series.daily_stats(table(spark, sf_dir, "lineitem")))
    return finish(st.select(*[c for c in ds.FEATURE_TABLE_COLS if c != "delta_minutes"]))


# ================================================================ W1, W2, P16-P18, P25

_FT_SQL = f"""
    WITH {H_PREPARED_CTE.strip()}
    SELECT {FEATURE_OUT_SQL}, CAST(hour AS DOUBLE) AS hour_d, {r('hour_sin')}, {r('hour_cos')},
           date, {r('mean_rr_lag1')}, {r('mean_rr_lag2')}, {r('mean_rr_lag3')},
           strftime(timestamp, '%m-%d %H:%M') AS time_label
    FROM p"""


@query("feature_table", _FT_SQL)
def q_feature_table(spark, sf_dir):
    p = h_prepared(spark, sf_dir, shared=False)
    out = p.select(*[c for c in ds.FEATURE_TABLE_COLS if c != "hour"],
                   F.col("hour").cast("bigint").alias("hour"),
                   F.col("hour").alias("hour_d"), "hour_sin", "hour_cos", "date",
                   "mean_rr_lag1", "mean_rr_lag2", "mean_rr_lag3",
                   cal.short_label(F.col("timestamp")).alias("time_label"))
    return finish(out)


@query("feature_table_daily", f"""
    WITH {D_PREPARED_CTE.strip()}
    SELECT {FEATURE_OUT_SQL}, {r('hour_sin')}, {r('hour_cos')}, date,
           {r('mean_rr_lag1')}, {r('mean_rr_lag2')}, {r('mean_rr_lag3')}
    FROM p""")
def q_feature_table_daily(spark, sf_dir):
    p = d_prepared(spark, sf_dir, shared=False)
    out = p.select(*[c for c in ds.FEATURE_TABLE_COLS if c != "hour"],
                   F.col("hour").cast("bigint").alias("hour"), "hour_sin", "hour_cos", "date",
                   "mean_rr_lag1", "mean_rr_lag2", "mean_rr_lag3")
    return finish(out)


@query("feature_table_by_series", f"""
    WITH {S_PREPARED_CTE.strip()}
    SELECT l_suppkey, {FEATURE_OUT_SQL}, {r('hour_sin')}, {r('hour_cos')}, date,
           {r('mean_rr_lag1')}, {r('mean_rr_lag2')}, {r('mean_rr_lag3')}
    FROM p""")
def q_feature_table_by_series(spark, sf_dir):
    """P13-P18, W1, W2 on many series at once: one daily series per supplier."""
    p = s_prepared(spark, sf_dir)
    out = p.select("l_suppkey", *[c for c in ds.FEATURE_TABLE_COLS if c != "hour"],
                   F.col("hour").cast("bigint").alias("hour"), "hour_sin", "hour_cos", "date",
                   "mean_rr_lag1", "mean_rr_lag2", "mean_rr_lag3")
    return finish(out)


O_SERIES_SQL = _series_sql("orders", "o_orderdate", "o_totalprice", "day", "O",
                           series.O_THRESHOLD)
O_PREPARED_CTE = _prepared_sql(_features_sql(O_SERIES_SQL, "O"))


@query("feature_table_gaps", f"""
    WITH {O_PREPARED_CTE.strip()}
    SELECT {FEATURE_OUT_SQL}, date, {r('mean_rr_lag1')}, {r('mean_rr_lag2')},
           {r('mean_rr_lag3')}
    FROM p""")
def q_feature_table_gaps(spark, sf_dir):
    """W1 + W2 on a daily series with missing days: gaps are whole multiples
    of 1440 minutes and lags count rows, not days (a gap does not null a lag)."""
    p = ds.prepare(series.gap_features(table(spark, sf_dir, "orders")), lag_bucket="month")
    out = p.select(*[c for c in ds.FEATURE_TABLE_COLS if c != "hour"],
                   F.col("hour").cast("bigint").alias("hour"), "date",
                   "mean_rr_lag1", "mean_rr_lag2", "mean_rr_lag3")
    return finish(out)


@query("lag_two_level", """
    SELECT event_id, event_type, ts,
           round(lag(value, 1) OVER w, 6) AS value_lag1,
           round(lag(value, 2) OVER w, 6) AS value_lag2,
           round(lag(value, 3) OVER w, 6) AS value_lag3,
           CAST(coalesce((epoch_us(ts) - epoch_us(lag(ts) OVER g)) / 60000000.0, 0) AS FLOAT)
             AS delta_minutes
    FROM events
    WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id),
           g AS (ORDER BY ts, event_id)""")
def q_lag_two_level(spark, sf_dir):
    """W1 and W2 in the two-level plan on raw events: lags of ``value`` per
    event type (hour buckets) and the global gap between events (hour
    buckets), against plain SQL windows."""
    e = table(spark, sf_dir, "events").select("event_id", "event_type", "ts", "value")
    hour = F.date_trunc("hour", F.col("ts"))
    out = lags.add_lags(e, "value", 3, partition_by=["event_type"],
                        order_by=["ts", "event_id"], bucket=hour)
    out = lags.add_time_delta(out, "ts", "delta_minutes", partition_by=[],
                              order_by=["ts", "event_id"], bucket=hour)
    return finish(out.select("event_id", "event_type", "ts", "value_lag1", "value_lag2",
                             "value_lag3", "delta_minutes"))


BALANCED_ROWS = 1000     # rows per balanced bucket for the raw-event lag query


@query("lag_balanced", ORACLE["lag_two_level"])
def q_lag_balanced(spark, sf_dir):
    """W1 and W2 in the two-level plan with balanced buckets: equal-count ranges
    of (time, id), so a hot period, or instant, is split over tasks."""
    e = table(spark, sf_dir, "events").select("event_id", "event_type", "ts", "value")
    # both steps share the bucket column
    staged = lags.balanced_buckets(e, ["ts", "event_id"], BALANCED_ROWS)
    bucket, coarser = F.col("__tbucket"), lags.balanced_groups(staged)
    out = lags.add_lags(staged, "value", 3, partition_by=["event_type"],
                        order_by=["ts", "event_id"], bucket=bucket, coarser=coarser)
    out = lags.add_time_delta(out, "ts", "delta_minutes", partition_by=[],
                              order_by=["ts", "event_id"], bucket=bucket, coarser=coarser)
    return finish(out.select("event_id", "event_type", "ts", "value_lag1", "value_lag2",
                             "value_lag3", "delta_minutes"))


# ================================================================ P1-P3

def _style_s_names(events: DataFrame) -> DataFrame:
    """Style-1 names from events; month is ``pmod(event_id, 14)`` so 00 and 13
    occur, and every 5th name also carries a valid style-2 part (which must
    not be used when style 1 matches)."""
    eid = F.col("event_id")
    digits = F.concat(F.date_format("ts", "yyyy"), F.lpad(F.pmod(eid, F.lit(14)).cast("string"), 2, "0"),
                      F.date_format("ts", "ddHHmmss"))
    extra = F.when(F.pmod(eid, F.lit(5)) == 0, F.lit("_2021001_1200")).otherwise(F.lit(""))
    return events.select(eid, F.concat(F.lit("E"), extra, F.lit("_s"), digits, F.lit("7_"),
                                       eid.cast("string"), F.lit(".nc")).alias("name"))


_S_NAMES_SQL = """
    names AS (
      SELECT event_id,
             'E' || CASE WHEN event_id % 5 = 0 THEN '_2021001_1200' ELSE '' END || '_s'
               || strftime(ts, '%Y') || lpad(CAST(event_id % 14 AS VARCHAR), 2, '0')
               || strftime(ts, '%d%H%M%S') || '7_' || CAST(event_id AS VARCHAR) || '.nc' AS name
      FROM events)"""


@query("file_timestamp_s", f"""
    WITH {_S_NAMES_SQL.strip()},
    d AS (SELECT event_id, name, regexp_extract(name, '_s(\\d{{14}})', 1) AS g FROM names)
    SELECT event_id, name,
           CASE WHEN CAST(substr(g, 1, 4) AS INTEGER) >= 1 THEN try_strptime(
             substr(g, 1, 4) || '-' || substr(g, 5, 2) || '-' || substr(g, 7, 2) || ' ' ||
             substr(g, 9, 2) || ':' || substr(g, 11, 2) || ':' || substr(g, 13, 2),
             '%Y-%m-%d %H:%M:%S') END AS file_time
    FROM d""")
def q_file_timestamp_s(spark, sf_dir):
    n = _style_s_names(table(spark, sf_dir, "events"))
    return finish(n.select("event_id", "name", nm.file_timestamp("name").alias("file_time")))


def _style_doy_names(events: DataFrame) -> DataFrame:
    """Style-2 names: year 2020 + pmod(id, 3), day of year pmod(7 id, 368)
    (000 and 366/367 roll over), hour pmod(id, 26) (24, 25 invalid)."""
    eid = F.col("event_id")
    y = (F.lit(2020) + F.pmod(eid, F.lit(3))).cast("string")
    doy = F.lpad(F.pmod(eid * 7, F.lit(368)).cast("string"), 3, "0")
    hh = F.lpad(F.pmod(eid, F.lit(26)).cast("string"), 2, "0")
    return events.select(eid, F.concat(F.lit("OR_"), y, doy, F.lit("_"), hh,
                                       F.date_format("ts", "mm"), F.lit("_x.nc")).alias("name"))


@query("file_timestamp_doy", """
    WITH names AS (
      SELECT event_id,
             'OR_' || CAST(2020 + event_id % 3 AS VARCHAR)
               || lpad(CAST((event_id * 7) % 368 AS VARCHAR), 3, '0') || '_'
               || lpad(CAST(event_id % 26 AS VARCHAR), 2, '0') || strftime(ts, '%M') || '_x.nc'
               AS name
      FROM events),
    d AS (
      SELECT event_id, name,
             CAST(regexp_extract(name, '_(\\d{4})(\\d{3})_(\\d{2})(\\d{2})_', 1) AS INTEGER) AS y,
             CAST(regexp_extract(name, '_(\\d{4})(\\d{3})_(\\d{2})(\\d{2})_', 2) AS INTEGER) AS doy,
             CAST(regexp_extract(name, '_(\\d{4})(\\d{3})_(\\d{2})(\\d{2})_', 3) AS INTEGER) AS hh,
             CAST(regexp_extract(name, '_(\\d{4})(\\d{3})_(\\d{2})(\\d{2})_', 4) AS INTEGER) AS mm
      FROM names)
    SELECT event_id, name,
           CASE WHEN hh < 24 AND mm < 60 THEN
             CAST(make_date(y, 1, 1) + (doy - 1) AS TIMESTAMP) + to_hours(hh) + to_minutes(mm)
           END AS file_time
    FROM d""")
def q_file_timestamp_doy(spark, sf_dir):
    n = _style_doy_names(table(spark, sf_dir, "events"))
    return finish(n.select("event_id", "name", nm.file_timestamp("name").alias("file_time")))


# ================================================================ S1-S4, P4-P7

_L_SQL = """
    l AS (
      SELECT 'gs://bucket/scenes/' || strftime(ts, '%Y/%m/%d/%H%M') || '/X_s'
               || strftime(ts, '%Y%m%d%H%M%S') || '0_' || CAST(event_id AS VARCHAR) || '.nc'
               AS url, event_id, event_type, ts
      FROM events),
    lf AS (
      SELECT url, event_id, event_type, CAST(ts AS DATE) AS day,
             hour(ts) * 60 + minute(ts) AS minute,
             'X_s' || strftime(ts, '%Y%m%d%H%M%S') || '0_' || CAST(event_id AS VARCHAR) || '.nc'
               AS name
      FROM l)"""


def listing(spark, sf_dir) -> DataFrame:
    return series.events_listing(table(spark, sf_dir, "events"))


def held_listing(spark, sf_dir) -> DataFrame:
    """Files already held: those of the ``view`` and ``click`` events."""
    ev_ = table(spark, sf_dir, "events").filter(F.col("event_type").isin("view", "click"))
    return series.events_listing(ev_)


@query("day_listing", f"""
    WITH {_L_SQL.strip()}
    SELECT url, event_id, day, minute, name,
           'gs://bucket/scenes/' || strftime(day, '%Y/%m/%d') AS prefix FROM lf""")
def q_day_listing(spark, sf_dir):
    f = ls.with_listing_fields(listing(spark, sf_dir))
    return finish(f.select("url", "event_id", "day", "minute", "name",
                           nm.day_prefix(series.LISTING_PREFIX, F.col("day")).alias("prefix")))


_NEAREST_SQL = f"""
    {_L_SQL.strip()},
    hours AS (SELECT range AS h FROM range(24)),
    ranked AS (
      SELECT lf.day, h, url, minute, name,
             row_number() OVER (PARTITION BY lf.day, h
                                ORDER BY abs(minute - 60 * h), minute, url) AS rk
      FROM lf JOIN hours ON true),
    chosen AS (
      SELECT day, url, min(minute) AS minute, min(name) AS name, count(*) AS n_hours
      FROM ranked WHERE rk = 1 GROUP BY day, url)"""


@query("nearest_hour_files", f"""
    WITH {_NEAREST_SQL.strip()}
    SELECT day, url, minute, name, n_hours FROM chosen""")
def q_nearest_hour_files(spark, sf_dir):
    c = nearest.nearest_per_hour(listing(spark, sf_dir))
    return finish(c.select("day", "url", "minute", "name",
                           F.size("hours").cast("bigint").alias("n_hours")))


@query("new_files", f"""
    WITH {_NEAREST_SQL.strip()},
    held AS (SELECT name FROM lf WHERE event_type IN ('view', 'click'))
    SELECT day, url, name FROM chosen c
    WHERE NOT EXISTS (SELECT 1 FROM held h WHERE h.name = c.name)""")
def q_new_files(spark, sf_dir):
    """Chosen files not yet held (held = files of view/click events)."""
    lst = listing(spark, sf_dir)
    held = ls.held_names(held_listing(spark, sf_dir))
    c = nearest.skip_existing(nearest.nearest_per_hour(lst), held)
    return finish(c.select("day", "url", "name"))


@query("day_report", f"""
    WITH {_NEAREST_SQL.strip()},
    held AS (SELECT DISTINCT name FROM lf WHERE event_type IN ('view', 'click')),
    days AS (SELECT CAST(d AS DATE) AS day FROM range(DATE '{LISTING_RANGE[0]}',
             DATE '{LISTING_RANGE[1]}' + INTERVAL 1 DAY, INTERVAL 1 DAY) t(d)),
    avail AS (SELECT day, count(*) + count(CASE WHEN event_id % 97 = 0 THEN 1 END) AS available
              FROM lf GROUP BY day),
    nch AS (SELECT day, count(*) AS chosen FROM chosen GROUP BY day),
    fresh AS (SELECT * FROM chosen c WHERE NOT EXISTS (SELECT 1 FROM held h WHERE h.name = c.name)),
    firstday AS (SELECT name, min(day) AS day FROM fresh GROUP BY name),
    req AS (SELECT f.day, count(*) AS new_requested FROM fresh f
            JOIN firstday d ON f.name = d.name AND f.day = d.day GROUP BY f.day),
    nn AS (SELECT day, count(*) AS new_names FROM firstday GROUP BY day),
    per AS (
      SELECT days.day, coalesce(available, 0) AS available, coalesce(chosen, 0) AS chosen,
             coalesce(new_requested, 0) AS new_requested, coalesce(new_names, 0) AS new_names
      FROM days LEFT JOIN avail USING (day) LEFT JOIN nch USING (day)
           LEFT JOIN req USING (day) LEFT JOIN nn USING (day))
    SELECT day, available, chosen, new_requested,
           CAST((SELECT count(*) FROM held) + sum(new_names) OVER (ORDER BY day) AS BIGINT)
             AS local_now,
           new_names AS delta
    FROM per""")
def q_day_report(spark, sf_dir):
    """J3 + W3 + S2 over a day range wider than the data (empty days kept).

    Every 97th file is listed once more below a path part that is no HHmm: it is
    available that day and never chosen."""
    lst = listing(spark, sf_dir).select("url", "event_id")
    untimed = lst.filter(F.col("event_id") % 97 == 0).withColumn(
        "url", F.regexp_replace("url", r"/\d{4}/([^/]+)$", "/full/$1"))
    lst = lst.unionByName(untimed).select("url")
    held = ls.held_names(held_listing(spark, sf_dir))
    days = ls.day_range(spark, *LISTING_RANGE)
    return finish(nearest.day_report(days, lst, held))


# ================================================================ S5, P8-P12, A1-A6 on G

def g_scenes(spark, sf_dir) -> DataFrame:
    return series.grid_scenes(table(spark, sf_dir, "embeddings"))


_G_CELLS_SQL = """
    g AS (
      SELECT vec_id, CAST(vec_id AS VARCHAR) AS scene_id, embedding,
             timestamp '2024-01-01 00:00:00' + to_minutes(vec_id * 10) AS t
      FROM embeddings),
    gf AS (
      SELECT *, 'G_' || strftime(t, '%Y%j') || '_' || strftime(t, '%H%M') || '_'
                 || CAST(vec_id AS VARCHAR) || '.nc' AS file
      FROM g),
    cells AS (
      SELECT scene_id, file, t, vec_id, i, i // 8 AS y, i % 8 AS x,
             CAST(embedding[i + 1] AS DOUBLE) AS v,
             vec_id % 7 <> 0 AS has_quality,
             CASE WHEN vec_id % 7 = 0 THEN NULL
                  WHEN (vec_id * 3 + i) % 11 = 0 THEN NULL
                  ELSE (vec_id + i) % 5 END AS q
      FROM gf, range(64) r(i)),
    crop AS (SELECT * FROM cells WHERE y >= 2 AND y < 6 AND x >= 2 AND x < 6),
    clean AS (
      SELECT *, CASE WHEN NOT isnan(v) AND v >= 0 AND (NOT has_quality OR coalesce(q = 0, false))
                     THEN v END AS cv
      FROM crop),
    stats AS (
      SELECT scene_id, file, t AS timestamp, count(*) AS n_pixels, count(cv) AS n_valid,
             count(CASE WHEN cv < 'Infinity'::DOUBLE THEN 1 END) AS n_finite,
             avg(cv) AS mean_rr, max(cv) AS max_rr, stddev_pop(cv) AS std_rr,
             avg(CASE WHEN cv > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS frac_rainy
      FROM clean GROUP BY scene_id, file, t)"""


@query("scene_crop", f"""
    WITH {_G_CELLS_SQL.strip()}
    SELECT scene_id, y, x, round(v, 6) AS value, q AS quality FROM crop""")
def q_scene_crop(spark, sf_dir):
    """P9 on array scenes: cropped cells, exploded only for the output."""
    c = sc.center_crop_arrays(g_scenes(spark, sf_dir), G_WINDOW)
    w = F.col("cx1") - F.col("cx0")
    out = c.select("scene_id", "cy0", "cx0", w.alias("w"), "quality",
                   F.posexplode("value").alias("pos", "value"))
    return finish(out.select(
        "scene_id", (F.col("cy0") + F.floor(F.col("pos") / F.col("w"))).alias("y"),
        (F.col("cx0") + F.pmod("pos", "w")).alias("x"),
        F.col("value").cast("double").alias("value"),
        F.get(F.col("quality"), F.col("pos")).alias("quality")))


@query("scene_clean", f"""
    WITH {_G_CELLS_SQL.strip()}
    SELECT scene_id, y, x, round(cv, 6) AS value FROM clean""")
def q_scene_clean(spark, sf_dir):
    """P9-P11 on long scenes: crop filter and clean projection."""
    long = sc.long_from_arrays(g_scenes(spark, sf_dir))
    c = sc.clean_long(sc.center_crop_long(long, win=G_WINDOW))
    return finish(c.select("scene_id", "y", "x", "value"))


_G_STATS_OUT = f"""
    SELECT scene_id, file, timestamp, n_pixels, n_valid, n_finite, {r('mean_rr')},
           {r('max_rr')}, {r('std_rr')}, {r('frac_rainy')},
           CASE WHEN n_finite = 0 THEN 'no_finite_pixel' END AS reject_reason
    FROM stats"""


@query("scene_stats", f"WITH {_G_CELLS_SQL.strip()} {_G_STATS_OUT}")
def q_scene_stats(spark, sf_dir):
    """A1-A5 on array scenes (row-local, no shuffle)."""
    return finish(sc.scene_stats_arrays(g_scenes(spark, sf_dir), G_WINDOW, 0.0))


@query("scene_stats_long", f"WITH {_G_CELLS_SQL.strip()} {_G_STATS_OUT}")
def q_scene_stats_long(spark, sf_dir):
    """A1-A5 on long scenes (one groupBy with partial aggregation)."""
    long = sc.long_from_arrays(g_scenes(spark, sf_dir))
    return finish(sc.scene_stats_long(long, G_WINDOW, 0.0).select(
        "scene_id", "file", "timestamp", "n_pixels", "n_valid", "n_finite", "mean_rr",
        "max_rr", "std_rr", "frac_rainy", "reject_reason"))


_CATALOG_SQL = """
    cat AS (
      SELECT CAST(vec_id AS VARCHAR) AS scene_id, 'latitude' AS var, 2 AS ndims,
             'float32' AS dtype, 0 AS ordinal FROM embeddings
      UNION ALL SELECT CAST(vec_id AS VARCHAR), 'DQF', 2, 'int8', 1 FROM embeddings
      UNION ALL SELECT CAST(vec_id AS VARCHAR), 'RRQPE', 2, 'float32', 2 FROM embeddings WHERE vec_id % 6 = 0
      UNION ALL SELECT CAST(vec_id AS VARCHAR), 'RRQPE', 1, 'float32', 2 FROM embeddings WHERE vec_id % 6 = 1
      UNION ALL SELECT CAST(vec_id AS VARCHAR), 'b', 2, 'int16', 2 FROM embeddings WHERE vec_id % 6 = 2
      UNION ALL SELECT CAST(vec_id AS VARCHAR), 'c', 2, 'float32', 3 FROM embeddings WHERE vec_id % 6 = 2
      UNION ALL SELECT CAST(vec_id AS VARCHAR), 'LATITUDE', 2, 'float32', 2 FROM embeddings WHERE vec_id % 6 = 3
      UNION ALL SELECT CAST(vec_id AS VARCHAR), 'd', 1, 'float64', 3 FROM embeddings WHERE vec_id % 6 = 3
      UNION ALL SELECT CAST(vec_id AS VARCHAR), 'Longitude', 2, 'float64', 2 FROM embeddings WHERE vec_id % 6 = 4
      UNION ALL SELECT CAST(vec_id AS VARCHAR), 'e', 2, 'float64', 3 FROM embeddings WHERE vec_id % 6 = 4),
    cand AS (
      SELECT scene_id, var, ndims,
             row_number() OVER (PARTITION BY scene_id ORDER BY var <> 'RRQPE', ordinal) AS rk
      FROM cat
      WHERE var = 'RRQPE' OR (lower(var) NOT IN ('latitude', 'longitude') AND ndims = 2
                              AND lower(dtype) LIKE 'float%')),
    pick AS (
      SELECT s.scene_id, c.var, c.ndims
      FROM (SELECT DISTINCT scene_id FROM cat) s
      LEFT JOIN cand c ON c.scene_id = s.scene_id AND c.rk = 1)"""


@query("scene_table", f"WITH {_G_CELLS_SQL.strip()} {_G_STATS_OUT}")
def q_scene_table(spark, sf_dir):
    """A scene table written and read with its declared schema, then reduced."""
    from scenecast.sources import tables
    path = shared_dir(spark, "scene-table")
    tables.normalize_scene_arrays(g_scenes(spark, sf_dir)).write.parquet(path)
    out = sc.scene_stats_arrays(tables.read_scenes(spark, path), G_WINDOW, 0.0)
    return finish(out.select("scene_id", "file", "timestamp", "n_pixels", "n_valid", "n_finite",
                             "mean_rr", "max_rr", "std_rr", "frac_rainy", "reject_reason"))


@query("pick_variable", f"WITH {_CATALOG_SQL.strip()} SELECT scene_id, var, ndims FROM pick")
def q_pick_variable(spark, sf_dir):
    """P8 on scenes that carry their file's variables: chosen inside the row."""
    g = series.grid_scenes(table(spark, sf_dir, "embeddings"), variables=True)
    return finish(sc.pick_variable_arrays(g).select("scene_id", "var", "ndims"))


@query("pick_variable_long",
       f"WITH {_CATALOG_SQL.strip()} SELECT scene_id, var, ndims FROM pick")
def q_pick_variable_long(spark, sf_dir):
    """P8 on a catalogue of one row per scene and variable."""
    cat = series.variable_catalog(table(spark, sf_dir, "embeddings"))
    return finish(sc.pick_variable(cat))


@query("scene_rejects", f"""
    WITH {_G_CELLS_SQL.strip()}, {_CATALOG_SQL.strip()},
    j AS (
      SELECT CASE WHEN p.var IS NULL THEN 'no_variable'
                  WHEN p.ndims <> 2 THEN 'not_2d'
                  WHEN CAST(scene_id AS BIGINT) % 11 = 0 OR CAST(scene_id AS BIGINT) % 13 = 0
                    THEN 'bad_grid'
                  WHEN coalesce(s.n_finite, 0) = 0 THEN 'no_finite_pixel'
                  ELSE 'accepted' END AS outcome
      FROM stats s JOIN pick p USING (scene_id))
    SELECT outcome, count(*) AS scenes FROM j GROUP BY outcome""")
def q_scene_rejects(spark, sf_dir):
    """P12 + A6: outcome of every scene, its variable chosen in the same row.

    Some scenes have no values (every 11th) or too few for their grid (every 13th)."""
    n = F.col("scene_id").cast("bigint")
    value = F.when(n % 11 == 0, F.lit(None)).when(n % 13 == 0, F.slice("value", 1, 3)).otherwise(
        F.col("value"))
    g = series.grid_scenes(table(spark, sf_dir, "embeddings"), variables=True)
    g = sc.pick_variable_arrays(g).withColumn("value", value)
    return finish(sc.reject_counts(sc.scene_stats_arrays(g, G_WINDOW, 0.0)))


# ================================================================ A6, S14, P19-P23, A7 on D

@query("series_profile", f"""
    WITH {D_FEATURES_CTE.strip()}
    SELECT count(*) AS rows, string_agg(DISTINCT CAST(year AS VARCHAR), ',' ORDER BY CAST(year AS VARCHAR)) AS years,
           {r('min(mean_rr)', 'min_mean_rr')}, {r('max(mean_rr)', 'max_mean_rr')}
    FROM f""")
def q_series_profile(spark, sf_dir):
    """Build report of the daily feature table."""
    rep = sc.build_report(d_features(spark, sf_dir))
    return finish(rep.select("rows", F.array_join(F.transform("years", lambda y: y.cast("string")),
                                                  ",").alias("years"),
                             "min_mean_rr", "max_mean_rr"))


_FEATURE_TYPES = [("file", "string"), ("mean_rr", "double"), ("max_rr", "double"),
                  ("std_rr", "double"), ("frac_rainy", "double"), ("year", "int"),
                  ("month", "int"), ("day", "int"), ("hour", "int"), ("timestamp_ms", "bigint"),
                  ("timestamp_str", "string"), ("delta_minutes", "float")]


@query("feature_profile", f"""
    WITH {D_FEATURES_CTE.strip()}
    """ + " UNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS \"column\", '{t}' AS type, count(*) AS rows, "
    f"count({c}) AS non_null FROM f" for i, (c, t) in enumerate(_FEATURE_TYPES)))
def q_feature_profile(spark, sf_dir):
    """Schema and non-null counts of the feature table from one aggregate."""
    return finish(ds.profile(d_features(spark, sf_dir)))


_D_FEATURES9 = list(FEATURE_COLS)
_COMPLETE_SQL = " AND ".join(f"{c} IS NOT NULL AND NOT isnan({c})"
                             for c in ["mean_rr"] + _D_FEATURES9)


@query("time_split", f"""
    WITH {D_PREPARED_CTE.strip()},
    sp AS (
      SELECT *, 'train' AS split FROM p WHERE year = {D_TRAIN_YEAR}
      UNION ALL
      SELECT *, 'test' AS split FROM p WHERE date BETWEEN DATE '{D_TEST[0]}' AND DATE '{D_TEST[1]}')
    SELECT split, file, date, {r('mean_rr')}, {r('mean_rr_lag1')}, {r('mean_rr_lag3')} FROM sp""")
def q_time_split(spark, sf_dir):
    """P19-P21 on D: split after the lags (test rows keep history)."""
    sp = ds.split_frame(d_prepared(spark, sf_dir, shared=False), D_TRAIN_YEAR, *D_TEST)
    return finish(sp.select("split", "file", "date", "mean_rr", "mean_rr_lag1", "mean_rr_lag3"))


@query("split_counts", f"""
    WITH {D_PREPARED_CTE.strip()},
    sp AS (
      SELECT *, 'train' AS split FROM p WHERE year = {D_TRAIN_YEAR}
      UNION ALL
      SELECT *, 'test' AS split FROM p WHERE date BETWEEN DATE '{D_TEST[0]}' AND DATE '{D_TEST[1]}')
    SELECT split, count(*) AS rows_raw,
           count(CASE WHEN {_COMPLETE_SQL} THEN 1 END) AS rows_complete
    FROM sp GROUP BY split""")
def q_split_counts(spark, sf_dir):
    """Rows per split before/after the completeness filter, one pass."""
    return finish(ds.split_counts(ds.split_frame(d_prepared(spark, sf_dir, shared=False), D_TRAIN_YEAR,
                                                 *D_TEST)))


@query("model_frame", f"""
    WITH {D_PREPARED_CTE.strip()}
    SELECT timestamp, {r('mean_rr', 'label')}, {', '.join(r(c) for c in _D_FEATURES9)}
    FROM p WHERE year = {D_TRAIN_YEAR} AND {_COMPLETE_SQL}""")
def q_model_frame(spark, sf_dir):
    """P22 + P23: complete training rows as label + 9 features."""
    train, _ = ds.time_split(d_prepared(spark, sf_dir, shared=False), D_TRAIN_YEAR, *D_TEST)
    return finish(ds.model_frame(train, keys=["timestamp"]))


@query("write_read_features", f"""
    WITH {D_FEATURES_CTE.strip()}
    SELECT {FEATURE_OUT_SQL} FROM f""")
def q_write_read_features(spark, sf_dir):
    """S6 + S7: write the daily feature table partitioned by year to the
    shared folder, read it back with the declared schema."""
    from scenecast.sources import tables
    path = tables.write_features(d_features(spark, sf_dir), shared_dir(spark, "features"))
    return finish(tables.read_features(spark, path))


# ================================================================ H frames, A8-A14, T2, J4, M12, M13

_H9 = _D_FEATURES9
_H_COMPLETE_SQL = _COMPLETE_SQL
_H_FRAMES_SQL = f"""
    {H_PREPARED_CTE.strip()},
    test AS (
      SELECT timestamp, mean_rr AS label, {', '.join(_H9)}, month FROM p
      WHERE date BETWEEN DATE '{H_TEST[0]}' AND DATE '{H_TEST[1]}' AND {_H_COMPLETE_SQL}),
    train AS (
      SELECT timestamp, mean_rr AS label, {', '.join(_H9)}, hour FROM p
      WHERE year = {H_TRAIN_YEAR} AND date < DATE '{H_TRAIN_UNTIL}' AND {_H_COMPLETE_SQL}),
    pred AS (
      SELECT 'persistence' AS model, timestamp, label, mean_rr_lag1 AS prediction FROM test
      UNION ALL SELECT 'lag2', timestamp, label, mean_rr_lag2 FROM test
      UNION ALL SELECT 'mean3', timestamp, label,
                       (mean_rr_lag1 + mean_rr_lag2 + mean_rr_lag3) / 3.0 FROM test)"""

PERSISTENCE_MODELS = ["persistence", "lag2", "mean3"]


def h_frames(spark, sf_dir, extra: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(train, test) model frames of H with ``timestamp`` kept as key."""
    p = h_prepared(spark, sf_dir)
    train, test = ds.time_split(p, H_TRAIN_YEAR, *H_TEST, train_until=H_TRAIN_UNTIL)
    keys = ["timestamp"] + (extra or [])
    return ds.model_frame(train, keys=keys), ds.model_frame(test, keys=keys)


def h_persistence(spark, sf_dir) -> DataFrame:
    """Long predictions of three baseline predictors on the H test window."""
    _, test = h_frames(spark, sf_dir)
    wide = test.withColumns({
        "persistence": F.col("mean_rr_lag1"), "lag2": F.col("mean_rr_lag2"),
        "mean3": (F.col("mean_rr_lag1") + F.col("mean_rr_lag2") + F.col("mean_rr_lag3")) / 3.0})
    return ev.stack_predictions(wide, {m: m for m in PERSISTENCE_MODELS}, ["timestamp"])


_SCORE_SQL = """count(*) AS n,
           round(sqrt(avg((prediction - label) * (prediction - label))), 6) AS rmse,
           round(1 - sum((prediction - label) * (prediction - label))
                 / nullif(count(label) * var_pop(label), 0), 6) AS r2"""


@query("persistence_scores", f"""
    WITH {_H_FRAMES_SQL.strip()}
    SELECT model, {_SCORE_SQL} FROM pred GROUP BY model""")
def q_persistence_scores(spark, sf_dir):
    """RMSE and R^2 of every predictor in one aggregate."""
    return finish(ev.score(h_persistence(spark, sf_dir)))


@query("scores_by_day", f"""
    WITH {_H_FRAMES_SQL.strip()}
    SELECT model, CAST(timestamp AS DATE) AS date, {_SCORE_SQL}
    FROM pred GROUP BY model, CAST(timestamp AS DATE)""")
def q_scores_by_day(spark, sf_dir):
    """A10 grouped by model and day."""
    return finish(ev.scores_by_day(h_persistence(spark, sf_dir)))


@query("model_comparison", f"""
    WITH {_H_FRAMES_SQL.strip()},
    sc AS (SELECT model, {_SCORE_SQL} FROM pred GROUP BY model)
    SELECT *, row_number() OVER (ORDER BY rmse, model) AS rank FROM sc""")
def q_model_comparison(spark, sf_dir):
    """Models ranked by RMSE."""
    return finish(ev.compare_models(finish(ev.score(h_persistence(spark, sf_dir)))))


def _hist_sql(values_sql: str, bins: int, group: bool) -> str:
    g = "model, " if group else ""
    gj = "USING (model)" if group else "ON true"
    return f"""
    vals AS ({values_sql}),
    rng0 AS (SELECT {g}min(x) AS mn, max(x) AS mx FROM vals {'GROUP BY model' if group else ''}),
    rng AS (SELECT {g}CASE WHEN mn = mx THEN mn - 0.5 ELSE mn END AS lo,
                   CASE WHEN mn = mx THEN mx + 0.5 ELSE mx END AS hi FROM rng0),
    b AS (
      SELECT {g}least(CAST(floor((x - lo) / (hi - lo) * {float(bins)}) AS BIGINT) + 1, {bins}) AS bin,
             count(*) AS cnt
      FROM vals JOIN rng {gj} GROUP BY ALL),
    allb AS (SELECT {g}lo, hi, CAST(range AS BIGINT) AS bin FROM rng, range(1, {bins + 1}))
    SELECT {'allb.model, ' if group else ''}allb.bin, round(lo + (allb.bin - 1) * ((hi - lo) / {float(bins)}), 6) AS bin_lo,
           round(lo + allb.bin * ((hi - lo) / {float(bins)}), 6) AS bin_hi,
           coalesce(cnt, 0) AS count
    FROM allb LEFT JOIN b ON {'allb.model = b.model AND ' if group else ''}allb.bin = b.bin"""


@query("residual_histogram", f"""
    WITH {_H_FRAMES_SQL.strip()},
    {_hist_sql("SELECT model, prediction - label AS x FROM pred", 40, True).strip()}""")
def q_residual_histogram(spark, sf_dir):
    """40-bin residual histogram per model (empty bins kept)."""
    e = rp.with_errors(h_persistence(spark, sf_dir))
    return finish(rp.histogram(e, "error", rp.RESIDUAL_BINS, ["model"]))


@query("target_histogram", f"""
    WITH {_H_FRAMES_SQL.strip()},
    {_hist_sql("SELECT label AS x FROM test", 60, False).strip()}""")
def q_target_histogram(spark, sf_dir):
    """60-bin histogram of the label on the test window."""
    _, test = h_frames(spark, sf_dir)
    return finish(rp.histogram(test, "label", rp.TARGET_BINS))


_CORR_COLS = _H9 + ["month"]


def _corr_sql() -> str:
    pairs = [(i, j) for i in range(len(_CORR_COLS)) for j in range(i, len(_CORR_COLS))]
    aggs = []
    for i, j in pairs:
        a, b = _CORR_COLS[i], _CORR_COLS[j]
        both = f"{a} IS NOT NULL AND {b} IS NOT NULL"
        ca, cb = f"CASE WHEN {both} THEN CAST({a} AS DOUBLE) END", \
            f"CASE WHEN {both} THEN CAST({b} AS DOUBLE) END"
        aggs.append(f"covar_pop({ca}, {cb}) / nullif(stddev_pop({ca}) * stddev_pop({cb}), 0)"
                    f" AS c{i}_{j}")
    sel = []
    for i, j in pairs:
        sel.append(f"SELECT '{_CORR_COLS[i]}' AS f1, '{_CORR_COLS[j]}' AS f2, "
                   f"round(c{i}_{j}, 6) AS corr FROM one")
        if i != j:
            sel.append(f"SELECT '{_CORR_COLS[j]}' AS f1, '{_CORR_COLS[i]}' AS f2, "
                       f"round(c{i}_{j}, 6) AS corr FROM one")
    return (f"WITH {_H_FRAMES_SQL.strip()}, one AS MATERIALIZED (SELECT {', '.join(aggs)} "
            f"FROM test) " + " UNION ALL ".join(sel))


@query("feature_correlation", _corr_sql())
def q_feature_correlation(spark, sf_dir):
    """Pearson matrix of the 9 features and a constant column (month)."""
    _, test = h_frames(spark, sf_dir, extra=["month"])
    return finish(rp.correlation(test, _CORR_COLS))


@query("value_range", f"""
    WITH {_H_FRAMES_SQL.strip()}
    SELECT model, round(least(min(label), min(prediction)), 6) AS range_min,
           round(greatest(max(label), max(prediction)), 6) AS range_max
    FROM pred GROUP BY model""")
def q_value_range(spark, sf_dir):
    """Common range of label and prediction per model."""
    return finish(rp.value_range(h_persistence(spark, sf_dir), group_cols=["model"]))


_ERR_COLS_SQL = """timestamp, round(label, 6) AS label, round(prediction, 6) AS prediction,
           round(prediction - label, 6) AS error, round(abs(prediction - label), 6) AS abs_error,
           strftime(timestamp, '%m-%d %H:%M') AS time_label"""


@query("top_errors", f"""
    WITH {_H_FRAMES_SQL.strip()}
    SELECT model, {_ERR_COLS_SQL} FROM pred WHERE model = 'persistence'
    ORDER BY abs(prediction - label) DESC, timestamp LIMIT {rp.TOP_ERRORS}""")
def q_top_errors(spark, sf_dir):
    """T2 + P24 + P25: the 20 largest absolute errors of one model."""
    p = h_persistence(spark, sf_dir).filter(F.col("model") == "persistence")
    return finish(rp.top_errors(p))


@query("top_errors_per_model", f"""
    WITH {_H_FRAMES_SQL.strip()},
    rk AS (SELECT *, row_number() OVER (PARTITION BY model
                    ORDER BY abs(prediction - label) DESC, timestamp) AS rank FROM pred)
    SELECT model, {_ERR_COLS_SQL}, rank FROM rk WHERE rank <= {rp.TOP_ERRORS}""")
def q_top_errors_per_model(spark, sf_dir):
    """T2 per model: row_number <= 20 (partial group limit before the shuffle)."""
    return finish(rp.top_errors(h_persistence(spark, sf_dir), group_cols=["model"]))


@query("model_overlay", f"""
    WITH {_H_FRAMES_SQL.strip()}
    SELECT timestamp,
           round(max(CASE WHEN model = 'persistence' THEN label END), 6) AS label,
           {', '.join(f"round(max(CASE WHEN model = '{m}' THEN prediction END), 6) AS {m}"
                      for m in PERSISTENCE_MODELS)}
    FROM pred GROUP BY timestamp""")
def q_model_overlay(spark, sf_dir):
    """J4 + U3: label and every model's prediction aligned on time."""
    return finish(rp.overlay(h_persistence(spark, sf_dir), PERSISTENCE_MODELS))


@query("prediction_series", f"""
    WITH {_H_FRAMES_SQL.strip()}
    SELECT model, {_ERR_COLS_SQL} FROM pred""")
def q_prediction_series(spark, sf_dir):
    """M13 + P24: per-model series of label, prediction and errors."""
    return finish(rp.prediction_series(h_persistence(spark, sf_dir)))


# ================================================================ M1-M13 (MLlib)

@query("standardized", f"""
    WITH {_H_FRAMES_SQL.strip()}
    SELECT timestamp, {', '.join(
        f"round(CASE WHEN stddev_samp({c}) OVER () = 0 THEN 0.0 ELSE ({c} - avg({c}) OVER ())"
        f" / stddev_samp({c}) OVER () END, 6) AS {c}" for c in _H9)}
    FROM train""")
def q_standardized(spark, sf_dir):
    """M1 + M2: assembled features standardised by MLlib (mean, sample std)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import StandardScaler
    from pyspark.ml.functions import vector_to_array
    train, _ = h_frames(spark, sf_dir)
    pipe = Pipeline(stages=[mdl.assembler(_H9),
                            StandardScaler(inputCol="features", outputCol="scaled",
                                           withMean=True, withStd=True)])
    out = pipe.fit(train).transform(train).withColumn("__a", vector_to_array("scaled"))
    return finish(out.select("timestamp", *[F.col("__a")[i].alias(c) for i, c in enumerate(_H9)]))


@query("linreg_one_feature", f"""
    WITH {_H_FRAMES_SQL.strip()}
    SELECT 'mean_rr_lag1' AS feature, round(regr_slope(label, mean_rr_lag1), 6) AS coefficient,
           round(regr_intercept(label, mean_rr_lag1), 6) AS intercept, count(*) AS n
    FROM train""")
def q_linreg_one_feature(spark, sf_dir):
    """M3: least squares on one feature, distributed fit, against regr_*."""
    from pyspark.ml import Pipeline
    from pyspark.ml.regression import LinearRegression
    train, _ = h_frames(spark, sf_dir)
    m = Pipeline(stages=[mdl.assembler(["mean_rr_lag1"]),
                         LinearRegression(featuresCol="features", labelCol="label")]).fit(train)
    lr = m.stages[-1]
    return finish(spark.createDataFrame(
        [("mean_rr_lag1", float(lr.coefficients[0]), float(lr.intercept),
          int(lr.summary.numInstances))],
        "feature string, coefficient double, intercept double, n bigint"))


@query("tree_stump", f"""
    WITH {_H_FRAMES_SQL.strip()},
    hv AS (SELECT DISTINCT CAST(hour AS DOUBLE) AS h FROM train),
    th AS (SELECT (h + lead(h) OVER (ORDER BY h)) / 2 AS t FROM hv),
    cand AS (
      SELECT t, count(CASE WHEN hour <= t THEN 1 END) AS nl,
             sum(CASE WHEN hour <= t THEN label END) AS sl,
             sum(CASE WHEN hour <= t THEN label * label END) AS ql,
             count(CASE WHEN hour > t THEN 1 END) AS nr,
             sum(CASE WHEN hour > t THEN label END) AS sr,
             sum(CASE WHEN hour > t THEN label * label END) AS qr
      FROM th JOIN train ON true WHERE t IS NOT NULL GROUP BY t),
    best AS (
      SELECT * FROM cand WHERE nl > 0 AND nr > 0
      ORDER BY (ql - sl * sl / nl) + (qr - sr * sr / nr), t LIMIT 1)
    SELECT round(t, 6) AS threshold, round(sl / nl, 6) AS left_mean,
           round(sr / nr, 6) AS right_mean, nl AS n_left, nr AS n_right
    FROM best""")
def q_tree_stump(spark, sf_dir):
    """M4 at depth 1 on ``hour`` (24 values < 32 bins): the exhaustive best split."""
    from pyspark.ml import Pipeline
    train, _ = h_frames(spark, sf_dir, extra=["hour"])
    m = mdl.tree_pipeline(["hour"], maxDepth=1, minInstancesPerNode=1).fit(train)
    root = m.stages[-1]._java_obj.rootNode()
    t = float(root.split().threshold())
    sides = train.agg(F.count_if(F.col("hour") <= t).alias("n_left"),
                      F.count_if(F.col("hour") > t).alias("n_right"))
    return finish(sides.select(
        F.lit(t).alias("threshold"), F.lit(float(root.leftChild().prediction())).alias("left_mean"),
        F.lit(float(root.rightChild().prediction())).alias("right_mean"), "n_left", "n_right"))


def _fit_score(spark, sf_dir, names: list[str], boosted_rounds: int = 20):
    train, test = h_frames(spark, sf_dir)
    specs = mdl.default_specs(_H9, boosted_rounds=boosted_rounds, second_order=False)
    fitted = mdl.fit_models(train, {n: specs[n] for n in names})
    return fitted, test


def _scores_query(names):
    def run(spark, sf_dir):
        fitted, test = _fit_score(spark, sf_dir, names)
        return finish(ev.score(mdl.predict(fitted, test, ["timestamp"])))
    return run


def _stump_ctes(name: str, src: str, y: str) -> str:
    """Best split of ``src`` on ``hour`` for target ``y`` as {name}(t, lm, rm)."""
    return f"""
    {name}_cand AS (
      SELECT t, count(CASE WHEN hour <= t THEN 1 END) AS nl, sum(CASE WHEN hour <= t THEN {y} END) AS sl,
             sum(CASE WHEN hour <= t THEN {y} * {y} END) AS ql,
             count(CASE WHEN hour > t THEN 1 END) AS nr, sum(CASE WHEN hour > t THEN {y} END) AS sr,
             sum(CASE WHEN hour > t THEN {y} * {y} END) AS qr
      FROM (SELECT (h + lead(h) OVER (ORDER BY h)) / 2 AS t
            FROM (SELECT DISTINCT CAST(hour AS DOUBLE) AS h FROM {src})) JOIN {src} ON true
      WHERE t IS NOT NULL GROUP BY t),
    {name} AS (
      SELECT t, sl / nl AS lm, sr / nr AS rm FROM {name}_cand WHERE nl > 0 AND nr > 0
      ORDER BY (ql - sl * sl / nl) + (qr - sr * sr / nr), t LIMIT 1)"""


def _hour_scores(spark, sf_dir, name, pipeline):
    """Fit one of the library's pipelines on ``hour`` and score it on the test window."""
    train, test = h_frames(spark, sf_dir, extra=["hour"])
    fitted = mdl.fit_models(train, {name: lambda: pipeline})
    return finish(ev.score(mdl.predict(fitted, test, ["timestamp"])))


@query("forest_stump", f"""
    WITH {_H_FRAMES_SQL.strip()}, {_stump_ctes('split1', 'train', 'label').strip()},
    scored AS (SELECT 'forest' AS model, label, CASE WHEN hour(timestamp) <= t THEN lm ELSE rm END
            AS prediction FROM test, split1)
    SELECT model, {_SCORE_SQL} FROM scored GROUP BY model""")
def q_forest_stump(spark, sf_dir):
    """M5 without bootstrap and feature sampling at depth 1: every tree is the best split."""
    return _hour_scores(spark, sf_dir, "forest", mdl.forest_pipeline(
        ["hour"], numTrees=3, maxDepth=1, bootstrap=False, featureSubsetStrategy="all",
        subsamplingRate=1.0, minInstancesPerNode=1))


@query("boosted_two_rounds", f"""
    WITH {_H_FRAMES_SQL.strip()}, {_stump_ctes('split1', 'train', 'label').strip()},
    grad AS (SELECT hour, 2 * (label - CASE WHEN hour <= t THEN lm ELSE rm END) AS g FROM train, split1),
    {_stump_ctes('split2', 'grad', 'g').strip()},
    scored AS (SELECT 'boosted' AS model, label,
                 CASE WHEN hour(timestamp) <= split1.t THEN split1.lm ELSE split1.rm END
                 + 0.05 * CASE WHEN hour(timestamp) <= split2.t THEN split2.lm ELSE split2.rm END AS prediction
          FROM test, split1, split2)
    SELECT model, {_SCORE_SQL} FROM scored GROUP BY model""")
def q_boosted_two_rounds(spark, sf_dir):
    """M6 at two rounds, depth 1, no sampling: a split of the label and one of the gradient."""
    return _hour_scores(spark, sf_dir, "boosted", mdl.boosted_pipeline(
        ["hour"], maxIter=2, maxDepth=1, subsamplingRate=1.0, featureSubsetStrategy="all",
        minInstancesPerNode=1))


@query("linreg_two_coefficients", f"""
    WITH {_H_FRAMES_SQL.strip()},
    moments AS (SELECT var_samp(mean_rr_lag1) AS a, var_samp(mean_rr_lag2) AS b,
                 covar_samp(mean_rr_lag1, mean_rr_lag2) AS c, covar_samp(mean_rr_lag1, label) AS p,
                 covar_samp(mean_rr_lag2, label) AS q, avg(label) AS y FROM train),
    coefs AS (SELECT 'mean_rr_lag1' AS feature, (p * b - q * c) / (a * b - c * c) AS raw, sqrt(a) AS s FROM moments
          UNION ALL SELECT 'mean_rr_lag2', (q * a - p * c) / (a * b - c * c), sqrt(b) FROM moments)
    SELECT 'linear_regression' AS model, feature, round(raw * s, 6) AS coef_scaled,
           round(raw, 6) AS coef_raw, row_number() OVER (ORDER BY abs(raw * s) DESC, feature) AS rank
    FROM coefs
    UNION ALL SELECT 'linear_regression', '(intercept)', round(y, 6), round(y, 6), 0 FROM moments""")
def q_linreg_two_coefficients(spark, sf_dir):
    """M3, M11 + T4 on two features: least squares in closed form."""
    features = ["mean_rr_lag1", "mean_rr_lag2"]
    train, _ = h_frames(spark, sf_dir)
    fitted = mdl.fit_models(train, {"linear_regression": lambda: mdl.linear_pipeline(features)})
    out = mdl.coefficients(fitted["linear_regression"], features, spark=spark)
    # the intercept has no rank and is in the label's unit either way
    return finish(out.withColumns({"rank": F.coalesce("rank", F.lit(0)),
                                   "coef_raw": F.coalesce("coef_raw", "coef_scaled")}))


@query("backtest_linear", f"""
    WITH {_H_FRAMES_SQL.strip()},
    line AS (SELECT regr_slope(label, mean_rr_lag1) AS b, regr_intercept(label, mean_rr_lag1) AS a
             FROM train),
    scored AS (SELECT 'linear_regression' AS model, label, a + b * mean_rr_lag1 AS prediction
          FROM test, line),
    summed AS (SELECT model, {_SCORE_SQL} FROM scored GROUP BY model)
    SELECT model, n, rmse, r2, rmse AS recorded_rmse, 'a' AS older_run FROM summed""")
def q_backtest_linear(spark, sf_dir):
    """S8-S11, T6, M9 exactly: save a one-feature fit under two run folders, record the run,
    find the latest, reload what is there of two names, and score the window after training."""
    from scenecast.sources import store
    train, test = h_frames(spark, sf_dir)
    fitted = mdl.fit_models(train, {
        "linear_regression": lambda: mdl.linear_pipeline(["mean_rr_lag1"])})
    root = shared_dir(spark, "runs")
    scores = ev.score(mdl.predict(fitted, test, ["timestamp"]))
    for run in ("a", "b"):
        store.save_models(fitted, f"{root}/{run}")
    store.write_run_record(store.run_record("b", H_TRAIN_YEAR, *H_TEST, ["mean_rr_lag1"], scores),
                           f"{root}/b")
    latest = store.latest_run(spark, root)
    loaded = store.load_models(spark, latest, ["linear_regression", "decision_tree"], "skip")
    window = ds.load_window(series.hourly_features(table(spark, sf_dir, "events")), *H_TEST,
                            keys=["timestamp"], lag_bucket="day")
    again = ev.score(mdl.predict(loaded, window, ["timestamp"]))
    record = store.read_run_record(spark, latest).select(
        F.explode("results").alias("model", "r")).select(
        "model", F.col("r.rmse").alias("recorded_rmse"))
    return finish(again.join(record, "model").withColumn("older_run", F.lit("a")))


query("linreg_nine")(_scores_query(["linear_regression"]))
query("tree")(_scores_query(["decision_tree"]))
query("forest")(_scores_query(["random_forest"]))
query("boosted")(_scores_query(["boosted_trees"]))


@query("importance_rank")
def q_importance_rank(spark, sf_dir):
    """M10 + T3: feature importances of the tree models, ranked."""
    fitted, _ = _fit_score(spark, sf_dir, ["decision_tree", "random_forest"])
    return finish(mdl.importances(fitted, _H9, spark))


@query("linreg_coefficients")
def q_linreg_coefficients(spark, sf_dir):
    """M11 + T4: linear coefficients on scaled features, ranked by magnitude."""
    fitted, _ = _fit_score(spark, sf_dir, ["linear_regression"])
    return finish(mdl.coefficients(fitted["linear_regression"], _H9, spark=spark))


@query("backtest_saved")
def q_backtest_saved(spark, sf_dir):
    """Fit, save under a run folder, record the run, find the
    latest run, reload its models and score another window."""
    from scenecast.sources import store
    names = list(mdl.MODEL_NAMES)
    fitted, test = _fit_score(spark, sf_dir, names)
    root = shared_dir(spark, "models")
    run_dir = f"{root}/{store.new_run_id()}"
    store.save_models(fitted, run_dir)
    scores = ev.score(mdl.predict(fitted, test, ["timestamp"]))
    store.write_run_record(store.run_record(run_dir.rsplit("/", 1)[-1], H_TRAIN_YEAR,
                                            H_TEST[0], H_TEST[1], _H9, scores), run_dir)
    latest = store.latest_run(spark, root)
    loaded = store.load_models(spark, latest, names + ["absent"], missing="skip")
    h = table(spark, sf_dir, "events")
    window = ds.load_window(series.hourly_features(h), *H_TEST,
                            lag_bucket=F.date_trunc("day", F.col("timestamp")))
    return finish(ev.score(mdl.predict(loaded, window, ["timestamp"])))


# ================================================================ S12, S13, X1 round trips

@query("predictions_csv", f"""
    WITH {_H_FRAMES_SQL.strip()}
    SELECT model, timestamp, round(label, 6) AS label, round(prediction, 6) AS prediction
    FROM pred""")
def q_predictions_csv(spark, sf_dir):
    """Predictions written as CSV (one folder per model) and read back."""
    from scenecast.sources import tables
    path = tables.write_predictions(h_persistence(spark, sf_dir), shared_dir(spark, "pred-csv"))
    back = (spark.read.option("header", True)
            .schema("timestamp timestamp_ntz, label double, prediction double, model string")
            .csv(path))
    return finish(back.select("model", "timestamp", "label", "prediction"))


@query("metrics_summary_json", f"""
    WITH {_H_FRAMES_SQL.strip()}
    SELECT model, {_SCORE_SQL.split(',', 1)[1].strip()}, '{H_TEST[0]}' AS start_date,
           '{H_TEST[1]}' AS end_date
    FROM pred GROUP BY model""")
def q_metrics_summary_json(spark, sf_dir):
    """The metrics summary (rmse and r2 maps) written as JSON, read back
    with its declared schema and flattened to one row per model."""
    from scenecast.schemas import METRICS_SUMMARY
    from scenecast.sources import store
    scores = ev.score(h_persistence(spark, sf_dir))
    path = store.write_json(store.metrics_summary(spark, scores, "run", *H_TEST),
                            shared_dir(spark, "summary"))
    back = spark.read.schema(METRICS_SUMMARY).json(path)
    flat = back.select(F.explode("rmse").alias("model", "rmse"), "r2", "date_range")
    return finish(flat.select("model", "rmse", F.col("r2")[F.col("model")].alias("r2"),
                              F.col("date_range.start").alias("start_date"),
                              F.col("date_range.end").alias("end_date")))


@query("stream_scene_stats", f"WITH {_G_CELLS_SQL.strip()} {_G_STATS_OUT}")
def q_stream_scene_stats(spark, sf_dir):
    """Scene files ingested by a file-source stream (availableNow) into a
    Parquet sink; the sink holds every scene's statistics once."""
    from scenecast.streaming import incremental
    src, sink, ck = (shared_dir(spark, n) for n in ("scenes", "scene-stats", "scene-ckpt"))
    g_scenes(spark, sf_dir).write.parquet(src)
    incremental.ingest_scene_stats(spark, src, sink, ck, win=G_WINDOW).awaitTermination()
    out = spark.read.parquet(sink)
    return finish(out.select("scene_id", "file", "timestamp", "n_pixels", "n_valid", "n_finite",
                             "mean_rr", "max_rr", "std_rr", "frac_rainy", "reject_reason"))


@query("stream_scores", f"""
    WITH {_H_FRAMES_SQL.strip()},
    coef AS (SELECT regr_slope(label, mean_rr_lag1) AS b, regr_intercept(label, mean_rr_lag1) AS a
             FROM train)
    SELECT timestamp, round(label, 6) AS label, round(a + b * mean_rr_lag1, 6) AS prediction
    FROM test, coef""")
def q_stream_scores(spark, sf_dir):
    """X2 + S8/S9: a pipeline fitted on the training window is saved, then
    feature rows arriving as files are scored by a stream (availableNow)
    with the reloaded model into a Parquet sink.  The model is least squares
    on ``mean_rr_lag1``, whose predictions have an exact SQL form."""
    from pyspark.ml import Pipeline
    from pyspark.ml.regression import LinearRegression
    from scenecast.streaming import incremental
    train, test = h_frames(spark, sf_dir)
    model = Pipeline(stages=[mdl.assembler(["mean_rr_lag1"]),
                             LinearRegression(featuresCol="features", labelCol="label")]
                     ).fit(train)
    mpath, src, sink, ck = (shared_dir(spark, n) for n in ("lr1", "rows", "scored", "ckpt"))
    model.write().overwrite().save(mpath)
    test.write.parquet(src)
    incremental.score_new_rows(spark, mpath, src, test.schema, sink, ck,
                               keep=["timestamp"]).awaitTermination()
    return finish(spark.read.parquet(sink).select("timestamp", "label", "prediction"))


# ================================================================ many series: split, fit, score

S_KEYS = ["l_suppkey", "timestamp"]
_S_FRAMES_SQL = f"""
    {S_PREPARED_CTE.strip()},
    test AS (
      SELECT l_suppkey, timestamp, mean_rr AS label, mean_rr_lag1, mean_rr_lag2, mean_rr_lag3
      FROM p WHERE year = 2001 AND {_COMPLETE_SQL}),
    train AS (
      SELECT l_suppkey, timestamp, mean_rr AS label, max_rr, mean_rr_lag1
      FROM p WHERE year = {D_TRAIN_YEAR} AND {_COMPLETE_SQL})"""
S_TEST = ("2001-01-01", "2001-12-31")                 # S: test year 2001


def s_frames(spark, sf_dir, shared: bool = True) -> tuple[DataFrame, DataFrame]:
    """(train, test) model frames over all suppliers.

    ``shared``: the rows of either set are written once, for both are read; a query that
    reads one of them skips that.  The years of the sets are named beside their days: lags and
    gaps are windows per supplier and year, so Spark takes that condition down to the rows of
    the table, before they are shuffled.  The last times before a year still come from all years,
    those before the first year of the sets as one.
    """
    first, last = (ds.parse_day(d).year for d in S_TEST)
    test_years = list(range(first, last + 1))
    p = s_prepared(spark, sf_dir, from_year=min(D_TRAIN_YEAR, first)).select(
        *S_KEYS, "year", "date", TARGET, *FEATURE_COLS)
    if shared:
        p = materialize(p.filter(F.col("year").isin(D_TRAIN_YEAR, *test_years)).filter(
            ds.train_condition(D_TRAIN_YEAR) | ds.in_window(*S_TEST)))
    train, test = ds.time_split(p, D_TRAIN_YEAR, *S_TEST)
    test = test.filter(F.col("year").isin(test_years))
    return ds.model_frame(train, keys=S_KEYS), ds.model_frame(test, keys=S_KEYS)


@query("scores_by_series", f"""
    WITH {_S_FRAMES_SQL.strip()},
    pred AS (
      SELECT 'persistence' AS model, l_suppkey, label, mean_rr_lag1 AS prediction FROM test
      UNION ALL SELECT 'mean3', l_suppkey, label,
                       (mean_rr_lag1 + mean_rr_lag2 + mean_rr_lag3) / 3.0 FROM test)
    SELECT model, l_suppkey, {_SCORE_SQL} FROM pred GROUP BY model, l_suppkey""")
def q_scores_by_series(spark, sf_dir):
    """A8-A10 per model and supplier in one aggregate."""
    _, test = s_frames(spark, sf_dir, shared=False)
    wide = test.withColumn("mean3", (F.col("mean_rr_lag1") + F.col("mean_rr_lag2")
                                     + F.col("mean_rr_lag3")) / 3.0)
    pred = ev.stack_predictions(wide, {"persistence": "mean_rr_lag1", "mean3": "mean3"}, S_KEYS)
    return finish(ev.score(pred, ["model", "l_suppkey"]))


@query("linreg_by_series", f"""
    WITH {_S_FRAMES_SQL.strip()},
    line AS (SELECT regr_slope(label, mean_rr_lag1) AS b, regr_intercept(label, mean_rr_lag1) AS a
             FROM train),
    scored AS (SELECT 'linear_regression' AS model, label, a + b * mean_rr_lag1 AS prediction
          FROM test, line)
    SELECT model, {_SCORE_SQL} FROM scored GROUP BY model""")
def q_linreg_by_series(spark, sf_dir):
    """M3 + M8 on the rows of all suppliers: one feature, so the fit has an SQL form."""
    train, test = s_frames(spark, sf_dir)
    fitted = mdl.fit_models(train, {
        "linear_regression": lambda: mdl.linear_pipeline(["mean_rr_lag1"])})
    return finish(ev.score(mdl.predict(fitted, test, S_KEYS)))


# ---------------------------------------------------------------- second-order boosting

# Fixed candidate cuts, so that SQL tries the same splits.
_LAG_EDGES = [15000.0, 30000.0, 45000.0, 60000.0]
L2_EDGES = {"max_rr": [15000.0, 25000.0, 35000.0, 45000.0, 55000.0, 65000.0],
            "std_rr": [1.0, 10000.0, 25000.0],
            "frac_rainy": [0.2, 0.4, 0.6, 0.8],
            "delta_minutes": [2160.0, 5040.0, 10080.0, 20160.0],
            "hour_sin": [-0.5, 0.5], "hour_cos": [-0.5, 0.5],
            "mean_rr_lag1": _LAG_EDGES, "mean_rr_lag2": _LAG_EDGES, "mean_rr_lag3": _LAG_EDGES}
L2_ROUNDS, L2_DEPTH, L2_ETA, L2_PENALTY = (
    mdl.BOOSTED_L2_PARAMS[k] for k in ("rounds", "depth", "eta", "l2"))


def _boosted_l2_ctes() -> str:
    """The rounds in SQL: per level all candidate splits of all nodes, the best, and the way down.

    Rows on the same side of every cut are one cell; a step of the recursion is a level.  Splits
    that are equal but for rounding are told apart by feature and cut.
    """
    feats = list(L2_EDGES)
    cuts = ", ".join(f"({i}, {e})" for i, c in enumerate(feats) for e in L2_EDGES[c])
    cell = ", ".join(f"CASE WHEN {c} < {e} THEN 1 ELSE 0 END" for c in feats for e in L2_EDGES[c])
    value = "CASE f " + " ".join(f"WHEN {i} THEN {c}" for i, c in enumerate(feats)) + " END"
    last = f"step % {L2_DEPTH} = 0"
    return f"""
    celled AS (SELECT *, [{cell}] AS cell FROM frame),
    base AS (SELECT avg(label) AS mean FROM frame WHERE train),
    cells AS MATERIALIZED (
      SELECT cell, row_number() OVER (ORDER BY cell) AS id, count(CASE WHEN train THEN 1 END) AS n,
             sum(CASE WHEN train THEN label END) AS y, {', '.join(f'min({c}) AS {c}' for c in feats)}
      FROM celled GROUP BY cell),
    cuts(f, cut) AS (VALUES {cuts}),
    sides AS MATERIALIZED (SELECT id, n, f, cut, {value} < cut AS below FROM cells, cuts),
    walk(step, id, node, off, margin) USING KEY (id) AS (
      SELECT 0, id, 0, CASE WHEN n > 0 THEN mean - y / n ELSE 0 END, mean FROM cells, base
      UNION ALL
      (WITH tried AS (
        SELECT node, f, cut, sum(n * off) AS g, sum(n) AS h,
               sum(CASE WHEN below THEN n * off ELSE 0 END) AS gl,
               sum(CASE WHEN below THEN n ELSE 0 END) AS hl
        FROM walk JOIN sides USING (id) GROUP BY node, f, cut),
      gained AS (
        SELECT *, max(score) OVER (PARTITION BY node) AS top, g * g / (h + {L2_PENALTY}) AS whole
        FROM (SELECT *, CASE WHEN hl > 0 AND hl < h THEN
                gl * gl / (hl + {L2_PENALTY}) + (g - gl) * (g - gl) / (h - hl + {L2_PENALTY}) END AS score
              FROM tried)),
      best AS (
        SELECT node, any_value(g) AS g, any_value(h) AS h,
               arg_min({{'f': f, 'cut': cut, 'gl': gl, 'hl': hl}}, (f, cut)) FILTER (
                 WHERE score >= top * (1 - 1e-12) AND score - whole > 1e-9) AS b
        FROM gained GROUP BY node),
      moved AS (
        SELECT step + 1 AS step, w.id, w.node, w.off, w.margin, b.b IS NULL OR below AS goes_left,
               CASE WHEN b.h = 0 THEN 0
                    WHEN b.b IS NULL THEN -b.g / (b.h + {L2_PENALTY})
                    WHEN below THEN -b.b.gl / (b.b.hl + {L2_PENALTY})
                    ELSE -(b.g - b.b.gl) / (b.h - b.b.hl + {L2_PENALTY}) END AS leaf
        FROM walk w JOIN best b ON w.node = b.node
        LEFT JOIN sides s ON s.id = w.id AND s.f = b.b.f AND s.cut = b.b.cut
        WHERE step < {L2_ROUNDS * L2_DEPTH})
      SELECT step, id, CASE WHEN {last} THEN 0 WHEN goes_left THEN 2 * node + 1 ELSE 2 * node + 2 END,
             CASE WHEN {last} THEN off + {L2_ETA} * leaf ELSE off END,
             CASE WHEN {last} THEN margin + {L2_ETA} * leaf ELSE margin END
      FROM moved))"""


@query("boosted_l2", f"""
    WITH RECURSIVE {S_PREPARED_CTE.strip()},
    frame AS (
      SELECT l_suppkey, timestamp, mean_rr AS label, {', '.join(L2_EDGES)},
             year = {D_TRAIN_YEAR} AS train
      FROM p WHERE year IN ({D_TRAIN_YEAR}, 2001) AND {_COMPLETE_SQL}),
    {_boosted_l2_ctes().strip()},
    scored AS (SELECT 'boosted_trees' AS model, label, margin AS prediction
               FROM celled JOIN cells USING (cell) JOIN walk USING (id) WHERE NOT train)
    SELECT model, {_SCORE_SQL} FROM scored GROUP BY model""")
def q_boosted_l2(spark, sf_dir):
    """M6: second-order boosting with an L2 penalty on the rows of all suppliers (fixed cuts).

    The published rounds, depth, step and penalty on all features; every tree takes every row
    and feature, for SQL draws no such samples.
    """
    train, test = s_frames(spark, sf_dir)
    feats = list(L2_EDGES)
    fitted = mdl.fit_models(train, {"boosted_trees": lambda: mdl.boosted_l2_pipeline(
        feats, rounds=L2_ROUNDS, depth=L2_DEPTH, eta=L2_ETA, l2=L2_PENALTY, subsample=1.0,
        colsample=1.0, edges=[L2_EDGES[c] for c in feats])})
    return finish(ev.score(mdl.predict(fitted, test, S_KEYS)))


# ================================================================ the four jobs, end to end

@query("job_choose_files", f"""
    WITH {_NEAREST_SQL.strip()},
    held AS (SELECT name FROM lf WHERE event_type IN ('view', 'click'))
    SELECT day, url, name FROM chosen c
    WHERE day BETWEEN DATE '{LISTING_RANGE[0]}' AND DATE '{LISTING_RANGE[1]}'
      AND NOT EXISTS (SELECT 1 FROM held h WHERE h.name = c.name)""")
def q_job_choose_files(spark, sf_dir):
    """Step 1 (J1, J2, S2): the urls to fetch for a range of days."""
    from scenecast.plans.ingest import choose_files
    held = ls.held_names(held_listing(spark, sf_dir))
    fetch, _ = choose_files(spark, listing(spark, sf_dir), held, *LISTING_RANGE)
    return finish(fetch.select("day", "url", "name"))


@query("read_listing", """
    SELECT CAST(ts AS DATE) AS day, true AS held FROM events GROUP BY 1""")
def q_read_listing(spark, sf_dir):
    """Events written as text files per day folder, then listed by metadata only."""
    e = table(spark, sf_dir, "events")
    root = shared_dir(spark, "listing")
    (e.select(F.date_format("ts", "yyyy-MM-dd").alias("day"),
              F.col("event_id").cast("string").alias("value"))
     .write.partitionBy("day").text(root))
    files = ls.read_listing(spark, root, "*.txt").filter(F.col("length") > 0)
    day = F.to_date(F.regexp_extract("url", r"/day=(\d{4}-\d{2}-\d{2})/", 1))
    names = ls.held_names(files).withColumn("held", F.lit(True))
    named = files.select(day.alias("day"), F.element_at(F.split("url", "/"), -1).alias("name"))
    return named.join(names, "name").select("day", "held").distinct()


@query("job_ingest", f"""
    WITH {_G_CELLS_SQL.strip()},
    ok AS (SELECT * FROM stats WHERE n_finite > 0)
    SELECT file, {r('mean_rr')}, {r('max_rr')}, {r('std_rr')}, {r('frac_rainy')},
           year(timestamp) AS year, month(timestamp) AS month, day(timestamp) AS day,
           hour(timestamp) AS hour, epoch_ms(timestamp) AS timestamp_ms,
           strftime(timestamp, '%Y-%m-%d %H:%M:%S') AS timestamp_str,
           CAST(coalesce((epoch_ms(timestamp) - epoch_ms(lag(timestamp) OVER (
                ORDER BY timestamp, file))) / 60000.0, 0) AS FLOAT) AS delta_minutes,
           (SELECT count(*) FROM ok) AS report_rows
    FROM ok""")
def q_job_ingest(spark, sf_dir):
    """Step 2 (P9-P16, W2, S6, S7, A6): scenes to the feature table at rest, with its report."""
    from scenecast.plans.ingest import ingest
    from scenecast.sources import tables
    path, report = ingest(spark, g_scenes(spark, sf_dir), shared_dir(spark, "ingested"), G_WINDOW)
    rows = report.select("rows").scalar()
    return finish(tables.read_features(spark, path).withColumn("report_rows", rows))


_H_LAG1_SQL = f"""
    {H_PREPARED_CTE.strip()},
    test AS (SELECT timestamp, mean_rr AS label, mean_rr_lag1 FROM p
      WHERE date BETWEEN DATE '{H_TEST[0]}' AND DATE '{H_TEST[1]}' AND mean_rr_lag1 IS NOT NULL),
    train AS (SELECT mean_rr AS label, mean_rr_lag1 FROM p
      WHERE year = {H_TRAIN_YEAR} AND date < DATE '{H_TRAIN_UNTIL}' AND mean_rr_lag1 IS NOT NULL),
    line AS (SELECT regr_slope(label, mean_rr_lag1) AS b, regr_intercept(label, mean_rr_lag1) AS a
             FROM train),
    scored AS (SELECT 'linear_regression' AS model, timestamp, label,
                      a + b * mean_rr_lag1 AS prediction FROM test, line)"""


@query("job_train_backtest", f"""
    WITH {_H_LAG1_SQL.strip()},
    sc AS (SELECT model, {_SCORE_SQL} FROM scored GROUP BY model)
    SELECT model, n, rmse, r2, 1 AS rank, n AS written_predictions,
           (SELECT count(*) FROM train) AS train_rows FROM sc""")
def q_job_train_backtest(spark, sf_dir):
    """Steps 3 and 4: fit, score and save a run, reload it, score the window again, write the
    report and read the comparison and the predictions back."""
    from scenecast.plans.backtest import backtest, write_report
    from scenecast.plans.train import train_run
    features = materialize(h_features(spark, sf_dir))
    cols = ["mean_rr_lag1"]
    run = train_run(spark, features, shared_dir(spark, "job-runs"), H_TRAIN_YEAR, *H_TEST,
                    feature_cols=cols, train_until=H_TRAIN_UNTIL,
                    specs={"linear_regression": lambda: mdl.linear_pipeline(cols)})
    report = backtest(spark, features, run.run_dir, *H_TEST, feature_cols=cols)
    base = write_report(spark, report, shared_dir(spark, "job-report"), run.run_dir, *H_TEST)
    for name in ("predictions", "window"):
        report[name].unpersist()
    written = spark.read.option("header", True).csv(f"{base}/predictions").groupBy("model").agg(
        F.count(F.lit(1)).alias("written_predictions"))
    trained = run.counts.filter("split = 'train'").select("rows_complete").scalar()
    return finish(spark.read.parquet(f"{base}/comparison").join(written, "model")
                  .withColumn("train_rows", trained))


# ================================================================ loads, runs, tiles, fits per series

@query("feature_store_loads", f"""
    WITH {S_PREPARED_CTE.strip()}
    SELECT l_suppkey, {FEATURE_OUT_SQL}, {r('mean_rr_lag1')}, {r('mean_rr_lag2')},
           {r('mean_rr_lag3')}
    FROM p""")
def q_feature_store_loads(spark, sf_dir):
    """S6 + W1 + W2: a first load, a late month and a newer stretch give the table of one load."""
    from scenecast.sources import feature_store as fs
    stats = (series.supplier_stats(table(spark, sf_dir, "lineitem"))
             .filter("n_valid > 0").drop("n_valid"))
    t = F.col("timestamp")
    late = F.date_trunc("month", t) == F.lit("1998-03-01").cast("timestamp_ntz")
    newer = t >= F.lit("2001-06-10").cast("timestamp_ntz")
    path = shared_dir(spark, "feature-store")
    for part in (stats.filter(~late & ~newer), stats.filter(late), stats.filter(newer)):
        fs.load_features(spark, path, part, ["l_suppkey"])
    out = fs.read_store(spark, path, [stats.schema["l_suppkey"]])
    return finish(out.select("l_suppkey", *ds.FEATURE_TABLE_COLS, *fs.lag_names()))


@query("run_history", f"""
    WITH {_H_FRAMES_SQL.strip()},
    parts AS (SELECT model, CASE WHEN timestamp < TIMESTAMP '2024-01-28' THEN '20240128_000000'
                             ELSE '20240201_000000' END AS run_id, label, prediction FROM pred),
    sc AS (SELECT model, run_id, {_SCORE_SQL} FROM parts GROUP BY model, run_id),
    h AS (SELECT model, run_id, rmse, r2, lag(rmse) OVER w AS before FROM sc
          WINDOW w AS (PARTITION BY model ORDER BY run_id))
    SELECT model, run_id, rmse, r2, round(rmse - before, 5) AS rmse_change,
           coalesce(rmse < before, true) AS best,
           run_id = (SELECT max(run_id) FROM h) AS latest
    FROM h""")
def q_run_history(spark, sf_dir):
    """S10, S11 + T6 on the runs table: two runs appended, their scores compared, the latest found."""
    from scenecast.sources import runs, store
    pred = materialize(h_persistence(spark, sf_dir))
    root, cut = shared_dir(spark, "run-table"), F.lit("2024-01-28").cast("timestamp_ntz")
    for run_id, part in (("20240201_000000", pred.filter(F.col("timestamp") >= cut)),
                         ("20240128_000000", pred.filter(F.col("timestamp") < cut))):
        runs.append_run(store.run_record(run_id, H_TRAIN_YEAR, *H_TEST, ["mean_rr_lag1"],
                                         ev.score(part)), root)
    table_ = runs.read_runs(spark, root)
    latest = runs.latest_run(table_).select("run_id").scalar()
    out = finish(runs.score_history(table_))
    return out.withColumns({"rmse_change": round_decimal(F.col("rmse_change"), 5),
                            "latest": F.col("run_id") == latest})


@query("scene_stats_tiles", f"WITH {_G_CELLS_SQL.strip()} {_G_STATS_OUT}")
def q_scene_stats_tiles(spark, sf_dir):
    """S5, P9, A5 on tiled scenes: tiles outside the crop are not read, states are merged."""
    from scenecast.operators import tiles
    path = tiles.write_tiles(tiles.tiles_from_arrays(g_scenes(spark, sf_dir), 2),
                             shared_dir(spark, "tiles"))
    return finish(tiles.scene_stats_tiles(tiles.read_tiles(spark, path), G_WINDOW))


@query("linreg_per_series", f"""
    WITH {_S_FRAMES_SQL.replace('max_rr, mean_rr_lag1', 'mean_rr_lag1, mean_rr_lag2').strip()},
    moments AS (
      SELECT l_suppkey, count(*) AS n, var_pop(mean_rr_lag1) AS a, var_pop(mean_rr_lag2) AS b,
             covar_pop(mean_rr_lag1, mean_rr_lag2) AS c, covar_pop(mean_rr_lag1, label) AS p,
             covar_pop(mean_rr_lag2, label) AS q, avg(label) AS y, avg(mean_rr_lag1) AS m1,
             avg(mean_rr_lag2) AS m2 FROM train GROUP BY l_suppkey),
    fits AS (SELECT l_suppkey, n, y, m1, m2, (p * b - q * c) / (a * b - c * c) AS b1,
                    (q * a - p * c) / (a * b - c * c) AS b2 FROM moments),
    scored AS (
      SELECT 'linear_regression' AS model, l_suppkey, label,
             y + b1 * (mean_rr_lag1 - m1) + b2 * (mean_rr_lag2 - m2) AS prediction
      FROM test JOIN fits USING (l_suppkey)),
    sc AS (SELECT model, l_suppkey, {_SCORE_SQL} FROM scored GROUP BY model, l_suppkey)
    SELECT l_suppkey, fits.n AS train_rows, round(round(y - b1 * m1 - b2 * m2, 6), 4) AS intercept,
           round(b1, 6) AS coef_mean_rr_lag1, round(b2, 6) AS coef_mean_rr_lag2,
           sc.n AS test_rows, rmse, r2
    FROM fits LEFT JOIN sc USING (l_suppkey)""")
def q_linreg_per_series(spark, sf_dir):
    """M3 + M7: one least-squares fit per supplier, all from one aggregate, scored per supplier."""
    from scenecast.operators import series_fit as sfit
    feats, keys = ["mean_rr_lag1", "mean_rr_lag2"], ["l_suppkey"]
    train, test = s_frames(spark, sf_dir)
    fits = sfit.fit_per_series(train, feats, keys)
    scores = ev.score(sfit.predict_per_series(test, fits, feats, keys), ["model", *keys])
    out = finish(fits.withColumnRenamed("n", "train_rows").join(
        scores.drop("model").withColumnRenamed("n", "test_rows"), keys, "left"))
    return out.withColumn("intercept", round_decimal(F.col("intercept"), 4))


# ================================================================ stateful streams

@query("stream_lags", """
    WITH s AS (
      SELECT event_type, date_trunc('hour', ts) AS timestamp,
             avg(CASE WHEN NOT isnan(value) AND value >= 0 THEN value END) AS mean_rr
      FROM events GROUP BY ALL)
    SELECT event_type, timestamp, round(mean_rr, 6) AS mean_rr,
           CAST(coalesce((epoch_ms(timestamp) - epoch_ms(lag(timestamp) OVER g)) / 60000.0, 0)
                AS FLOAT) AS delta_minutes,
           round(lag(mean_rr, 1) OVER w, 6) AS mean_rr_lag1,
           round(lag(mean_rr, 2) OVER w, 6) AS mean_rr_lag2,
           round(lag(mean_rr, 3) OVER w, 6) AS mean_rr_lag3
    FROM s WINDOW g AS (PARTITION BY event_type ORDER BY timestamp),
      w AS (PARTITION BY event_type, year(timestamp) ORDER BY timestamp)""")
def q_stream_lags(spark, sf_dir):
    """X2 + W1 + W2: hourly rows per event type arrive in three parts; the stream is restarted
    for each and carries every series' last rows over."""
    from scenecast.streaming import stateful
    rows = materialize(series.series_stats(
        table(spark, sf_dir, "events"), "ts", "value", "hour", "H", series.H_THRESHOLD,
        ["event_type"]).select("event_type", "file", "timestamp",
                               F.year("timestamp").alias("year"), "mean_rr"))
    src, sink, state, ck = (shared_dir(spark, n) for n in ("lag-rows", "lag-sink", "lag-state",
                                                           "lag-ckpt"))
    t = F.col("timestamp")
    first, second = (F.lit(d).cast("timestamp_ntz") for d in ("2024-01-10", "2024-01-20 13:00:00"))
    for part in (t < first, (t >= first) & (t < second), t >= second):
        rows.filter(part).write.mode("append").parquet(src)
        stateful.lag_stream(spark, src, rows.schema, sink, state, ck,
                            ["event_type"]).awaitTermination()
    out = spark.read.parquet(sink)
    return finish(out.select("event_type", "timestamp", "mean_rr", "delta_minutes",
                             "mean_rr_lag1", "mean_rr_lag2", "mean_rr_lag3"))


@query("stream_long_scenes", f"WITH {_G_CELLS_SQL.strip()} {_G_STATS_OUT}")
def q_stream_long_scenes(spark, sf_dir):
    """X1 + A5: pixels of a scene arrive in two files, four bands of scenes one after the other;
    a scene is emitted once the watermark has passed it."""
    from scenecast.streaming import stateful
    g = table(spark, sf_dir, "embeddings")
    low, high = g.agg(F.min("vec_id"), F.max("vec_id")).first()
    width = (high - low) // 4 + 1
    pixels = sc.long_from_arrays(series.grid_scenes(g))
    vec = F.col("scene_id").cast("long")
    # a scene's even cells come with its band, the odd ones with the next band
    part = F.floor((vec - low) / width) + F.pmod(F.col("y") + F.col("x"), F.lit(2))
    timed = materialize(pixels.withColumn("timestamp", series.grid_time(vec))
                        .withColumn("part", part.cast("int")))
    # a last scene far ahead moves the watermark past all others and stays open
    end = (spark.range(1).select(F.lit("end").alias("scene_id"), F.lit(5).alias("part"), F.lit(
        "2999-01-01 00:00:00").cast("timestamp_ntz").alias("timestamp"),
        *[F.lit(v).alias(c) for c, v in (("y", 4), ("x", 4), ("ny", 8), ("nx", 8))]))
    arriving = timed.unionByName(end, allowMissingColumns=True)
    src, sink, ck = (shared_dir(spark, n) for n in ("pixel-files", "scene-sink", "pixel-ckpt"))
    for i in range(6):
        arriving.filter(F.col("part") == i).drop("part").write.mode("append").parquet(src)
        stateful.ingest_long_scenes(
            spark, src, arriving.drop("part").schema, sink, ck, G_WINDOW,
            delay=f"{2 * width * series.G_STEP_MINUTES} minutes").awaitTermination()
    out = stateful.finished_scenes(spark.read.parquet(sink))
    return finish(out.select("scene_id", "file", "timestamp", "n_pixels", "n_valid", "n_finite",
                             "mean_rr", "max_rr", "std_rr", "frac_rainy", "reject_reason"))
