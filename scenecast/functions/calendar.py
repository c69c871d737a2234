"""Calendar, epoch and cyclic time columns.

Times are handled as ``timestamp_ntz`` (wall-clock, no zone) so that results
do not depend on the session time zone; epoch values are taken as UTC.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Text formats of the feature table and the report labels.
TIME_TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss"
SHORT_LABEL_FORMAT = "MM-dd HH:mm"


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def epoch_millis(ts) -> Column:
    """UTC epoch milliseconds of a wall-clock time."""
    return F.timestamp_diff("MILLISECOND", _epoch(), _c(ts).cast("timestamp_ntz"))


def epoch_micros(ts) -> Column:
    return F.timestamp_diff("MICROSECOND", _epoch(), _c(ts).cast("timestamp_ntz"))


def time_text(ts) -> Column:
    """``yyyy-MM-dd HH:mm:ss``."""
    return F.date_format(_c(ts), TIME_TEXT_FORMAT)


def short_label(ts) -> Column:
    """P25: ``MM-dd HH:mm``."""
    return F.date_format(_c(ts), SHORT_LABEL_FORMAT)


def parse_time_text(text) -> Column:
    """Text -> timestamp_ntz; malformed text gives null instead of an error."""
    return F.try_to_timestamp(_c(text), F.lit(TIME_TEXT_FORMAT)).cast("timestamp_ntz")


def add_calendar(df: DataFrame, ts: str = "timestamp", year: str | None = None) -> DataFrame:
    """Year, month, day, hour, timestamp_ms, timestamp_str.

    ``year``: the column that holds the year already; rows shuffled by it stay so.
    """
    t = F.col(ts)
    return df.withColumns({
        "year": F.col(year) if year else F.year(t),
        "month": F.month(t),
        "day": F.dayofmonth(t),
        "hour": F.hour(t),
        "timestamp_ms": epoch_millis(t),
        "timestamp_str": time_text(t),
    })


def add_cyclical(df: DataFrame, col: str = "hour", period: float = 24.0,
                 prefix: str | None = None, cast_double: bool = True) -> DataFrame:
    """``sin(2*pi*x/period)`` and ``cos(...)``; x re-cast to double."""
    prefix = prefix or col
    x = F.col(col).cast("double")
    angle = F.lit(2.0 * math.pi) * x / F.lit(float(period))
    out = {f"{prefix}_sin": F.sin(angle), f"{prefix}_cos": F.cos(angle)}
    if cast_double:
        out = {col: x, **out}
    return df.withColumns(out)


def prepare_times(df: DataFrame, text_col: str = "timestamp_str") -> DataFrame:
    """P17 + P18: rebuild ``timestamp`` and ``date`` from text, add cyclic hour."""
    df = df.withColumn("timestamp", parse_time_text(text_col))
    df = df.withColumn("date", F.to_date(F.col("timestamp")))
    return add_cyclical(df, "hour", 24.0)
