"""Column expressions over file names and urls.

All of them are built-in Spark expressions, so they run inside whole-stage
codegen on the executors; no Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two file-name time patterns and the listing path pattern.
#   style 1: "_s" followed by 14 digits yyyyMMddHHmmss (extra digits ignored)
#   style 2: "_" yyyy ddd "_" HHmm "_" (day of year, no range check on ddd)
#   listing: ".../HHmm/<name>.nc" at the end of the url
NAME_S_PATTERN = r"_s(\d{14})"
NAME_DOY_PATTERN = r"_(\d{4})(\d{3})_(\d{2})(\d{2})_"
URL_HHMM_SEGMENT = r"/(\d{4})/[^/]+\.nc$"
# a day's listing holds every file below the day, whatever its next path part is called
URL_DAY_SEGMENT = r"/(\d{4}/\d{2}/\d{2})/[^/]+/[^/]+\.nc$"

# Python's datetime range; a parsed time outside it is invalid.
_MIN_YEAR, _MAX_YEAR = 1, 9999


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def basename(path) -> Column:
    """Text after the last '/' (P6)."""
    return F.element_at(F.split(_c(path), "/"), -1)


def _group(s: Column, pattern: str, idx: int) -> Column:
    return F.regexp_extract(s, pattern, idx)


def timestamp_style_s(name) -> Column:
    """Time from ``_sYYYYMMDDHHMMSS``; null when absent or invalid.

    One regex evaluation: the 14 digits are extracted once and sliced at
    fixed positions; an empty match means the pattern is absent.
    """
    d = _group(_c(name), NAME_S_PATTERN, 1)
    y = F.substring(d, 1, 4).cast("int")
    sec = F.substring(d, 13, 2).cast("int")
    ts = F.try_make_timestamp_ntz(
        y, F.substring(d, 5, 2).cast("int"), F.substring(d, 7, 2).cast("int"),
        F.substring(d, 9, 2).cast("int"), F.substring(d, 11, 2).cast("int"), sec)
    # Spark reads second 60 as a leap second (next minute); the format does not
    return F.when((d != "") & (y >= _MIN_YEAR) & (sec < 60), ts)


def timestamp_style_doy(name) -> Column:
    """Time from ``_YYYYDDD_HHMM_``; day of year rolls over, bad hour -> null.

    One regex evaluation: the whole match ``_YYYYDDD_HHMM_`` is extracted and
    sliced at fixed positions.
    """
    m = _group(_c(name), NAME_DOY_PATTERN, 0)
    y = F.substring(m, 2, 4).cast("int")
    doy = F.substring(m, 6, 3).cast("int")
    hh = F.substring(m, 10, 2).cast("int")
    mm = F.substring(m, 12, 2).cast("int")
    base = F.date_add(F.make_date(y, F.lit(1), F.lit(1)), doy - 1)
    ts = F.try_make_timestamp_ntz(F.year(base), F.month(base), F.dayofmonth(base),
                                  hh, mm, F.lit(0))
    ok = (m != "") & (y >= _MIN_YEAR) & (F.year(base) >= _MIN_YEAR) & (F.year(base) <= _MAX_YEAR)
    return F.when(ok, ts)


def file_timestamp(name) -> Column:
    """Style 1 decides whenever it matches (even if it fails), else style 2."""
    s = _c(name)
    return (F.when(_group(s, NAME_S_PATTERN, 1) != "", timestamp_style_s(s))
            .otherwise(timestamp_style_doy(s)))


def minute_of_day(url) -> Column:
    """P5: HH*60 + mm of the url's ``/HHmm/`` segment (one regex, two groups)."""
    hhmm = _group(_c(url), URL_HHMM_SEGMENT, 1).try_cast("int")
    return F.floor(hhmm / 100).cast("int") * 60 + F.pmod(hhmm, F.lit(100))


def url_day(url) -> Column:
    """The ``yyyy/MM/dd`` day prefix of a listing url as a date (null if absent)."""
    return F.try_to_date(_group(_c(url), URL_DAY_SEGMENT, 1), "yyyy/MM/dd")


def day_prefix(prefix: str, day) -> Column:
    """``<prefix>/yyyy/MM/dd`` for a date column."""
    return F.concat(F.lit(prefix.rstrip("/") + "/"), F.date_format(_c(day), "yyyy/MM/dd"))
