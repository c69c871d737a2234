"""Aggregate expressions for scores and statistics.

They are plain aggregate Columns, so many of them can share one
``groupBy().agg(...)`` pass with map-side partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def rmse(label="label", prediction="prediction") -> Column:
    """sqrt(mean((p - l)^2)); null on an empty group."""
    d = _c(prediction) - _c(label)
    return F.sqrt(F.avg(d * d))


def r2(label="label", prediction="prediction") -> Column:
    """1 - SSE / SST about the label mean.

    SST is computed as n * var_pop(label), the numerically stable form of
    sum(l^2) - sum(l)^2/n.  A constant label gives SST = 0 and a null result
    (the MLlib evaluator would divide by zero).
    """
    d = _c(prediction) - _c(label)
    sse = F.sum(d * d)
    sst = F.count(_c(label)) * F.var_pop(_c(label))
    return F.lit(1.0) - F.try_divide(sse, F.when(sst != 0, sst))


def pearson(a, b) -> Column:
    """Pearson correlation over rows where both are neither null nor NaN.

    ``corr`` raises divide-by-zero under ANSI mode on a constant column; this
    form returns null there instead.
    """
    a, b = _c(a), _c(b)
    both = (a.isNotNull() & b.isNotNull() & ~F.isnan(a.cast("double"))
            & ~F.isnan(b.cast("double")))
    a2, b2 = F.when(both, a), F.when(both, b)
    den = F.stddev_pop(a2) * F.stddev_pop(b2)
    return F.try_divide(F.covar_pop(a2, b2), F.when(den != 0, den))


def frac_above(value, threshold: float = 0.0) -> Column:
    """A4: share of *all* pixels above the threshold; null pixels count as dry."""
    return F.avg(F.when(_c(value) > F.lit(threshold), F.lit(1.0)).otherwise(F.lit(0.0)))
