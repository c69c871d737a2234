"""One least-squares fit per series (M3 + M7), without bringing a series to one task.

One aggregate per series gives the means and all covariances (algebraic, so they combine before
the shuffle and a series with a third of all rows is one small row per task).  The normal
equations are solved inside the row by a Cholesky factorisation written out as columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEPENDENT = 1e-10     # a feature whose variance beyond the ones before is below this share is left out


def fit_per_series(frame: DataFrame, features: list[str], series_cols: list[str],
                   label: str = "label") -> DataFrame:
    """(series, n, intercept, one column ``coef_<feature>`` each): least squares per series.

    Features that are constant, or follow from the ones before them, get the coefficient 0.  Rows
    with a missing value take no part.
    """
    p = len(features)
    clean = frame.select(*series_cols, *[F.col(c).cast("double").alias(f"__x{i}")
                                         for i, c in enumerate([*features, label])])
    whole = F.lit(True)
    for i in range(p + 1):
        whole = whole & F.col(f"__x{i}").isNotNull() & ~F.isnan(f"__x{i}")
    aggs = [F.count(F.lit(1)).alias("n")]
    aggs += [F.avg(f"__x{i}").alias(f"__m{i}") for i in range(p + 1)]
    aggs += [F.covar_pop(f"__x{i}", f"__x{j}").alias(f"__c{i}_{j}")
             for i in range(p + 1) for j in range(min(i, p - 1) + 1)]
    out = clean.filter(whole).groupBy(*series_cols).agg(*aggs)

    def total(terms: list[Column]) -> Column:
        acc = F.lit(0.0)
        for t in terms:
            acc = acc + t
        return acc

    # columns of the factor L from left to right; the label's row gives L^-1 (X'y)
    for j in range(p):
        left = F.col(f"__c{j}_{j}") - total([F.col(f"__l{j}_{k}") ** 2 for k in range(j)])
        out = out.withColumn(f"__l{j}_{j}", F.when(
            left > DEPENDENT * F.col(f"__c{j}_{j}"), F.sqrt(left)))
        out = out.withColumns({f"__l{i}_{j}": F.coalesce(
            (F.col(f"__c{i}_{j}") - total([F.col(f"__l{i}_{k}") * F.col(f"__l{j}_{k}")
                                           for k in range(j)])) / F.col(f"__l{j}_{j}"), F.lit(0.0))
            for i in range(j + 1, p + 1)})
    for j in reversed(range(p)):
        out = out.withColumn(f"__b{j}", F.coalesce(
            (F.col(f"__l{p}_{j}") - total([F.col(f"__l{i}_{j}") * F.col(f"__b{i}")
                                           for i in range(j + 1, p)])) / F.col(f"__l{j}_{j}"),
            F.lit(0.0)))
    level = F.col(f"__m{p}") - total([F.col(f"__b{j}") * F.col(f"__m{j}") for j in range(p)])
    return out.select(*series_cols, "n", level.alias("intercept"),
                      *[F.col(f"__b{j}").alias(f"coef_{c}") for j, c in enumerate(features)])


def predict_per_series(frame: DataFrame, fits: DataFrame, features: list[str],
                       series_cols: list[str], model: str = "linear_regression") -> DataFrame:
    """Rows of ``frame`` with the prediction of their series' fit; series without a fit give none."""
    named = fits.select(*[F.col(c).alias(f"__s_{c}") for c in series_cols], "intercept",
                        *[F.col(f"coef_{c}").alias(f"__b_{c}") for c in features])
    on = [frame[c].eqNullSafe(named[f"__s_{c}"]) for c in series_cols]
    value = F.col("intercept")
    for c in features:
        value = value + F.col(f"__b_{c}") * F.col(c)
    return (frame.join(named, on).withColumns({"model": F.lit(model), "prediction": value})
            .drop("intercept", *[f"__s_{c}" for c in series_cols], *[f"__b_{c}" for c in features]))
