"""Report tables behind every picture of the reference (P24, P25, A11-A14,
T1-T4, J4, M13).

The reference collects up to 50,000 rows per model to pandas and draws.
Here each picture's data is an aggregate computed on the executors, so only
small, bounded tables ever reach the driver.
"""

from __future__ import annotations

import math

from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scenecast.functions.calendar import short_label

# Fixed values of the reference reports.
RESIDUAL_BINS = 40
TARGET_BINS = 60
TOP_ERRORS = 20

DOUBTFUL = 1e-6       # share of a pair's squares below which its variance is taken again
PAIRS_AT_ONCE = 16    # doubtful pairs of one aggregate


def with_errors(pred: DataFrame, label: str = "label",
                prediction: str = "prediction") -> DataFrame:
    """``error = prediction - label`` and ``abs_error``."""
    err = F.col(prediction) - F.col(label)
    return pred.withColumns({"error": err, "abs_error": F.abs(err)})


def _join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner"
                    ) -> DataFrame:
    """Equi-join on ``keys`` in which null equals null; the left side's keys stay."""
    names = {k: f"__r_{k}" for k in keys}
    right = right.withColumnsRenamed(names)
    return left.join(right, [left[k].eqNullSafe(right[n]) for k, n in names.items()],
                     how).drop(*names.values())


def histogram(df: DataFrame, col: str, bins: int, group_cols: list[str] | None = None
              ) -> DataFrame:
    """Equal-width histogram over [min, max], last bin closed.

    Empty bins are kept (count 0).  When min = max the range is widened by
    0.5 each side, as NumPy does.  Two passes: one tiny aggregate for the
    range, one ``groupBy(bin)`` with map-side combine (grouped ranges are joined to the rows); the bin index is
    ``least(floor((x - lo) / (hi - lo) * bins) + 1, bins)``.
    """
    group_cols = group_cols or []
    x = F.col(col).cast("double")
    vals = df.select(*group_cols, x.alias("__x")).filter(
        F.col("__x").isNotNull() & ~F.isnan("__x"))
    rng = vals.groupBy(*group_cols).agg(F.min("__x").alias("__mn"), F.max("__x").alias("__mx"))
    rng = rng.select(*group_cols,
                     F.when(F.col("__mn") == F.col("__mx"), F.col("__mn") - 0.5)
                     .otherwise(F.col("__mn")).alias("lo"),
                     F.when(F.col("__mn") == F.col("__mx"), F.col("__mx") + 0.5)
                     .otherwise(F.col("__mx")).alias("hi"))
    idx = F.least(F.floor((F.col("__x") - F.col("lo")) / (F.col("hi") - F.col("lo"))
                          * F.lit(float(bins))) + 1, F.lit(bins)).cast("long")
    seq = F.explode(F.sequence(F.lit(1).cast("long"), F.lit(bins).cast("long"))).alias("bin")
    if group_cols:
        # one range a group: a plain join that adaptive execution broadcasts or splits
        with_rng = _join_null_safe(vals, rng, group_cols)
        all_bins = rng.select(*group_cols, "lo", "hi", seq)
    else:
        # one global range: a scalar subquery evaluated once, no join at all;
        # the bin list reuses the same subquery
        b = rng.select(F.struct("lo", "hi").alias("b")).scalar()
        lo_hi = {"lo": b.getField("lo"), "hi": b.getField("hi")}
        with_rng = vals.withColumns(lo_hi)
        all_bins = df.sparkSession.range(1).select(seq).withColumns(lo_hi)
    counts = with_rng.groupBy(*group_cols, idx.alias("bin")).agg(
        F.count(F.lit(1)).alias("count"))
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    return (_join_null_safe(all_bins, counts, group_cols + ["bin"], "left")
            .select(*group_cols, "bin",
                    (F.col("lo") + (F.col("bin") - 1) * width).alias("bin_lo"),
                    (F.col("lo") + F.col("bin") * width).alias("bin_hi"),
                    F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count")))


def correlation(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson matrix in long form ``(f1, f2, corr)``, all ordered pairs.

    Pairwise complete, null and NaN being missing.  Every row is one vector of its
    shifted values, their squares and presence flags; MLlib sums the outer products of
    those vectors per task and merges them as a tree, which holds every moment of every
    pair: one pass, no expansion of rows, one small matrix per task.  The shift is each
    column's mean over all rows, from an aggregate before.  Pairs whose rows lie far from it
    against their spread are taken again by ``covar_pop``.  A column that is constant over a
    pair's rows (min = max) gives null, as does a pair without rows.
    """
    p = len(cols)
    x = [F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias(f"x{i}")
         for i, c in enumerate(cols)]
    base = df.select(*x)
    ranges = base.agg(*[f(f"x{i}") for f in (F.avg, F.min, F.max) for i in range(p)]).first()
    shift = [v if v is not None and math.isfinite(v) else 0.0 for v in ranges[:p]]
    constant = [a == b for a, b in zip(ranges[p:2 * p], ranges[2 * p:])]
    z = [F.coalesce(F.col(f"x{i}") - F.lit(shift[i]), F.lit(0.0)) for i in range(p)]
    flags = [F.col(f"x{i}").isNotNull().cast("double") for i in range(p)]
    rows = base.select(array_to_vector(F.array(*z, *[v * v for v in z], *flags)).alias("v"))
    # a row of zeros adds nothing and gives an empty frame its zero sums
    nothing = df.sparkSession.range(1).select(array_to_vector(
        F.array_repeat(F.lit(0.0), 3 * p)).alias("v"))
    rows = MLUtils.convertVectorColumnsFromML(rows.union(nothing), "v")
    g = RowMatrix(rows, 0, 3 * p).computeGramianMatrix().toArray()

    def moments(i: int, j: int) -> tuple[float, float, bool]:
        # sum and squared deviations of column i over the pair's rows, and whether they are exact
        n, total, squares = g[2 * p + i, 2 * p + j], g[i, 2 * p + j], g[p + i, 2 * p + j]
        dev = squares - total * total / n
        return total, dev, not dev <= DOUBTFUL * squares

    corr: dict[tuple[int, int], float | None] = {}
    doubtful = []
    for i in range(p):
        for j in range(i, p):
            n = g[2 * p + i, 2 * p + j]
            corr[i, j] = None
            if not n or constant[i] or constant[j]:
                continue
            (si, vi, fine_i), (sj, vj, fine_j) = moments(i, j), moments(j, i)
            if fine_i and fine_j:
                corr[i, j] = float((g[i, j] - si * sj / n) / (vi * vj) ** 0.5)
            else:
                doubtful.append((i, j))
    for a in range(0, len(doubtful), PAIRS_AT_ONCE):
        some = doubtful[a:a + PAIRS_AT_ONCE]
        found = base.agg(*[v for i, j in some for v in _pair(F.col(f"x{i}"), F.col(f"x{j}"))]
                         ).first()
        for k, pair in enumerate(some):
            varies, cov, vi, vj = found[4 * k:4 * k + 4]
            corr[pair] = cov / (vi ** 0.5 * vj ** 0.5) if varies and vi and vj else None
    out = [(cols[i], cols[j], corr[min(i, j), max(i, j)]) for i in range(p) for j in range(p)]
    return df.sparkSession.createDataFrame(out, "f1 string, f2 string, corr double")


def _pair(a: Column, b: Column) -> list[Column]:
    """Whether both columns vary over the rows that hold both, their covariance and variances."""
    x, y = F.when(b.isNotNull(), a), F.when(a.isNotNull(), b)
    return [(F.min(x) < F.max(x)) & (F.min(y) < F.max(y)), F.covar_pop(a, b), F.var_pop(x),
            F.var_pop(y)]


def value_range(df: DataFrame, a: str = "label", b: str = "prediction",
                group_cols: list[str] | None = None) -> DataFrame:
    """Common [min, max] of two columns (the y = x line of a scatter)."""
    group_cols = group_cols or []
    return df.groupBy(*group_cols).agg(
        F.least(F.min(a), F.min(b)).alias("range_min"),
        F.greatest(F.max(a), F.max(b)).alias("range_max"))


def top_n(df: DataFrame, order: list[Column], n: int,
          group_cols: list[str] | None = None) -> DataFrame:
    """First ``n`` rows by ``order`` overall or per group.

    Overall: ``orderBy().limit()`` = TakeOrderedAndProject (per-task top-n,
    then a merge of n rows per task).  Per group: ``row_number() <= n``,
    which Spark plans with a partial WindowGroupLimit before the shuffle, so
    a group holding most rows still ships at most n rows per task.
    """
    if not group_cols:
        return df.orderBy(*order).limit(n)
    w = Window.partitionBy(*group_cols).orderBy(*order)
    return (df.withColumn("rank", F.row_number().over(w))
            .filter(F.col("rank") <= n))


def top_errors(pred: DataFrame, n: int = TOP_ERRORS, group_cols: list[str] | None = None,
               ts: str = "timestamp") -> DataFrame:
    """T2 + P24 + P25: largest absolute errors (ties: earlier time first)."""
    e = with_errors(pred).withColumn("time_label", short_label(F.col(ts)))
    return top_n(e, [F.col("abs_error").desc(), F.col(ts).asc()], n, group_cols)


def overlay(pred_long: DataFrame, models: list[str], ts: str = "timestamp") -> DataFrame:
    """One row per time with the label and one prediction column per model.

    Conditional aggregation over the long table (what ``pivot`` plans), with
    the label taken from the first model as the reference does.
    """
    first = models[0]
    aggs = [F.max(F.when(F.col("model") == first, F.col("label"))).alias("label")]
    aggs += [F.max(F.when(F.col("model") == m, F.col("prediction"))).alias(m) for m in models]
    return pred_long.groupBy(ts).agg(*aggs)


def prediction_series(pred: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Per model, the series of label, prediction and errors over time."""
    return with_errors(pred).withColumn("time_label", short_label(F.col(ts)))
