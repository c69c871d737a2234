"""Row lags and time gaps over ordered series.

``lag(c, k) OVER (PARTITION BY year ORDER BY ts)`` puts a whole year - or,
for the global time gap, the whole table - into one task.  The two-level
form below keeps the result identical while the heavy window runs over
small time buckets:

1. bucket every row (e.g. by day); row number and in-bucket lags over
   ``(partition, bucket)`` - many small window partitions;
2. per bucket keep only its last ``k`` rows (a filter, at most k rows each)
   and aggregate them to one small ``tail`` array;
3. hand every bucket the last k rows before it by a scan of logarithmic depth: buckets
   are gathered into groups, groups into larger ones, each with its own last k rows; on the
   way down a bucket's carry is what its group was handed plus the tails of its group's
   earlier buckets.  A window holds the buckets of one group (at most ``FANOUT`` balanced
   ones, or those of a year), never all of them;
4. join that carry-in back on ``(partition, bucket)`` and read lag j of the
   row with in-bucket number ``rn <= j`` from the carry.

The joins are plain joins that adaptive execution may turn into broadcasts after
measuring a side.  Balanced buckets grow with the rows, which is what the scan is for; time
buckets grow with the time span.  Where a partition column splits the time buckets already
(years, series), one window per partition holds them.

Many series whose scenes are few within a span of time (a year) need no join: the last time
before a span joins the span's rows as one more row, see :func:`add_time_delta_spans`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scenecast.functions.calendar import epoch_micros
from scenecast.session import materialize as checkpoint_table


def _cols(xs) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def add_lags_window(df: DataFrame, value_cols: list[str], n_lags: int,
                    partition_by: list[str], order_by: list[str],
                    suffix: str = "_lag{k}") -> DataFrame:
    """W1 as a single window (collapses into one Window node)."""
    w = Window.partitionBy(*_cols(partition_by)).orderBy(*_cols(order_by))
    out = {}
    for c in value_cols:
        for k in range(1, n_lags + 1):
            out[c + suffix.format(k=k)] = F.lag(F.col(c), k).over(w)
    return df.withColumns(out)


def add_lags_two_level(df: DataFrame, value_cols: list[str], n_lags: int,
                       partition_by: list[str], order_by: list[str], bucket: Column,
                       suffix: str = "_lag{k}", materialize: bool = False,
                       coarser: list[Column] | None = None) -> DataFrame:
    """W1 in two levels; equal to :func:`add_lags_window`.

    ``bucket`` must be non-decreasing in ``order_by`` (e.g. ``date_trunc`` of
    the leading time column) and constant within ``partition_by`` ordering.
    The bucketed rows feed two branches (rows and bucket tails).  With
    ``materialize`` they are written once with a reliable ``checkpoint()``
    to the shared checkpoint folder, so an expensive upstream (e.g. the
    per-scene aggregate over all pixels) runs once; without it each branch
    re-reads its (column-pruned) input, which is cheaper for a plain scan.
    ``coarser``: ever larger groups of buckets, as non-decreasing functions of the column
    ``__bucket``; the last one has a single group per partition (see :func:`_carry_in`).
    """
    k = n_lags
    b = "__bucket"
    keys = list(partition_by) + [b]
    w_in = Window.partitionBy(*_cols(keys)).orderBy(*_cols(order_by))
    w_all = Window.partitionBy(*_cols(keys))
    staged = df.withColumn(b, bucket).withColumns({
        "__rn": F.row_number().over(w_in),
        "__n": F.count(F.lit(1)).over(w_all),
        **{f"__in_{c}_{j}": F.lag(F.col(c), j).over(w_in)
           for c in value_cols for j in range(1, k + 1)},
    })
    if materialize:
        staged = checkpoint_table(staged)

    # per bucket: its last k rows, ascending -> one small array per bucket
    tail_struct = F.struct(F.col("__rn").alias("rn"),
                           *[F.col(c).alias(c) for c in value_cols])
    tails = (staged.filter(F.col("__rn") > F.col("__n") - k)
             .groupBy(*_cols(keys))
             .agg(F.array_sort(F.collect_list(tail_struct)).alias("__tail")))
    if coarser is None:
        # an unpartitioned series of times: the buckets of a year, and the years
        times = tails.schema[b].dataType.typeName().startswith(("timestamp", "date"))
        coarser = [F.date_trunc("year", F.col(b)), F.lit(0)] if times and not partition_by else []
    carry = _carry_in(tails, list(partition_by), b, coarser, k).select(
        *[F.col(k).alias(f"__c_{k}") for k in keys], "__prev")

    # null-safe keys: a null partition value or time forms its own bucket,
    # ordered first, exactly as the plain window orders nulls
    cond = [staged[k].eqNullSafe(carry[f"__c_{k}"]) for k in keys]
    joined = staged.join(carry, cond, "left").drop(*[f"__c_{k}" for k in keys])
    out = {}
    for c in value_cols:
        for j in range(1, k + 1):
            idx = F.size("__prev") - (F.lit(j) - F.col("__rn"))
            from_carry = F.when(idx >= 1, F.try_element_at(F.col("__prev"), idx)[c])
            out[c + suffix.format(k=j)] = F.when(
                F.col("__rn") > j, F.col(f"__in_{c}_{j}")).otherwise(from_carry)
    drop = [b, "__rn", "__n", "__prev"] + [f"__in_{c}_{j}" for c in value_cols
                                           for j in range(1, k + 1)]
    return joined.withColumns(out).drop(*drop)


def _last(rows: Column, k: int) -> Column:
    """The last k elements."""
    return F.slice(rows, F.greatest(F.size(rows) - k + 1, F.lit(1)), F.lit(k))


def _carry_in(tails: DataFrame, partition_by: list[str], b: str, coarser: list[Column], k: int
              ) -> DataFrame:
    """(partition, bucket, ``__prev``): the last k rows before every bucket, ascending.

    ``tails`` holds a bucket's own last k rows.  Without ``coarser`` groups one window per partition
    reads the k buckets before; else one window per group, and the group's own carry comes
    from the same step over groups.
    """
    def before(*keys: str) -> Column:
        w = Window.partitionBy(*_cols(keys)).orderBy(F.col(b)).rowsBetween(-k, -1)
        tail = F.collect_list(F.struct(F.col(b).alias("b"), F.col("__tail").alias("t"))).over(w)
        return F.flatten(F.transform(F.array_sort(tail), lambda x: x["t"]))

    keep = [*partition_by, b]
    if not coarser:
        return tails.select(*keep, before(*partition_by).alias("__prev"))
    g = b + "_up"
    grouped = tails.withColumn(g, coarser[0])
    if len(coarser) > 2:
        grouped = checkpoint_table(grouped)       # one row a bucket, read by every step above
    inside = grouped.select(*keep, g, before(*partition_by, g).alias("__in"))
    if len(coarser) == 1:
        return inside.select(*keep, F.col("__in").alias("__prev"))
    ordered = F.array_sort(F.collect_list(F.struct(F.col(b).alias("b"), F.col("__tail").alias("t"))))
    above = (grouped.groupBy(*partition_by, g)
             .agg(_last(F.flatten(F.transform(ordered, lambda x: x["t"])), k).alias("__tail")))
    rename = {c: f"__u_{c}" for c in [*partition_by, g]}
    up = _carry_in(above.withColumnRenamed(g, b), partition_by, b, coarser[1:], k
                   ).withColumnRenamed(b, g).withColumnsRenamed(
                       {**rename, "__prev": "__from_above"})
    cond = [inside[c].eqNullSafe(up[n]) for c, n in rename.items()]
    return inside.join(up, cond, "left").select(*keep, _last(F.concat(
        F.coalesce("__from_above", F.slice("__in", 1, 0)), F.col("__in")), k).alias("__prev"))


# Balanced buckets: about so many rows each, and so many buckets to a group.
FANOUT = 64
ROWS_PER_BUCKET = 1_000_000


def balanced_buckets(df: DataFrame, order_by: list[str] | str,
                     rows_per_bucket: int = ROWS_PER_BUCKET, out: str = "__tbucket"
                     ) -> DataFrame:
    """Add ``out``: ranges of about ``rows_per_bucket`` rows in the order of ``order_by``.

    The rows are range-partitioned by the whole ordering, tie-break included, and a
    row's bucket is its range, so rows of one instant are split as well.  The
    result is written once: the ranges come from a sample and must not be drawn twice.
    :func:`balanced_groups` gives the groups of buckets for the carry.
    """
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    n = max(1, -(-df.count() // rows_per_bucket))
    ranged = df.repartitionByRange(n, *_cols(order))
    return checkpoint_table(ranged.withColumn(out, F.spark_partition_id()))


def balanced_groups(staged: DataFrame, fanout: int = FANOUT, bucket: str = "__bucket"
                    ) -> list[Column]:
    """Groups of ``fanout`` balanced buckets, of groups, and so on up to a single one.

    The number of buckets is that of the written table's partitions.
    """
    n, groups, width = staged.rdd.getNumPartitions(), [], 1
    while not groups or n > width:
        width *= fanout
        groups.append(F.floor(F.col(bucket) / width))
    return groups


def add_lags(df: DataFrame, value_cols: list[str] | str = "mean_rr", n_lags: int = 3,
             partition_by: list[str] | None = None,
             order_by: list[str] | None = None,
             bucket: Column | str | None = None, materialize: bool = False,
             rows_per_bucket: int = ROWS_PER_BUCKET,
             coarser: list[Column] | None = None) -> DataFrame:
    """Row lags 1..n of each value column per partition, ordered.

    Defaults follow the reference: lags of ``mean_rr`` per ``year`` ordered by
    ``timestamp_ms`` (plus ``file`` as a tie-break, which the reference
    lacks).  Give ``bucket`` (e.g. ``F.date_trunc('day', 'timestamp')``) for
    the two-level plan; without it a single window is used.  ``bucket=
    "balanced"`` derives equal-count time buckets from the data (see
    :func:`balanced_buckets`).
    """
    cols = [value_cols] if isinstance(value_cols, str) else list(value_cols)
    partition_by = ["year"] if partition_by is None else list(partition_by)
    order_by = ["timestamp_ms", "file"] if order_by is None else list(order_by)
    if bucket is None:
        return add_lags_window(df, cols, n_lags, partition_by, order_by)
    if isinstance(bucket, str) and bucket == "balanced":
        staged = balanced_buckets(df, order_by, rows_per_bucket)
        out = add_lags_two_level(staged, cols, n_lags, partition_by, order_by,
                                 F.col("__tbucket"), materialize=materialize,
                                 coarser=balanced_groups(staged))
        return out.drop("__tbucket")
    return add_lags_two_level(df, cols, n_lags, partition_by, order_by, bucket,
                              materialize=materialize, coarser=coarser)


def add_time_delta(df: DataFrame, ts: str = "timestamp", out: str = "delta_minutes",
                   partition_by: list[str] | None = None,
                   order_by: list[str] | None = None,
                   bucket: Column | str | None = None, materialize: bool = False,
                   rows_per_bucket: int = ROWS_PER_BUCKET,
                   coarser: list[Column] | None = None) -> DataFrame:
    """Minutes since the previous row (first row 0), stored as float.

    Default is the whole table as one series, as the reference does; with
    ``bucket`` (a column, or ``"balanced"``) the two-level plan avoids the
    single-task window.
    """
    partition_by = [] if partition_by is None else list(partition_by)
    order_by = [ts] if order_by is None else list(order_by)
    tmp = "__t_us"
    staged = df.withColumn(tmp, epoch_micros(F.col(ts)))
    if isinstance(bucket, str) and bucket == "balanced":
        staged = balanced_buckets(staged, order_by, rows_per_bucket)
        bucket, coarser = F.col("__tbucket"), balanced_groups(staged)
    if bucket is None:
        lagged = add_lags_window(staged, [tmp], 1, partition_by, order_by, suffix="__prev")
    else:
        lagged = add_lags_two_level(staged, [tmp], 1, partition_by, order_by, bucket,
                                    suffix="__prev", materialize=materialize,
                                    coarser=coarser)
    gap = (F.col(tmp) - F.col(tmp + "__prev")) / F.lit(60_000_000.0)
    out_df = lagged.withColumn(out, F.coalesce(gap, F.lit(0.0)).cast("float"))
    return out_df.drop(tmp, tmp + "__prev", "__tbucket")


def add_time_delta_spans(df: DataFrame, ts: str, out: str, partition_by: list[str],
                         order_by: list[str], span: str, times: DataFrame | None = None
                         ) -> DataFrame:
    """W2 per series for tables of many series; equal to :func:`add_time_delta`.

    ``span``: a column of ``df`` that is non-decreasing in ``ts``, e.g. its year.  The window holds a
    span of one series, so a long series is still many windows.  The first row's gap
    needs the last time before its span: one maximum per series and span, which is added
    to the rows and leaves after the window.  Rows are shuffled once, by the series and
    ``span``, and stay so for lags per series and ``span``; null keys form their own series.
    ``times``: the same series, times and spans as ``df`` in any number of rows, for callers that
    have them from a cheaper source (the rows that ``df`` is aggregated from).
    """
    first = Window.partitionBy(*partition_by).orderBy("__bucket")
    ends = ((df if times is None else times).groupBy(*partition_by, F.col(span).alias("__bucket"))
            .agg(F.max(ts).alias("__end")))
    seams = ends.select(*partition_by, F.col("__bucket").alias(span),
                        F.lag("__end").over(first).alias(ts), F.lit(True).alias("__seam"))
    rows = df.withColumn("__seam", F.lit(False)).unionByName(
        seams.filter(F.col(ts).isNotNull()), allowMissingColumns=True)
    w = Window.partitionBy(*partition_by, span).orderBy(*order_by)
    gap = (epoch_micros(F.col(ts)) - epoch_micros(F.lag(ts).over(w))) / F.lit(60_000_000.0)
    return (rows.withColumn(out, F.coalesce(gap, F.lit(0.0)).cast("float"))
            .filter(~F.col("__seam")).drop("__seam"))
