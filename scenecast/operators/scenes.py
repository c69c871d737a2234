"""Scene operators: variable choice, crop, mask, clean, reduce.

Two scene shapes are accepted (see ``schemas``):

* **array** - one row per scene, grids row-major.  Crop, mask and all four
  statistics run as higher-order functions inside the row: no explode, no
  shuffle; the crop slices rows before anything else touches the pixels.
* **long** - one row per pixel.  Crop and mask are filters/projections on the
  scan, the statistics are one ``groupBy(scene)`` whose aggregates are all
  algebraic, so Spark combines them map-side before the shuffle and a scene
  holding a third of all pixels still leaves each task with one partial row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scenecast.functions.metrics import frac_above
from scenecast.functions.names import file_timestamp

# Fixed values of the reference setup.
DEFAULT_WINDOW = 200          # centre crop edge, pixels
PREFERRED_VAR = "RRQPE"       # variable preferred when present
SKIPPED_VARS = ["latitude", "longitude"]   # never used as fallback (any case)

# Reject reasons, in the order they are tested.
REJECT_NO_TIME = "no_timestamp"
REJECT_NO_VAR = "no_variable"
REJECT_NOT_2D = "not_2d"
REJECT_BAD_GRID = "bad_grid"          # values missing, or not ny * nx of them
REJECT_NO_PIXEL = "no_finite_pixel"

_INF = float("inf")


# --------------------------------------------------------------- P8 variable

def pick_variable(catalog: DataFrame, preferred: str = PREFERRED_VAR,
                  scene_col: str = "scene_id") -> DataFrame:
    """One row per scene with the chosen variable (null when none).

    The preferred name wins whatever its shape; otherwise the first (by
    ``ordinal``) 2-D floating variable that is not latitude/longitude.
    Two phases, as the nearest pick: (1) a hash aggregate per scene over the
    packed key ``not_preferred * 2^32 + ordinal`` (map-side combine; null
    when the scene has no candidate); (2) the catalogue rows holding the
    winning key (a semi join) give the name.  Ordinals are positions in the
    file, so the winner is one row; ``min`` keeps it exact otherwise.
    """
    is_pref = F.col("var") == F.lit(preferred)
    fallback = (~F.lower(F.col("var")).isin(SKIPPED_VARS)
                & (F.col("ndims") == 2)
                & F.lower(F.col("dtype")).startswith("float"))
    key = F.when(is_pref | fallback,
                 F.when(is_pref, F.lit(0)).otherwise(F.lit(1)).cast("long") * F.lit(1 << 32)
                 + F.col("ordinal").cast("long"))
    keyed = catalog.select(scene_col, "var", "ndims", key.alias("__k"))
    best = keyed.groupBy(scene_col).agg(F.min("__k").alias("__k"))
    rows = keyed.join(best.filter(F.col("__k").isNotNull()), [scene_col, "__k"], "left_semi")
    chosen = rows.groupBy(scene_col).agg(
        F.min(F.struct(F.col("var").alias("var"), F.col("ndims").alias("ndims"))).alias("c"))
    return (best.select(scene_col).join(chosen, scene_col, "left")
            .select(scene_col, F.col("c.var").alias("var"), F.col("c.ndims").alias("ndims")))


def pick_variable_arrays(scenes: DataFrame, col: str = "variables",
                         preferred: str = PREFERRED_VAR) -> DataFrame:
    """P8 where every scene row carries its own catalogue (the shape a file gives).

    ``col`` is an array of (var, ndims, dtype, ordinal); it is replaced by the chosen
    ``var`` and ``ndims`` (null when none).  The choice is made inside the row: no join,
    no shuffle.  Ties on ``ordinal`` go to the smaller name, as in :func:`pick_variable`.
    """
    def rank(v: Column) -> Column:
        return F.struct((v["var"] != preferred).alias("later"), v["ordinal"].alias("ordinal"),
                        v["var"].alias("var"), v["ndims"].alias("ndims"))

    def usable(v: Column) -> Column:
        grid = (~F.lower(v["var"]).isin(SKIPPED_VARS) & (v["ndims"] == 2)
                & F.lower(v["dtype"]).startswith("float"))
        return ((v["var"] == preferred) | grid) & v["ordinal"].isNotNull()

    best = F.array_min(F.transform(F.filter(F.col(col), usable), rank))
    return (scenes.withColumn("__best", best)
            .withColumns({"var": F.col("__best.var"), "ndims": F.col("__best.ndims")})
            .drop("__best", col))


# --------------------------------------------------------------- P9 crop

def crop_bounds(n, win: int = DEFAULT_WINDOW) -> tuple[Column, Column]:
    """``[max(0, n//2 - win//2), min(n, n//2 + win//2))`` for a size column."""
    n = F.col(n) if isinstance(n, str) else n
    half = win // 2
    c = F.floor(n / 2).cast("int")
    return F.greatest(F.lit(0), c - half), F.least(n, c + half)


def center_crop_arrays(scenes: DataFrame, win: int = DEFAULT_WINDOW) -> DataFrame:
    """P9 on array scenes: keeps only the crop of ``value`` and ``quality``.

    Output adds ``cy0, cy1, cx0, cx1`` (crop bounds) and replaces the grids by
    the cropped, row-major cells.
    """
    ny, nx = F.col("ny"), F.col("nx")
    y0, y1 = crop_bounds(ny, win)
    x0, x1 = crop_bounds(nx, win)
    q_ok = F.col("quality").isNotNull() & (F.size("quality") == ny * nx)

    def crop(arr_name: str, typ: str) -> Column:
        arr = F.col(arr_name)
        rows = F.transform(F.sequence(y0, y1 - 1),
                           lambda r: F.slice(arr, r * nx + x0 + 1, x1 - x0))
        return F.when((y1 > y0) & (x1 > x0), F.flatten(rows)).otherwise(
            F.array().cast(f"array<{typ}>"))

    return scenes.withColumns({
        "cy0": y0, "cy1": y1, "cx0": x0, "cx1": x1,
        "value": crop("value", "float"),
        "quality": F.when(q_ok, crop("quality", "int")),
    })


def center_crop_long(pixels: DataFrame, dims: DataFrame | None = None,
                     win: int = DEFAULT_WINDOW, scene_col: str = "scene_id") -> DataFrame:
    """P9 on long scenes: a filter on ``y``/``x``.

    Scene sizes come from ``ny``/``nx`` columns when present; else from
    ``dims`` (scene_id, ny, nx); else they are derived as max index + 1 with a
    per-scene aggregate (one small row per scene) joined back.  The join is a
    plain join: adaptive execution broadcasts the dims only when its measured
    size is under the broadcast threshold, and shuffles otherwise.
    """
    if "ny" not in pixels.columns or "nx" not in pixels.columns:
        if dims is None:
            dims = (pixels.groupBy(scene_col)
                    .agg((F.max("y") + 1).cast("int").alias("ny"),
                         (F.max("x") + 1).cast("int").alias("nx")))
        pixels = pixels.join(dims.select(scene_col, "ny", "nx"), scene_col)
    y0, y1 = crop_bounds("ny", win)
    x0, x1 = crop_bounds("nx", win)
    return pixels.filter((F.col("y") >= y0) & (F.col("y") < y1)
                         & (F.col("x") >= x0) & (F.col("x") < x1))


# --------------------------------------------------------------- P10/P11 clean

def clean_value(value, quality=None, has_quality=None) -> Column:
    """P10 + P11: NaN -> null; flag != 0 (or null flag) -> null; negative -> null.

    Masking applies only when a flag grid exists (``has_quality``).
    """
    v = F.col(value) if isinstance(value, str) else value
    v = F.when(~F.isnan(v), v)
    if quality is not None:
        q = F.col(quality) if isinstance(quality, str) else quality
        keep = F.coalesce(q == 0, F.lit(False))
        if has_quality is not None:
            hq = F.col(has_quality) if isinstance(has_quality, str) else has_quality
            keep = keep | ~F.coalesce(hq, F.lit(False))
        v = F.when(keep, v)
    return F.when(v >= 0, v)


def clean_arrays(scenes: DataFrame) -> DataFrame:
    """P10 + P11 on (cropped) array scenes: ``value`` becomes the clean cells."""
    q = F.col("quality")
    cleaned = F.transform(F.col("value"), lambda v, i: F.when(
        (~F.isnan(v)) & (v >= 0)
        & (q.isNull() | F.coalesce(F.get(q, i) == 0, F.lit(False))), v.cast("double")))
    return scenes.withColumn("value", cleaned)


def clean_long(pixels: DataFrame) -> DataFrame:
    """P10 + P11 on long scenes: ``value`` becomes the clean value (double)."""
    return pixels.withColumn(
        "value", clean_value(F.col("value").cast("double"), "quality", "has_quality"))


# --------------------------------------------------------------- A1-A5 reduce

def stats_arrays(scenes: DataFrame, threshold: float = 0.0) -> DataFrame:
    """A1-A4 on clean array scenes, inside the row (no shuffle).

    Adds ``n_pixels, n_valid, n_finite, mean_rr, max_rr, std_rr, frac_rainy``.
    """
    cells = F.col("value")
    valid = F.filter(cells, lambda v: v.isNotNull())
    n_valid = F.size(valid)
    total = F.aggregate(valid, F.lit(0.0), lambda a, v: a + v)
    mean = F.when(n_valid > 0, total / n_valid)
    df = scenes.withColumns({
        "n_pixels": F.size(cells).cast("long"),
        "n_valid": n_valid.cast("long"),
        "n_finite": F.size(F.filter(valid, lambda v: v < _INF)).cast("long"),
        "mean_rr": mean,
        "max_rr": F.array_max(valid),
        "frac_rainy": F.when(F.size(cells) > 0, F.size(F.filter(
            cells, lambda v: F.coalesce(v > F.lit(threshold), F.lit(False)))) / F.size(cells)),
    })
    # population std with a second pass over the cells (stable, exact mean)
    sq = F.aggregate(F.filter(F.col("value"), lambda v: v.isNotNull()), F.lit(0.0),
                     lambda a, v: a + (v - F.col("mean_rr")) * (v - F.col("mean_rr")))
    return df.withColumn("std_rr", F.when(F.col("n_valid") > 0, F.sqrt(sq / F.col("n_valid"))))


def stats_long(pixels: DataFrame, threshold: float = 0.0,
               keys: tuple[str, ...] = ("scene_id", "file")) -> DataFrame:
    """A1-A5 on clean long scenes: one ``groupBy(scene)`` with partial aggregation."""
    v = F.col("value")
    return (pixels.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_pixels"),
        F.count(v).alias("n_valid"),
        F.count_if(v < _INF).alias("n_finite"),
        F.avg(v).alias("mean_rr"),
        F.max(v).alias("max_rr"),
        F.stddev_pop(v).alias("std_rr"),
        frac_above(v, threshold).alias("frac_rainy"),
    ))


def _finish(stats: DataFrame, timestamp_col: str | None) -> DataFrame:
    ts = F.col(timestamp_col) if timestamp_col else file_timestamp(F.col("file"))
    reason = F.when(ts.isNull(), F.lit(REJECT_NO_TIME))
    if "var" in stats.columns:
        reason = (reason.when(F.col("var").isNull(), F.lit(REJECT_NO_VAR))
                  .when(F.col("ndims") != 2, F.lit(REJECT_NOT_2D)))
    if "grid_ok" in stats.columns:
        reason = reason.when(~F.col("grid_ok"), F.lit(REJECT_BAD_GRID))
    reason = reason.when(F.coalesce(F.col("n_finite"), F.lit(0)) == 0, F.lit(REJECT_NO_PIXEL))
    return stats.withColumns({"timestamp": ts, "reject_reason": reason}).drop("grid_ok")


def scene_stats_arrays(scenes: DataFrame, win: int = DEFAULT_WINDOW,
                       threshold: float = 0.0, timestamp_col: str | None = None) -> DataFrame:
    """A5 for array scenes: crop -> clean -> reduce, all row-local.

    Output: scene_id, file, timestamp, n_pixels, n_valid, n_finite, mean_rr,
    max_rr, std_rr, frac_rainy, reject_reason (null = accepted).
    """
    grid_ok = F.coalesce(F.size("value") == F.col("ny") * F.col("nx"), F.lit(False))
    scenes = scenes.withColumn("grid_ok", F.col("value").isNotNull() & grid_ok)
    out = stats_arrays(clean_arrays(center_crop_arrays(scenes, win)), threshold)
    keep = [c for c in scenes.columns if c not in ("value", "quality", "ny", "nx")]
    cols = keep + ["n_pixels", "n_valid", "n_finite", "mean_rr", "max_rr", "std_rr",
                   "frac_rainy"]
    return _finish(out.select(*cols), timestamp_col)


def scene_stats_long(pixels: DataFrame, win: int = DEFAULT_WINDOW, threshold: float = 0.0,
                     dims: DataFrame | None = None, timestamp_col: str | None = None,
                     keys: tuple[str, ...] = ("scene_id", "file")) -> DataFrame:
    """A5 for long scenes: crop filter -> clean projection -> one aggregate."""
    cropped = center_crop_long(pixels, dims, win)
    stats = stats_long(clean_long(cropped), threshold, keys)
    return _finish(stats, timestamp_col)


def accepted(stats: DataFrame) -> DataFrame:
    """Rows that pass every check, in the SCENE_STATS layout."""
    return (stats.filter(F.col("reject_reason").isNull())
            .select("file", "timestamp", "mean_rr", "max_rr", "std_rr", "frac_rainy"))


# --------------------------------------------------------------- A6 report

def build_report(features: DataFrame) -> DataFrame:
    """Row count, sorted distinct years, min/max of mean_rr - one aggregate."""
    return features.agg(
        F.count(F.lit(1)).alias("rows"),
        F.sort_array(F.collect_set("year")).alias("years"),
        F.min("mean_rr").alias("min_mean_rr"),
        F.max("mean_rr").alias("max_mean_rr"),
    )


def reject_counts(stats: DataFrame) -> DataFrame:
    """Scenes per outcome (``accepted`` or the reject reason)."""
    return (stats.groupBy(F.coalesce(F.col("reject_reason"), F.lit("accepted")).alias("outcome"))
            .agg(F.count(F.lit(1)).alias("scenes")))


def long_from_arrays(scenes: DataFrame) -> DataFrame:
    """Array scenes -> long scenes (one row per pixel), for interchange."""
    q_ok = F.col("quality").isNotNull() & (F.size("quality") == F.col("ny") * F.col("nx"))
    base = scenes.select("scene_id", "file", "ny", "nx", "quality",
                         q_ok.alias("has_quality"),
                         F.posexplode("value").alias("pos", "value"))
    return base.select(
        "scene_id", "file",
        (F.col("pos") / F.col("nx")).cast("int").alias("y"),
        F.pmod(F.col("pos"), F.col("nx")).cast("int").alias("x"),
        F.col("value"),
        F.when(F.col("has_quality"), F.get(F.col("quality"), F.col("pos"))).alias("quality"),
        "has_quality", "ny", "nx",
    )
