"""Tiled scenes (S5, P9, A1-A5): grids too large for one row.

A tile row holds a rectangle of its scene's grid.  At rest tiles lie in folders by grid size
and tile place, so the crop's bounds, which follow from these alone, prune folders: tiles
outside the crop are never opened.  A tile is cropped, masked and reduced inside its row to
a state (counts, mean, summed squared deviations, maximum); states of a scene are merged
pairwise, which loses no digits to large means.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scenecast.operators.scenes import DEFAULT_WINDOW, _finish, clean_arrays, crop_bounds, stats_arrays

TILE = 256
PLACE = ["ny", "nx", "tile", "ty", "tx"]       # folders of a tile table
TILE_SCHEMA = ("scene_id string, file string, value array<float>, quality array<int>, "
               "ny int, nx int, tile int, ty int, tx int")


def _bounds(place: Column, size: Column, tile: Column) -> tuple[Column, Column]:
    """First and end row (or column) of a tile."""
    return place * tile, F.least(size, (place + 1) * tile)


def tiles_from_arrays(scenes: DataFrame, tile: int = TILE) -> DataFrame:
    """Array scenes cut into tiles of ``tile`` by ``tile`` cells, row-major, by slices of rows.

    A grid whose length is not ny * nx gives no tiles; a flag grid of another length is left out.
    """
    def numbers(size: str) -> Column:
        return F.sequence(F.lit(0), F.ceil(F.col(size) / tile).cast("int") - 1)

    whole = (F.col("ny") > 0) & (F.col("nx") > 0) & (F.size("value") == F.col("ny") * F.col("nx"))
    places = (scenes.filter(whole).withColumn("tile", F.lit(tile))
              .withColumn("ty", F.explode(numbers("ny")))
              .withColumn("tx", F.explode(numbers("nx"))))
    y0, y1 = _bounds(F.col("ty"), F.col("ny"), F.col("tile"))
    x0, x1 = _bounds(F.col("tx"), F.col("nx"), F.col("tile"))

    def cut(grid: str) -> Column:
        return F.flatten(F.transform(F.sequence(y0, y1 - 1), lambda y: F.slice(
            F.col(grid), y * F.col("nx") + x0 + 1, x1 - x0)))

    flags = F.when(F.size("quality") == F.col("ny") * F.col("nx"), cut("quality"))
    return places.select("scene_id", "file", cut("value").alias("value"), flags.alias("quality"),
                         *PLACE)


def write_tiles(tiles: DataFrame, path: str) -> str:
    """Tiles by grid size and place; a place with most rows is written by several tasks."""
    (tiles.repartitionByRange(*PLACE, "scene_id").sortWithinPartitions(*PLACE, "scene_id")
     .write.mode("append").partitionBy(*PLACE).parquet(path))
    return path


def read_tiles(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TILE_SCHEMA).parquet(path)


def _overlap(place: str, size: str, win: int) -> tuple[Column, Column]:
    """First and end row (or column) of the crop inside a tile."""
    start, end = _bounds(F.col(place), F.col(size), F.col("tile"))
    c0, c1 = crop_bounds(size, win)
    return F.greatest(start, c0) - start, F.least(end, c1) - start


def crop_tiles(tiles: DataFrame, win: int = DEFAULT_WINDOW) -> DataFrame:
    """Tiles that meet the crop, cut to it.  The filter reads folder names only."""
    a, b = _overlap("ty", "ny", win)
    c, d = _overlap("tx", "nx", win)
    width = F.least(F.col("nx") - F.col("tx") * F.col("tile"), F.col("tile"))

    def cut(grid: str) -> Column:
        return F.flatten(F.transform(F.sequence(a, b - 1), lambda y: F.slice(
            F.col(grid), y * width + c + 1, d - c)))

    met = tiles.filter((a < b) & (c < d))
    return met.withColumns({"value": cut("value"),
                            "quality": F.when(F.col("quality").isNotNull(), cut("quality"))})


def _merged(one: Column, two: Column) -> Column:
    """The state of two disjoint sets of cells."""
    n = one["n_valid"] + two["n_valid"]
    apart = two["mean"] - one["mean"]
    both = (one["n_valid"] > 0) & (two["n_valid"] > 0)
    share = two["n_valid"] / n
    return F.struct(
        (one["n_pixels"] + two["n_pixels"]).alias("n_pixels"), n.alias("n_valid"),
        (one["n_finite"] + two["n_finite"]).alias("n_finite"),
        F.when(both, one["mean"] + apart * share).when(one["n_valid"] > 0, one["mean"])
        .otherwise(two["mean"]).alias("mean"),
        (one["m2"] + two["m2"] + F.when(both, apart * apart * one["n_valid"] * share)
         .otherwise(0.0)).alias("m2"),
        F.greatest(one["max"], two["max"]).alias("max"),
        (one["rainy"] + two["rainy"]).alias("rainy"))


def scene_stats_tiles(tiles: DataFrame, win: int = DEFAULT_WINDOW, threshold: float = 0.0,
                      timestamp_col: str | None = None) -> DataFrame:
    """A5 for tiled scenes; equal to ``scene_stats_arrays`` on the whole grids.

    A scene is one small state per tile that meets the crop.
    """
    per_tile = stats_arrays(clean_arrays(crop_tiles(tiles, win)), threshold)
    state = F.struct(
        "ty", "tx", F.struct(
            "n_pixels", "n_valid", "n_finite", F.coalesce("mean_rr", F.lit(0.0)).alias("mean"),
            F.coalesce(F.col("std_rr") * F.col("std_rr") * F.col("n_valid"), F.lit(0.0)).alias("m2"),
            F.col("max_rr").alias("max"),
            F.coalesce(F.round(F.col("frac_rainy") * F.col("n_pixels")), F.lit(0.0))
            .alias("rainy")).alias("s"))
    zero = F.struct(
        *[F.lit(0).cast("long").alias(c) for c in ("n_pixels", "n_valid", "n_finite")],
        F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"),
        F.lit(None).cast("double").alias("max"), F.lit(0.0).alias("rainy"))
    scenes = per_tile.groupBy("scene_id", "file").agg(F.aggregate(
        F.array_sort(F.collect_list(state)), zero, lambda acc, t: _merged(acc, t["s"])).alias("s"))
    seen = F.col("s.n_valid") > 0
    return _finish(scenes.select(
        "scene_id", "file", "s.n_pixels", "s.n_valid", "s.n_finite",
        F.when(seen, F.col("s.mean")).alias("mean_rr"), F.col("s.max").alias("max_rr"),
        F.when(seen, F.sqrt(F.col("s.m2") / F.col("s.n_valid"))).alias("std_rr"),
        F.when(F.col("s.n_pixels") > 0, F.col("s.rainy") / F.col("s.n_pixels"))
        .alias("frac_rainy")), timestamp_col)
