"""SimHash near-dedup by a forest of vantage-point trees.

Fingerprint: words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, ``shingle``-word
shingles (repeats included; fewer words: the whole sequence; none: zero), XXH64
with seed 42, and per bit whether more than half the hashes set it.  Two
fingerprints link at ``max_bits`` or fewer differing bits.

Search, over distinct fingerprints only (copies are one point):

* The 64 bits are cut into ``trees`` bands.  Bits that differ at most
  ``max_bits`` times differ at most ``radius = max_bits // trees`` times in some band, and
  band distance obeys the triangle inequality.  Each tree is a vantage-point tree
  over one band: a node holds a vantage point and a distance ``m``; ``d <= m`` goes inside.
  Of two points that a boundary parts, within the radius, the inner one has
  ``d > m - radius`` (triangle inequality): it visits the shards outside too.  All other
  branches are pruned.  With two trees and three bits the radius is 1; the boundary is
  put where few points stand, as near the middle as pays.
* A shard above ``shard_rows`` gets a tree of its own, grown from its own sample, so the
  depth follows the number of fingerprints while each sample stays bounded.
* Within a shard, whole fingerprints are kept by their distance to one of them;
  the triangle bound leaves only rings within ``max_bits`` for each query.  Points reached
  leave the rings at once, so a dense group costs few comparisons and its
  links come out as a spanning tree, never as all pairs.
* A shard that no tree divides (a dense group) is dealt into blocks by hash, and every
  pair of blocks is one task.

The links join fingerprints into components (:mod:`scenecast.llm.components`).

Edge cases: null and empty texts have fingerprint zero and link like any
other; repeated rows get equal results each; rows that share a doc_id are
points of their own and the component takes the smallest doc_id; a null doc_id is
larger than any other (a component of only such rows has a null id); an
empty table gives an empty result.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scenecast.llm.common import require, row_keys, scratch, stored, words_of
from scenecast.llm.components import components

SHINGLE = 3
MAX_BITS = 3
TREES = 2
LEAF_ROWS = 2_000
SHARD_ROWS = 20_000
SAMPLE = 8_192
ROUNDS = 6
SEED = 42


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of one text."""
    words = words_of(text)
    if not words:
        return 0
    joined, ends, at = b" ".join(words), [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    starts = [0, *(e + 1 for e in ends[:-1])]
    span = min(shingle, len(words)) - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, ends[span:])),
                         dtype="<u8", count=len(words) - span)
    set_bits = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = np.unpackbits(hashes[i:i + (1 << 16)].view(np.uint8), bitorder="little")
        set_bits += part.reshape(-1, 64).sum(axis=0, dtype=np.int64)
    over = (2 * set_bits > len(hashes)).astype(np.uint8)
    return int(np.packbits(over, bitorder="little").view("<u8")[0])


def fingerprint_column(text: Column, shingle: int = SHINGLE) -> Column:
    """Column expression: the fingerprint as a signed 64-bit integer."""
    @F.arrow_udf("bigint")
    def run(texts: pa.Array) -> pa.Array:
        found = np.fromiter((fingerprint(t.as_py(), shingle) for t in texts),
                            dtype=np.uint64, count=len(texts))
        return pa.array(found.view(np.int64))
    return run(text)


# --- the forest -----------------------------------------------------------

def bands(trees: int) -> list[np.uint64]:
    """Masks that cut 64 bits into ``trees`` bands."""
    edges = [64 * i // trees for i in range(trees + 1)]
    return [np.uint64(((1 << (b - a)) - 1) << a) for a, b in zip(edges, edges[1:])]


def grow(sample: np.ndarray, mask: np.uint64, radius: int, least: float) -> list | None:
    """A tree as nested [vantage point, m, inside, outside]; None is a shard.

    A node of ``least`` or fewer sample points, or one that no boundary divides, is a shard.
    """
    if len(sample) <= max(1.0, least):
        return None
    point = sample[len(sample) // 2]
    dist = np.bitwise_count((sample ^ point) & mask)
    upto = np.cumsum(np.bincount(dist, minlength=65))
    # points inside and outside of every boundary, those that visit both counted on both sides
    outside = len(sample) - np.concatenate([np.zeros(radius, upto.dtype), upto])[:len(upto)]
    m = int(np.argmin(upto ** 2 + outside ** 2))
    if max(upto[m], outside[m]) > 0.9 * len(sample):
        return None
    return [point, m, grow(sample[dist <= m], mask, radius, least),
            grow(sample[dist + radius > m], mask, radius, least)]


def route(points: np.ndarray, tree: list | None, mask: np.uint64, radius: int
          ) -> Iterator[tuple[np.ndarray, str]]:
    """(indices of its points and visitors, name) of every shard."""
    stack = [(np.arange(len(points)), tree, "")]
    while stack:
        rows, node, name = stack.pop()
        if not len(rows):
            continue
        if node is None:
            yield rows, name
            continue
        point, m, inside, outside = node
        dist = np.bitwise_count((points[rows] ^ point) & mask).astype(np.int64)
        stack.append((rows[dist <= m], inside, name + "i"))
        stack.append((rows[dist + radius > m], outside, name + "o"))


def spanning_links(points: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links that join all points within ``max_bits`` of each other, directly or in steps.

    ``points`` are distinct.  Rings hold the points not reached yet by their
    distance to the first point.
    """
    if len(points) < 2:
        return []
    dist = np.bitwise_count(points ^ points[0])
    rings = [points[dist == d] for d in range(65)] if len(points) > 64 else [points]
    wide = len(rings) > 1
    links: list[tuple[int, int]] = []
    for ring in range(len(rings)):
        while len(rings[ring]):
            root, rings[ring] = rings[ring][0], rings[ring][1:]
            todo = [root]
            while todo:
                p = todo.pop()
                at = int(np.bitwise_count(p ^ points[0])) if wide else 0
                for r in range(max(0, at - max_bits), min(len(rings), at + max_bits + 1)):
                    rest = rings[r]
                    if len(rest):
                        near = np.bitwise_count(rest ^ p) <= max_bits
                        if near.any():
                            found = rest[near]
                            rings[r] = rest[~near]
                            todo.extend(found)
                            links.extend((int(p), int(q)) for q in found)
    return links


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _divided(placed: DataFrame, large: DataFrame, masks: list[np.uint64], radius: int,
             leaf_rows: int, shard_rows: int, sample: int) -> DataFrame:
    """The rows of the ``large`` (shard, n) ones in the shards of their own trees.

    Rows meet their shard's tree in parts of about ``shard_rows``; a shard that its tree leaves
    whole is ``final``.
    """
    parts = F.ceil(F.col("n") / shard_rows).cast("int")
    rows = placed.join(large, "shard").withColumn("part", F.pmod(F.xxhash64("fp"), parts))
    order = Window.partitionBy("shard").orderBy(F.xxhash64(F.lit("sample"), "fp"), "fp")
    picked = (rows.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= sample)
              .select("shard", "fp", "n"))

    def planted(group: pd.DataFrame) -> pd.DataFrame:
        shard = group["shard"].iloc[0]
        points = np.sort(group["fp"].to_numpy().view(np.uint64))
        points = np.random.default_rng(SEED).permutation(points)
        tree = grow(points, masks[int(shard.split(":")[0])], radius,
                    leaf_rows * len(points) / int(group["n"].iloc[0]))
        return pd.DataFrame({"shard": [shard], "tree": [pickle.dumps(tree)]})

    trees = picked.groupBy("shard").applyInPandas(planted, "shard string, tree binary")
    spread = stored(trees.join(large, "shard").select(
        "shard", "tree", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part")),
        "simhash-trees")

    def cut(group: pd.DataFrame, tree: pd.DataFrame) -> pd.DataFrame:
        if not len(group):
            return pd.DataFrame({"shard": [], "fp": [], "final": []})
        shard, fps = group["shard"].iloc[0], group["fp"].to_numpy()
        grown = pickle.loads(tree["tree"].iloc[0])
        return pd.concat([
            pd.DataFrame({"shard": f"{shard}/{name}", "fp": fps[at], "final": grown is None})
            for at, name in route(fps.view(np.uint64), grown, masks[int(shard.split(":")[0])],
                                  radius)])

    return (rows.select("shard", "part", "fp").groupBy("shard", "part")
            .cogroup(spread.groupBy("shard", "part"))
            .applyInPandas(cut, "shard string, fp bigint, final boolean"))


def shards(points: DataFrame, max_bits: int = MAX_BITS, trees: int = TREES,
           leaf_rows: int = LEAF_ROWS, shard_rows: int = SHARD_ROWS, sample: int = SAMPLE
           ) -> DataFrame:
    """(shard, fp): every fingerprint in its shard of each tree and in those it visits.

    The first trees are grown from the ``sample`` fingerprints of smallest hash; shards that are
    still above ``shard_rows`` are divided by trees from samples of their own, and so on.
    """
    n = points.count()
    radius, masks = max_bits // trees, bands(trees)
    picked = np.array([r.fp for r in points.orderBy(F.xxhash64("fp"), "fp").limit(sample)
                       .select("fp").collect()], dtype=np.int64).view(np.uint64)
    forest = [grow(picked, m, radius, leaf_rows * len(picked) / max(1, n)) for m in masks]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column("fp").to_numpy(zero_copy_only=False)
            for t, (tree, mask) in enumerate(zip(forest, masks)):
                for rows, name in route(fps.view(np.uint64), tree, mask, radius):
                    yield pa.record_batch({"shard": pa.array([f"{t}:{name}"] * len(rows)),
                                           "fp": pa.array(fps[rows])})

    placed = stored(points.select("fp").mapInArrow(place, "shard string, fp bigint"),
                    "simhash-shards").withColumn("final", F.lit(False))
    settled = []
    for _ in range(ROUNDS):
        large = stored(placed.filter(~F.col("final")).groupBy("shard").agg(
            F.count(F.lit(1)).alias("n")).filter(F.col("n") > shard_rows), "simhash-large")
        if large.isEmpty():
            break
        settled.append(placed.join(large, "shard", "left_anti"))
        placed = stored(_divided(placed, large, masks, radius, leaf_rows, shard_rows, sample),
                        "simhash-shards")
    for more in settled:
        placed = placed.unionByName(more)
    return placed.select("shard", "fp")


def link_fingerprints(points: DataFrame, max_bits: int = MAX_BITS, trees: int = TREES,
                      leaf_rows: int = LEAF_ROWS, shard_rows: int = SHARD_ROWS,
                      sample: int = SAMPLE) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` that span all components."""
    placed = shards(points, max_bits, trees, leaf_rows, shard_rows, sample)
    sizes = placed.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).filter(
        F.col("n") > shard_rows).withColumn("blocks", F.ceil(F.col("n") / shard_rows).cast("int"))
    blocks = F.coalesce("blocks", F.lit(1))
    dealt = placed.join(stored(sizes, "simhash-dense"), "shard", "left").select(
        "shard", "fp", blocks.alias("blocks"),
        F.pmod(F.xxhash64("fp"), blocks).cast("int").alias("own"))
    # a block meets itself and every other block of its shard, in one task per pair
    other = F.sequence(F.lit(0), F.col("blocks") - 1)
    pairs = dealt.select("shard", "fp", "own", F.explode(other).alias("other"))
    keyed = pairs.select("shard", F.least("own", "other").alias("x"),
                         F.greatest("own", "other").alias("y"), "fp")

    def within(group: pd.DataFrame) -> pd.DataFrame:
        fps = np.unique(group["fp"].to_numpy().view(np.uint64))
        found = spanning_links(fps, max_bits)
        return pd.DataFrame({"a": [_signed(a) for a, _ in found],
                             "b": [_signed(b) for _, b in found]}, dtype="int64")

    return keyed.groupBy("shard", "x", "y").applyInPandas(within, "a bigint, b bigint")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       shingle: int = SHINGLE, max_bits: int = MAX_BITS, trees: int = TREES,
                       leaf_rows: int = LEAF_ROWS, shard_rows: int = SHARD_ROWS,
                       sample: int = SAMPLE, keys: bool = False) -> DataFrame:
    """Per row: id, ``fingerprint`` (16 hex digits), ``component_id``.

    ``keys`` adds the row's content hashes (_k1, _k2) and ``first``: whether the
    row holds the smallest (doc_id, content) of its component.
    """
    require(docs, id_col, text_col)
    rows = stored(docs.select(F.col(id_col).alias("_id"), *row_keys(id_col, text_col),
                              fingerprint_column(F.col(text_col), shingle).alias("fp")),
                  "simhash-rows")
    # null ids sort last; the second field is what min() returns for them
    least = F.min(F.struct(F.col("_id").isNull().alias("no_id"), F.col("_id").alias("id"),
                           F.col("_k1").alias("k1"), F.col("_k2").alias("k2")))
    with scratch(docs.sparkSession):
        points = stored(rows.groupBy("fp").agg(least.alias("least")), "simhash-points")
        links = link_fingerprints(points, max_bits, trees, leaf_rows, shard_rows, sample)
        roots = stored(components(links), "simhash-roots")
        rooted = points.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
            "fp", F.coalesce("root", "fp").alias("root"), "least")
        rooted = stored(rooted, "simhash-rooted")
        firsts = stored(rooted.groupBy("root").agg(F.min("least").alias("first")),
                        "simhash-firsts")
        named = stored(rooted.join(firsts, "root").select("fp", "first"), "simhash-named",
                       outlive=True)
    out = rows.join(named, "fp")
    columns = [F.col("_id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
               F.col("first.id").alias("component_id")]
    if keys:
        first = (F.col("_k1") == F.col("first.k1")) & (F.col("_k2") == F.col("first.k2"))
        columns += ["_k1", "_k2", first.alias("first")]
    return out.select(*columns)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options
             ) -> DataFrame:
    """The documents with one of each component left: the row of the smallest doc_id.

    Of repeated rows (same doc_id and text) one stays.
    """
    with scratch(docs.sparkSession):
        named = simhash_components(docs, id_col, text_col, keys=True, **options)
        kept = stored(named.filter("first").select("_k1", "_k2").distinct(), "simhash-kept",
                      outlive=True)
    keyed = docs.select("*", *row_keys(id_col, text_col))
    return (keyed.join(kept, ["_k1", "_k2"], "left_semi")
            .dropDuplicates(["_k1", "_k2"]).drop("_k1", "_k2"))
