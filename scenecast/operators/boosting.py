"""Second-order gradient boosting on DataFrames (M6).

Squared loss; every split is found from per-node histograms of gradient and hessian, with
an L2 penalty on leaf weights, a share of rows and of features per tree, and candidate cuts
from quantiles.

* Features are binned once (quantile sketches of all features in one job, ``Bucketizer``).
* A level of a tree is one aggregate ``(node, feature, bin) -> (sum g, sum h)``: it combines
  before the shuffle, and what comes to the driver is at most ``nodes * features * bins`` sums,
  whatever the number of rows.
* A row's way down the tree is a look-up in small array literals, so the generated code of one
  level is the same for every tree and is compiled once.
* The margins of the rows are kept between trees; every ``checkpoint_every`` trees they are
  written to the shared checkpoint folder, so a lost executor costs at most the trees since.

* With fixed cuts and all rows in every tree, rows of the same bins take the same way down every
  tree: they are summed once to cells (bins, rows, sum of labels).  Up to ``CELLS`` of them are
  boosted from those sums at the driver; with more, every level is an aggregate of the rows.

The leaf sums of a tree are those of its last level's best splits: no extra job.  Of splits
that are equal but for rounding the first wins, whatever the order of the sums.  Fitted
models are pipeline stages that save and load like the others; scoring looks the bins up in a
table of all their combinations where these are few, else it walks the trees.  Either is one
constant, read with array functions inside the row.
"""

from __future__ import annotations

import json
import math
import random

import numpy as np
from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import Bucketizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasSeed
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scenecast.session import materialize

ROWS_PER_PARTITION = 250_000
LARGEST = 1.7976931348623157e308
CELLS = 100_000                  # most cells that come to the driver
TABLE_CELLS = 200_000            # most combinations of bins that a model scores by look-up
SAME_SCORE = 1 - 1e-12           # scores of splits closer than this differ by rounding


def _param(name: str, doc: str, convert) -> Param:
    return Param(Params._dummy(), name, doc, convert)


class SecondOrderBoosting(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol, HasSeed,
                          DefaultParamsReadable, DefaultParamsWritable):
    """Estimator; ``edges`` fixes the candidate cuts per feature instead of quantiles.

    A row goes left where its value is below the cut.  Rows with a null label take no part.
    """

    rounds = _param("rounds", "number of trees", TypeConverters.toInt)
    eta = _param("eta", "step size", TypeConverters.toFloat)
    depth = _param("depth", "levels of splits", TypeConverters.toInt)
    l2 = _param("l2", "L2 penalty on leaf weights", TypeConverters.toFloat)
    minWeight = _param("minWeight", "least hessian of a child", TypeConverters.toFloat)
    subsample = _param("subsample", "share of rows per tree", TypeConverters.toFloat)
    colsample = _param("colsample", "share of features per tree", TypeConverters.toFloat)
    bins = _param("bins", "bins per feature", TypeConverters.toInt)
    checkpointEvery = _param("checkpointEvery", "trees between checkpoints", TypeConverters.toInt)
    edges = _param("edges", "candidate cuts per feature", TypeConverters.toList)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", predictionCol="prediction",
                 rounds=600, eta=0.05, depth=6, l2=1.0, minWeight=1.0, subsample=0.8,
                 colsample=0.8, bins=256, checkpointEvery=10, seed=42, edges=None):
        super().__init__()
        kwargs = {k: v for k, v in self._input_kwargs.items() if v is not None}
        defaults = dict(rounds=600, eta=0.05, depth=6, l2=1.0, minWeight=1.0, subsample=0.8,
                        colsample=0.8, bins=256, checkpointEvery=10, seed=42)
        self._setDefault(**defaults)
        self._set(**kwargs)

    def _get(self, name: str):
        return self.getOrDefault(self.getParam(name))

    def _cuts(self, wide: DataFrame, cols: list[str]) -> list[list[float]]:
        """Distinct candidate cuts per feature."""
        if self.isDefined(self.edges):
            return [sorted({float(e) for e in es}) for es in self._get("edges")]
        n = self._get("bins")
        found = wide.approxQuantile(cols, [k / n for k in range(1, n)], 0.25 / n)
        return [sorted({v for v in q if v == v}) for q in found]

    def _binned(self, dataset: DataFrame, write: bool = True
                ) -> tuple[DataFrame, list[list[float]], float]:
        """(id, y, margin, bins), the cuts, and the mean label.

        The rows are spread and written once; without ``write`` they stay where they are.
        """
        label = F.col(self.getLabelCol()).cast("double")
        rows = dataset.select(label.alias("y"), vector_to_array(self.getFeaturesCol()).alias("x")
                              ).filter(F.col("y").isNotNull())
        first = rows.first()
        if first is None:
            return None, [], 0.0
        cols = [f"x{j}" for j in range(len(first["x"]))]
        wide = rows.select("y", *[F.get("x", F.lit(j)).alias(c) for j, c in enumerate(cols)])
        n, mean = wide.agg(F.count(F.lit(1)), F.avg("y")).first()
        if write:
            wide = wide.repartition(-(-n // ROWS_PER_PARTITION))
        if not self.isDefined(self.edges):
            wide = materialize(wide)              # read for the quantiles and for the bins
        cuts = self._cuts(wide, cols)
        binned = Bucketizer(splitsArray=[[-np.inf, *c, np.inf] for c in cuts], inputCols=cols,
                            outputCols=[f"b{j}" for j in range(len(cols))],
                            handleInvalid="keep").transform(wide)
        out = binned.select(F.monotonically_increasing_id().alias("id"), "y",
                            F.lit(mean).alias("margin"),
                            F.array(*[F.col(f"b{j}").cast("int") for j in range(len(cols))]
                                    ).alias("bins"))
        return materialize(out) if write else out, cuts, mean

    def _fit(self, dataset: DataFrame) -> "SecondOrderBoostedModel":
        cells = None
        if self._get("subsample") >= 1 and self.isDefined(self.edges):
            rows, cuts, mean = self._binned(dataset, write=False)
            cells = _cells(rows) if rows is not None else None
        if cells is None:
            rows, cuts, mean = self._binned(dataset)
            trees, gains = self._boost_rows(rows, cuts)
        else:
            trees, gains = self._boost_cells(*cells, cuts, mean)
        model = SecondOrderBoostedModel(
            base=mean, depth=self._get("depth"), eta=self._get("eta"),
            gains=[float(g) for g in gains],
            splits=[int(f) for tree in trees for f in tree[0]],
            cuts=[float(c) for tree in trees for c in tree[1]],
            leaves=[float(v) for tree in trees for v in tree[2]])
        return self._copyValues(model)

    def _used(self, p: int, t: int) -> list[int]:
        """The features of a tree."""
        rng = random.Random(self.getSeed() * 1_000_003 + t)
        return sorted(rng.sample(range(p), max(1, round(self._get("colsample") * p))))

    def _boost_cells(self, bins: np.ndarray, n: np.ndarray, y: np.ndarray,
                     cuts: list[list[float]], mean: float):
        """Trees and gains from the cells' bins, rows and sums of labels."""
        p, wide = len(cuts), max(map(len, cuts)) + 2
        at_bin = bins + np.arange(p) * wide
        trees, gains = [], np.zeros(p)
        off = mean - y / n                        # margin less mean label
        hess_of = np.repeat(n.astype(float), p)
        for t in range(self._get("rounds")):
            node, grad_of = np.zeros(len(n), dtype=int), np.repeat(n * off, p)

            def sums(first, width):
                at = ((node - first)[:, None] * (p * wide) + at_bin).ravel()
                return [np.bincount(at, of, width * p * wide).reshape(width, p, wide)
                        for of in (grad_of, hess_of)]

            def down(feature, cut_bin):
                nonlocal node
                below = bins[np.arange(len(n)), np.take(feature, node)] <= np.take(cut_bin, node)
                node = 2 * node + np.where(below, 1, 2)

            tree, won = self._grow(cuts, self._used(p, t), sums, down)
            off = off + self._get("eta") * np.take(tree[2], node - len(tree[0]))
            gains += won
            trees.append(tree)
        return trees, gains

    def _boost_rows(self, rows: DataFrame | None, cuts: list[list[float]]):
        """Trees and gains, a Spark job for every level."""
        depth, eta, p = self._get("depth"), self._get("eta"), len(cuts)
        trees, gains, held = [], np.zeros(p), None
        for t in range(self._get("rounds") if rows is not None else 0):
            tree, node, won = self._tree(rows, cuts, self._used(p, t), t)
            gains += won
            trees.append(tree)
            if t + 1 == self._get("rounds"):
                break                             # no tree reads the margins after the last one
            leaf = F.get(_literal(tree[2]), F.col("node") - (2 ** depth - 1))
            after = node.select("id", "y", (F.col("margin") + eta * leaf).alias("margin"), "bins")
            if (t + 1) % self._get("checkpointEvery") == 0:
                rows, old = materialize(after), held
                held = None
            else:
                # computed by the next tree's first job, after which the one before is let go
                rows = after.persist(StorageLevel.MEMORY_AND_DISK)
                rows.count()
                old, held = held, rows
            if old is not None:
                old.unpersist()
        if held is not None:
            held.unpersist()
        return trees, gains

    def _tree(self, rows: DataFrame, cuts: list[list[float]], used: list[int], t: int):
        """One tree, the rows with their ``node``, gain per feature."""
        share = self._get("subsample")
        drawn = F.pmod(F.xxhash64("id", F.lit(self.getSeed()), F.lit(t)), F.lit(1_000_000)) < int(
            share * 1_000_000)
        node = rows.withColumn("node", F.lit(0))

        def sums(first, width):
            picked = F.array(*[F.struct(F.lit(f).alias("f"), F.get("bins", F.lit(f)).alias("b"))
                               for f in used])
            got = ((node.filter(drawn) if share < 1 else node)
                   .select("node", (F.col("margin") - F.col("y")).alias("g"),
                           F.inline(picked))
                   .groupBy("node", "f", "b").agg(F.sum("g").alias("g"),
                                                  F.count(F.lit(1)).alias("h")).toArrow())
            at, f, b, g, h = (got.column(c).to_numpy() for c in ("node", "f", "b", "g", "h"))
            shape = (width, len(cuts), max(map(len, cuts)) + 2)
            grad, hess = np.zeros(shape), np.zeros(shape)
            grad[at - first, f, b], hess[at - first, f, b] = g, h
            return grad, hess

        def down(feature, cut_bin):
            nonlocal node
            below = F.get("bins", F.get(_literal(feature), F.col("node"))) <= F.get(
                _literal(cut_bin), F.col("node"))
            node = node.withColumn("node", 2 * F.col("node") + F.when(below, 1).otherwise(2))

        tree, won = self._grow(cuts, used, sums, down)
        return tree, node, won

    def _grow(self, cuts: list[list[float]], used: list[int], sums, down):
        """One tree as (features, cuts, leaf values), gain per feature.

        ``sums`` gives a level's gradients and hessians per (node, feature, bin), ``down``
        moves the rows to the level below.
        """
        depth, l2, least = self._get("depth"), self._get("l2"), self._get("minWeight")
        inner = 2 ** depth - 1
        feature, cut, cut_bin = [0] * inner, [np.inf] * inner, [2 ** 30] * inner
        values, won = np.zeros(2 ** depth), np.zeros(len(cuts))
        for level in range(depth):
            first, width = 2 ** level - 1, 2 ** level
            grad, hess = sums(first, width)
            whole_g, whole_h = grad[:, used[0]].sum(axis=1), hess[:, used[0]].sum(axis=1)
            found = _best_splits(grad, hess, cuts, used, l2, least)
            for k in range(width):
                left = (whole_g[k], whole_h[k])
                if found[k] is not None:
                    gain, j, i, left = found[k]
                    feature[first + k], cut[first + k], cut_bin[first + k] = j, cuts[j][i], i
                    won[j] += gain
                if level == depth - 1:
                    values[2 * k] = -left[0] / (left[1] + l2) if left[1] else 0.0
                    right = whole_g[k] - left[0], whole_h[k] - left[1]
                    values[2 * k + 1] = -right[0] / (right[1] + l2) if right[1] else 0.0
            down(feature, cut_bin)
        return (feature, cut, values.tolist()), won


def _cells(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Bins, number of rows and sum of labels of the rows of the same bins; None for over ``CELLS``."""
    got = (rows.groupBy("bins").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("y"))
           .limit(CELLS + 1).toArrow())
    if len(got) > CELLS:
        return None
    bins = got.column("bins").combine_chunks().flatten().to_numpy().reshape(len(got), -1)
    order = np.lexsort(bins.T)                    # the order of the sums is always the same
    return bins[order], *(got.column(c).to_numpy()[order] for c in ("n", "y"))


def _literal(values: list) -> Column:
    """An array literal (kept out of the generated code as one object)."""
    return F.array(*[F.lit(v) for v in values])


def _best_splits(grad: np.ndarray, hess: np.ndarray, cuts: list[list[float]], used: list[int],
                 l2: float, least: float) -> list:
    """(gain, feature, cut number, sums of the left child) of every node, None without a gain.

    Of a node's best splits, equal but for rounding, it is the first feature's first cut.
    """
    left_g, left_h = grad.cumsum(axis=2), hess.cumsum(axis=2)
    all_g, all_h = left_g[:, :, -1:], left_h[:, :, -1:]
    right_g, right_h = all_g - left_g, all_h - left_h
    is_cut = np.zeros(grad.shape[1:], dtype=bool)
    for j in used:
        is_cut[j, :len(cuts[j])] = True
    tried = is_cut & (left_h >= max(least, 1)) & (right_h >= max(least, 1))
    score, gain = np.full(grad.shape, -1.0), np.zeros(grad.shape)
    score[tried] = (left_g[tried] ** 2 / (left_h[tried] + l2)
                    + right_g[tried] ** 2 / (right_h[tried] + l2))
    whole = np.broadcast_to(all_g, grad.shape)[tried] ** 2 / (
        np.broadcast_to(all_h, grad.shape)[tried] + l2)
    gain[tried] = score[tried] - whole
    top = score.max(axis=(1, 2), keepdims=True)
    best = tried & (score >= top * SAME_SCORE) & (gain > 1e-9)
    out = []
    for k, at in enumerate(best.reshape(len(best), -1).argmax(axis=1)):
        j, i = divmod(int(at), grad.shape[2])
        out.append((float(gain[k, j, i]), j, i, (float(left_g[k, j, i]), float(left_h[k, j, i])))
                   if best[k, j, i] else None)
    return out


class SecondOrderBoostedModel(Model, HasFeaturesCol, HasLabelCol, HasPredictionCol,
                              DefaultParamsReadable, DefaultParamsWritable):
    """Fitted trees: full binary trees of ``depth`` levels, one after the other."""

    base = _param("base", "mean label", TypeConverters.toFloat)
    depth = _param("depth", "levels of splits", TypeConverters.toInt)
    eta = _param("eta", "step size", TypeConverters.toFloat)
    splits = _param("splits", "feature of every inner node", TypeConverters.toListInt)
    cuts = _param("cuts", "cut of every inner node", TypeConverters.toListFloat)
    leaves = _param("leaves", "value of every leaf", TypeConverters.toListFloat)
    gains = _param("gains", "summed gain per feature", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, base=0.0, depth=1, eta=1.0, splits=None, cuts=None, leaves=None,
                 gains=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    @property
    def numTrees(self) -> int:
        return len(self.getOrDefault(self.leaves)) // 2 ** self.getOrDefault(self.depth)

    @property
    def featureImportances(self):
        """Share of the summed gain per feature (all zero without a split)."""
        gains = np.array(self.getOrDefault(self.gains))
        return Vectors.dense(gains / gains.sum() if gains.sum() else gains)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        n, inner = self.numTrees, 2 ** self.getOrDefault(self.depth) - 1
        lists = [np.array(self.getOrDefault(p)).reshape(n, -1 if n else size).tolist()
                 for p, size in ((self.splits, inner), (self.cuts, inner), (self.leaves, inner + 1))]
        # a cut of infinity sends every value left
        trees = [(f, [min(v, LARGEST) for v in c], v) for f, c, v in zip(*lists)]
        total = self._looked_up(trees)
        if total is None:
            total = self._walked(trees)
        score = F.lit(self.getOrDefault(self.base)) + self.getOrDefault(self.eta) * total
        return (dataset.withColumn("__x", vector_to_array(self.getFeaturesCol()))
                .withColumn(self.getPredictionCol(), score).drop("__x"))

    def _walked(self, trees: list[tuple]) -> Column:
        """Sum of the leaves that a row comes to."""
        depth = self.getOrDefault(self.depth)
        inner = 2 ** depth - 1
        trees = F.from_json(F.lit(json.dumps([{"f": f, "c": c, "v": v} for f, c, v in trees])),
                            "array<struct<f:array<int>,c:array<double>,v:array<double>>>")
        x, levels = F.col("__x"), F.array(*[F.lit(i) for i in range(depth)])

        def leaf(tree: Column) -> Column:
            node = F.aggregate(levels, F.lit(0), lambda at, _: 2 * at + F.when(
                F.get(x, F.get(tree["f"], at)) < F.get(tree["c"], at), 1).otherwise(2))
            return F.get(tree["v"], node - inner)

        return F.aggregate(trees, F.lit(0.0), lambda acc, tree: acc + leaf(tree))

    def _looked_up(self, trees: list[tuple]) -> Column | None:
        """The same sum from a table with a value for every combination of bins; None for too many."""
        depth, p = self.getOrDefault(self.depth), len(self.getOrDefault(self.gains))
        found = [set() for _ in range(p)]
        for features, tree_cuts, _ in trees:
            for j, c in zip(features, tree_cuts):
                found[j].add(c)
        cuts = [sorted(s) for s in found]
        shape = [len(c) + 1 for c in cuts]
        if not trees or math.prod(shape) > TABLE_CELLS:
            return None
        bin_of = [{c: i for i, c in enumerate(cs)} for cs in cuts]
        table, inner = np.zeros(shape), 2 ** depth - 1

        def add(tree, node, box):
            """Every leaf's value to its box of bins."""
            if node >= inner:
                table[tuple(slice(*b) for b in box)] += tree[2][node - inner]
                return
            j = tree[0][node]
            (low, high), cut = box[j], bin_of[j][tree[1][node]] + 1
            for child, side in ((2 * node + 1, (low, min(high, cut))),
                                (2 * node + 2, (max(low, cut), high))):
                if side[0] < side[1]:
                    add(tree, child, box[:j] + [side] + box[j + 1:])

        for tree in trees:
            add(tree, 0, [(0, size) for size in shape])
        place = F.lit(0)
        for j, cs in enumerate(cuts):
            x, one = F.get("__x", F.lit(j)), F.lit(1)
            at = F.aggregate(_literal(cs), F.lit(0), lambda n, c: n + F.when(
                x < c, 0).otherwise(one)) if cs else F.lit(0)
            place = place * shape[j] + at
        return F.get(F.from_json(F.lit(json.dumps(table.ravel().tolist())), "array<double>"), place)
