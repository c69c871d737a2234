"""Toxicity: gradient-boosted trees over dense features, calibrated by isotonic regression.

**Features** of a whole text: densities, counts and weights of lexicon words, of stems (a
word's first letters) and of words that are found only after letters written as digits or
signs are put back; how near they stand to a second-person word; capitals,
punctuation, repeated letters, words broken by signs, and the text's length.

**Lexicon.**  Words and stems with their log odds of standing in a toxic text, counted by Spark over
the training sample, by documents, once a distinct text.  The best ``LEXICON`` entries are kept.

**Training.**  A bounded sample of labelled rows: per class the ``PER_CLASS`` ids of smallest hash whose
CRC-32 is not divisible by ``FOLDS``; whole texts, read in Spark tasks.  Only feature vectors come to
the driver.  A text's features for training use a lexicon counted without
its own part of the sample, and so do the scores that the calibration is fitted on.  The
trees are second-order boosted ones on binned features; rows are weighted to the odds of all
labelled rows outside the held-out fold.

**Scoring** is a column expression in the scan's own tasks, without shuffle: one dictionary look-up a
word.

Edge cases: null and empty texts are scored as texts without words; an id labelled both 0 and 1
counts as 1; null labels, null ids and ids without a document are left out; a label table with a
single class, or none, gives a constant score (1.0 or 0.0; 0.5 without any label); repeated rows
are scored each; an empty table gives an empty result; very long texts are read whole; columns
named ``score`` or ``predicted`` are replaced.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scenecast.llm.common import require, stored
from scenecast.llm.quality import FOLDS, held_out

PER_CLASS = 2_000
LEXICON = 4_000           # entries
MIN_DOCS = 3              # distinct texts of the sample that an entry stands in
MIN_ODDS = 1.5            # log odds of an entry
PARTS = 4                 # parts of the sample for lexicons and calibration
STEMS = (4, 5, 6)         # letters of a stem
TREES, DEPTH, RATE, L2, BINS = 60, 3, 0.2, 1.0, 32
NEAR = 5                  # words between a lexicon word and a second-person word
THRESHOLD = 0.5
MEMO = 200_000            # tokens whose look-ups a task keeps

# Second-person words of English, German, French and Spanish.
SECOND_PERSON = frozenset(
    "you your yours yourself ya u ur du dich dir dein deine deinen ihr euch euer tu te toi ton ta "
    "tes vous votre vos tú ti contigo usted ustedes vosotros os su vuestro".split())
# Digits and signs that stand for letters.
LOOKALIKES = str.maketrans("0134578@$!|+", "oieastbasilt")

SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_SIGN_BYTES, _CAPITALS = SIGNS.encode(), bytes(range(65, 91))
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_REPEAT = re.compile(r"(.)\1{2,}")
_MARKS = re.compile(r"[!?]{2,}")

FEATURES = ("words", "hits", "hit density", "distinct hits", "largest weight", "mean weight",
            "weight sum", "stem density", "hidden hits", "near you", "you density", "capitals",
            "capital words", "signs", "marks", "repeated letters", "broken words")


@dataclass
class Token:
    """What one token adds to a text's features."""

    weight: float = 0.0
    stem: bool = False
    hidden: bool = False
    you: bool = False
    shouted: bool = False
    repeated: bool = False
    broken: bool = False


def entries(word: str) -> list[str]:
    """Lexicon entries of a word: itself and its stems."""
    return [word + "$"] + [word[:k] for k in STEMS if len(word) > k]


def _weight(spelled: str, lexicon: dict[str, float]) -> tuple[float, bool]:
    """Largest weight among a spelling's entries, and whether a stem has it; (0, False) if none."""
    return max([(lexicon[e], not e.endswith("$")) for e in entries(spelled) if e in lexicon],
               default=(0.0, False))


def look_up(token: str, lexicon: dict[str, float]) -> Token:
    """A token's features; a token that is no entry is tried with its letters put back."""
    core = token.strip(SIGNS)
    if not core.isalnum():
        core = _EDGE.sub("", token)
    word = core.lower()
    out = Token(you=word in SECOND_PERSON, repeated=bool(_REPEAT.search(word)),
                shouted=len(core) > 1 and core.isupper(),
                broken=not core.isalpha() and not core.isdigit() and any(map(str.isalpha, core)))
    out.weight, out.stem = _weight(word, lexicon) if word else (0.0, False)
    if not out.weight and out.repeated:
        out.weight, out.stem = _weight(_REPEAT.sub(r"\1", word), lexicon)
        out.hidden = out.weight > 0
    if not out.weight and out.broken:
        spelled = re.sub(r"[\W_]", "", token.lower().translate(LOOKALIKES))
        out.weight, out.stem = _weight(spelled, lexicon)
        out.hidden = out.weight > 0
    return out


class Reader:
    """Feature vectors of texts under one lexicon, with a bounded memo of tokens."""

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon = lexicon
        self.memo: dict[str, Token | None] = {}
        self.plain = Token()

    def token(self, t: str) -> Token | None:
        """None for a token that adds nothing."""
        made = look_up(t, self.lexicon)
        out = None if made == self.plain else made
        if len(self.memo) < MEMO:
            self.memo[t] = out
        return out

    def features(self, text: str) -> list[float]:
        tokens = text.split()
        memo, special = self.memo, []
        for i, t in enumerate(tokens):
            known = memo[t] if t in memo else self.token(t)
            if known is not None:
                special.append((i, t, known))
        hits = [(i, t, k) for i, t, k in special if k.weight]
        you = [i for i, _, k in special if k.you]
        near = 0
        for i, _, _ in hits:
            at = bisect_left(you, i)
            near += any(abs(i - j) <= NEAR for j in you[max(0, at - 1):at + 1])
        n, raw = max(1, len(tokens)), text.encode()
        chars = max(1, len(raw))
        weights = [k.weight for _, _, k in hits]
        total = sum(weights)
        return [math.log1p(len(tokens)), len(hits), len(hits) / n,
                len({t for _, t, _ in hits}), max(weights, default=0.0),
                total / max(1, len(hits)), total, sum(k.stem for _, _, k in hits) / n,
                sum(k.hidden for _, _, k in hits), near, len(you) / n,
                (len(raw) - len(raw.translate(None, _CAPITALS))) / chars,
                sum(k.shouted for _, _, k in special) / n,
                (len(raw) - len(raw.translate(None, _SIGN_BYTES))) / chars, len(_MARKS.findall(text)) / n,
                sum(k.repeated for _, _, k in special) / n,
                sum(k.broken for _, _, k in special) / n]


# --- trees and calibration -------------------------------------------------

@dataclass
class Tree:
    """A full tree of ``DEPTH`` levels: a split (feature, cut) a node, a value a leaf."""

    features: np.ndarray
    cuts: np.ndarray
    values: np.ndarray

    def margins(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), dtype=np.int64)
        rows = np.arange(len(x))
        for _ in range(DEPTH):
            right = x[rows, self.features[at]] > self.cuts[at]
            at = 2 * at + 1 + right
        return self.values[at - (2 ** DEPTH - 1)]


def _grow(x, bins, edges, grad, hess) -> Tree:
    """One tree on gradients and hessians, level by level from histograms of bins."""
    n_rows, n_feats = bins.shape
    inner = 2 ** DEPTH - 1
    features, cuts = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf)
    at = np.zeros(n_rows, dtype=np.int64)
    rows = np.arange(n_rows)
    for level in range(DEPTH):
        first, width = 2 ** level - 1, 2 ** level
        cell = ((at - first)[:, None] * n_feats + np.arange(n_feats)) * BINS + bins
        shape = (width, n_feats, BINS)
        g = np.bincount(cell.ravel(), np.repeat(grad, n_feats), np.prod(shape)).reshape(shape)
        h = np.bincount(cell.ravel(), np.repeat(hess, n_feats), np.prod(shape)).reshape(shape)
        left_g, left_h = g.cumsum(axis=2), h.cumsum(axis=2)
        all_g, all_h = left_g[:, :, -1:], left_h[:, :, -1:]
        gain = (left_g ** 2 / (left_h + L2) + (all_g - left_g) ** 2 / (all_h - left_h + L2)
                - all_g ** 2 / (all_h + L2))
        gain[(left_h < 1e-3) | (all_h - left_h < 1e-3)] = 0
        best = gain.reshape(width, -1).argmax(axis=1)
        for node, b in enumerate(best):
            if gain.reshape(width, -1)[node, b] > 1e-9:
                features[first + node], cut = divmod(b, BINS)
                cuts[first + node] = edges[features[first + node]][cut]
        at = 2 * at + 1 + (x[rows, features[at]] > cuts[at])
    leaf = at - inner
    g = np.bincount(leaf, grad, 2 ** DEPTH)
    h = np.bincount(leaf, hess, 2 ** DEPTH)
    return Tree(features, cuts, -RATE * g / (h + L2))


def boost(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[Tree]:
    """Second-order boosting of the logistic loss on weighted rows."""
    edges = []
    for column in x.T:
        cuts = np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1]))
        edges.append(np.concatenate([cuts, np.full(BINS - len(cuts), np.inf)]))
    bins = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)], axis=1)
    bins = np.minimum(bins, BINS - 1)
    margin, trees = np.zeros(len(y)), []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        trees.append(_grow(x, bins, edges, weight * (p - y), weight * p * (1 - p)))
        margin += trees[-1].margins(x)
    return trees


def margins(trees: list[Tree], x: np.ndarray) -> np.ndarray:
    return sum((t.margins(x) for t in trees), np.zeros(len(x)))


def isotonic(margin: np.ndarray, y: np.ndarray, weight: np.ndarray
             ) -> tuple[np.ndarray, np.ndarray]:
    """The non-decreasing curve nearest to the labels: (margins, probabilities), to interpolate.

    Neighbouring blocks that decrease are pooled; a block is drawn from its first to its last margin.
    One row of each label on both ends keeps probabilities off 0 and 1.
    """
    blocks: list[list[float]] = []           # weighted labels, weight, first, last margin
    for m in np.unique(margin):
        rows = margin == m
        blocks.append([float((weight * y)[rows].sum()), float(weight[rows].sum()), m, m])
        while len(blocks) > 1 and (blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]):
            ones, w, _, last = blocks.pop()
            blocks[-1][0] += ones
            blocks[-1][1] += w
            blocks[-1][3] = last
    total = float(weight.sum())
    prior = float((weight * y).sum()) / total if total else 0.5
    at, value = [], []
    for ones, w, first, last in blocks:
        p = (ones + prior) / (w + 1)
        at += [first, last] if last > first else [first]
        value += [p, p] if last > first else [p]
    return np.array(at), np.maximum.accumulate(np.array(value))


@dataclass
class Model:
    """A trained scorer; ``constant`` is set where there was nothing to learn."""

    lexicon: dict[str, float] = field(default_factory=dict)
    trees: list[Tree] = field(default_factory=list)
    curve: tuple[np.ndarray, np.ndarray] | None = None
    constant: float | None = None

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return np.interp(margins(self.trees, x), *self.curve)


# --- training -----------------------------------------------------------------

def sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
           per_class: int) -> tuple[DataFrame, float, float]:
    """(_id, _y, _t) of the training sample, written once, and all rows of label 1 and 0."""
    known = (labels.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_y"))
             .filter(F.col("_id").isNotNull() & F.col("_y").isin(0, 1))
             .filter(~held_out(F.col("_id")))
             .groupBy("_id").agg(F.max("_y").cast("int").alias("_y")))
    texts = docs.select(F.col(id_col).alias("_id"), F.coalesce(text_col, F.lit("")).alias("_t"))
    # one text an id, by its hash, before any id is picked
    usable = known.join(texts.groupBy("_id").agg(F.min(F.xxhash64("_t")).alias("_h")), "_id")
    order = [F.xxhash64("_id"), F.col("_id")]
    picked = [r for y in (0, 1) for r in usable.filter(F.col("_y") == y).orderBy(*order)
              .limit(per_class).collect()]
    picked = docs.sparkSession.createDataFrame(picked, usable.schema)
    rows = (texts.withColumn("_h", F.xxhash64("_t"))
            .join(F.broadcast(picked), ["_id", "_h"])      # at most 2 * per_class ids
            .groupBy("_id", "_y").agg(F.min("_t").alias("_t")))
    ones, zeros = known.agg(F.sum("_y"), F.sum(1 - F.col("_y"))).first()
    return stored(rows, "toxicity-sample"), float(ones or 0), float(zeros or 0)


def part_of(text: Column) -> Column:
    """Part of the sample that a text belongs to; copies stay together."""
    return F.pmod(F.xxhash64(text), F.lit(PARTS)).cast("int")


def entry_counts(rows: DataFrame) -> DataFrame:
    """(entry, part, toxic and clean texts it stands in), once a distinct text."""
    @F.arrow_udf("array<string>")
    def listed(texts: pa.Array) -> pa.Array:
        out = []
        for t in texts:
            words = {_EDGE.sub("", w).lower() for w in (t.as_py() or "").split()}
            out.append(sorted({e for w in words if w for e in entries(w)}))
        return pa.array(out, pa.list_(pa.string()))
    return (rows.groupBy("_t").agg(F.max("_y").alias("_y"))
            .select("_y", part_of(F.col("_t")).alias("part"), F.explode(listed("_t")).alias("entry"))
            .groupBy("entry", "part").agg(F.sum("_y").alias("ones"),
                                          F.sum(1 - F.col("_y")).alias("zeros")))


def lexicon_of(counts: DataFrame, sizes: dict[int, tuple[int, int]], without: int | None
               ) -> dict[str, float]:
    """The entries of largest log odds times root of texts, at most ``LEXICON``."""
    used = [n for p, n in sizes.items() if p != without]
    n1, n0 = sum(n[0] for n in used), sum(n[1] for n in used)
    rows = counts if without is None else counts.filter(F.col("part") != without)
    odds = (F.log((F.col("ones") + 0.5) / (n1 + 1.0))
            - F.log((F.col("zeros") + 0.5) / (n0 + 1.0)))
    best = (rows.groupBy("entry").agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros"))
            .filter(F.col("ones") + F.col("zeros") >= MIN_DOCS).withColumn("odds", odds)
            .filter(F.col("odds") >= MIN_ODDS)
            .orderBy((F.col("odds") * F.sqrt("ones")).desc(), "entry").limit(LEXICON))
    return {r["entry"]: r["odds"] for r in best.select("entry", "odds").collect()}


def features_column(text: Column, readers: Column, lexicons: list[dict[str, float]]) -> Column:
    """Column expression: the features of a text under the lexicon of number ``readers``."""
    made: list[Reader] = []

    @F.arrow_udf("array<double>")
    def run(texts: pa.Array, which: pa.Array) -> pa.Array:
        if not made:
            made.extend(map(Reader, lexicons))
        return pa.array([made[k].features(t.as_py() or "")
                         for t, k in zip(texts, which.to_pylist())], pa.list_(pa.float64()))
    return run(text, readers)


def fit(x: np.ndarray, y: np.ndarray, part: np.ndarray, weight: np.ndarray
        ) -> tuple[list[Tree], tuple[np.ndarray, np.ndarray]]:
    """Trees on all rows, and the curve of the margins each part gets from the other parts' trees."""
    outside = np.zeros(len(y))
    for p in np.unique(part):
        own = part == p
        outside[own] = margins(boost(x[~own], y[~own], weight[~own]), x[own])
    return boost(x, y, weight), isotonic(outside, y, weight)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", per_class: int = PER_CLASS) -> Model:
    """Fit on the bounded sample of labelled rows outside the held-out fold."""
    require(docs, id_col, text_col)
    require(labels, id_col, label_col)
    rows, ones, zeros = sample(docs, labels, id_col, text_col, label_col, per_class)
    sizes = {r["part"]: (r["ones"], r["zeros"]) for r in rows.groupBy("_t").agg(
        F.max("_y").alias("_y")).groupBy(part_of(F.col("_t")).alias("part")).agg(
            F.sum("_y").alias("ones"), F.sum(1 - F.col("_y")).alias("zeros")).collect()}
    if not all(sum(n[k] for n in sizes.values()) for k in (0, 1)):
        return Model(constant=0.5 if not sizes else float(any(n[0] for n in sizes.values())))
    counts = stored(entry_counts(rows), "toxicity-entries")
    # one lexicon without each part, for that part's own texts, and one of all parts
    lexicons = [lexicon_of(counts, sizes, p) for p in range(PARTS)]
    part = part_of(F.col("_t"))
    made = rows.select("_id", "_y", part.alias("part"), features_column(
        F.col("_t"), part, lexicons).alias("x")).orderBy("_id").collect()
    x = np.array([r["x"] for r in made])
    y = np.array([r["_y"] for r in made], dtype=float)
    share = {1: ones / (y == 1).sum(), 0: zeros / (y == 0).sum()}
    weight = np.where(y == 1, share[1], share[0])
    weight /= weight.mean()
    trees, curve = fit(x, y, np.array([r["part"] for r in made]), weight)
    return Model(lexicon_of(counts, sizes, None), trees, curve)


# --- scoring --------------------------------------------------------------

def score_column(text: Column, model: Model) -> Column:
    """Column expression: probability of label 1 for a text column."""
    if model.constant is not None:
        return F.lit(model.constant)
    made: list[Reader] = []

    @F.arrow_udf("double")
    def run(texts: pa.Array) -> pa.Array:
        if not made:
            made.append(Reader(model.lexicon))
        x = [made[0].features(t.as_py() or "") for t in texts]
        return pa.array(model.probabilities(np.array(x)) if x else [], pa.float64())
    return run(text)


def score_documents(docs: DataFrame, model: Model, text_col: str = "text",
                    threshold: float = THRESHOLD) -> DataFrame:
    """Add ``score`` and ``predicted`` (1 where score >= threshold) to every row."""
    require(docs, text_col)
    scored = docs.withColumn("score", score_column(F.col(text_col), model))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
