"""Quality classifier: a byte-level convolutional network in numpy.

A text's UTF-8 bytes go through ``FILTERS`` learned filters of ``WIDTH`` bytes (each byte
has a learned vector of ``DIM`` numbers) at every second byte.  Chunks of
``CHUNK`` units overlap by one unit and cover the whole text; a chunk keeps the largest
response of every filter.  The mean and the largest value over all chunks
give one probability.  No prefix, no sampling: every byte of a text is read.

Training uses a bounded sample of labelled rows: per class the ``PER_CLASS`` doc_ids of
smallest hash whose CRC-32 is not divisible by ``FOLDS``, with texts of at most
``TRAIN_BYTES`` bytes (a limit for training only).  They are fitted on the driver, with the odds of all
labelled rows outside the held-out fold; weights of some kilobytes go to the tasks.  Scoring is a column expression in the scan's
own tasks, without shuffle.

For scoring, the filters are folded into one table per pair of bytes, so a response is
the sum of ``WIDTH / 2`` table rows.

Edge cases: null and empty texts are scored as one chunk of padding; rows
without label, or with a null one, are scored and never learned from; a label table with a single class, or
none, gives a constant score (1.0 or 0.0; 0.5 without any label); repeated rows are
scored each; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scenecast.llm.common import require

DIM, FILTERS, WIDTH = 8, 16, 8
UNIT = 32            # windows (of two bytes' step) in a pooling unit
CHUNK = 4            # units in a chunk; neighbours share one unit
BLOCK = 1 << 18      # bytes in one matrix operation
FOLDS = 5
PER_CLASS = 1_000
TRAIN_BYTES = 16_384
EPOCHS, BATCH, RATE = 7, 32, 0.01
THRESHOLD = 0.3


@dataclass
class Network:
    """Weights; ``constant`` is set where there was nothing to learn."""

    byte_vectors: np.ndarray   # 256 x DIM
    filters: np.ndarray        # WIDTH * DIM x FILTERS
    bias: np.ndarray           # FILTERS
    weights: np.ndarray        # 2 * FILTERS
    offset: np.ndarray         # 1
    constant: float | None = None

    def parts(self) -> list[np.ndarray]:
        return [self.byte_vectors, self.filters, self.bias, self.weights, self.offset]


def _start(seed: int = 5) -> Network:
    rng = np.random.default_rng(seed)
    parts = (rng.normal(0, 0.5, (256, DIM)),
             rng.normal(0, (WIDTH * DIM) ** -0.5, (WIDTH * DIM, FILTERS)),
             np.zeros(FILTERS), rng.normal(0, 0.1, 2 * FILTERS), np.zeros(1))
    return Network(*(p.astype(np.float32) for p in parts))


def _padded(raw: bytes) -> np.ndarray:
    """Bytes and at least ``WIDTH`` zeros, filled up to whole units."""
    size = 2 * UNIT * -(-(len(raw) + WIDTH) // (2 * UNIT))
    out = np.zeros(size, dtype=np.uint8)
    out[:len(raw)] = np.frombuffer(raw, dtype=np.uint8)
    return out


def _edge_windows(texts: list[np.ndarray]) -> np.ndarray:
    """Windows at the end of each text that would read into the next one."""
    ends = np.cumsum([len(t) // 2 for t in texts])
    return (ends[:, None] - np.arange(1, WIDTH // 2)).reshape(-1)


def _chunks(n_units: int) -> tuple[np.ndarray, np.ndarray]:
    """First and end unit of every chunk."""
    first = np.arange(0, max(1, n_units - 1), CHUNK - 1)
    return first, np.minimum(first + CHUNK, n_units)


# --- training -------------------------------------------------------------

def _forward(net: Network, texts: list[np.ndarray]):
    x = np.concatenate([*texts, np.zeros(WIDTH, dtype=np.uint8)])
    n = (len(x) - WIDTH) // 2
    index = x[2 * np.arange(n)[:, None] + np.arange(WIDTH)]          # windows x WIDTH
    cols = net.byte_vectors[index].reshape(n, WIDTH * DIM)
    pre = cols @ net.filters + net.bias
    pre[_edge_windows(texts)] = -1e30
    units = pre.reshape(-1, UNIT, FILTERS)
    best = units.argmax(axis=1)                                        # unit x filter
    top = np.take_along_axis(units, best[:, None], axis=1)[:, 0]
    feats, trace, at = [], [], 0
    for t in texts:
        k = len(t) // (2 * UNIT)
        own = top[at:at + k]
        first, end = _chunks(k)
        spans = [own[a:b] for a, b in zip(first, end)]
        pooled = np.array([s.max(axis=0) for s in spans])
        where = np.array([a + s.argmax(axis=0) for a, s in zip(first, spans)]) + at
        relu = np.maximum(pooled, 0)
        feats.append(np.concatenate([relu.mean(axis=0), relu.max(axis=0)]))
        trace.append((relu, where))
        at += k
    feats = np.array(feats)
    return index, cols, best, feats, trace, 1 / (1 + np.exp(-(feats @ net.weights + net.offset[0])))


def _gradients(net: Network, texts: list[np.ndarray], y: np.ndarray) -> list[np.ndarray]:
    index, cols, best, feats, trace, prob = _forward(net, texts)
    delta = ((prob - y) / len(y)).astype(np.float32)
    d_feats = delta[:, None] * net.weights
    d_top = np.zeros((len(best), FILTERS), dtype=np.float32)
    lane = np.arange(FILTERS)
    for (relu, where), d in zip(trace, d_feats):
        d_relu = np.repeat(d[None, :FILTERS] / len(relu), len(relu), axis=0)
        d_relu[relu.argmax(axis=0), lane] += d[FILTERS:]
        d_relu[relu <= 0] = 0
        np.add.at(d_top, (where, lane[None, :]), d_relu)
    unit, lanes = np.nonzero(d_top)
    window = unit * UNIT + best[unit, lanes]
    value = d_top[unit, lanes]
    d_filters = np.zeros_like(net.filters)
    np.add.at(d_filters.T, lanes, cols[window] * value[:, None])
    d_cols = net.filters.T[lanes] * value[:, None]                    # hits x WIDTH*DIM
    d_bytes = np.zeros_like(net.byte_vectors)
    np.add.at(d_bytes, index[window].reshape(-1), d_cols.reshape(-1, DIM))
    return [d_bytes, d_filters, d_top.sum(axis=0), feats.T @ delta, np.array([delta.sum()])]


def fit(texts: list[bytes], labels: list[int], odds: float = 1.0, seed: int = 5) -> Network:
    """Train on (text, label) pairs with Adam; the same input gives the same network.

    ``odds``: how many rows of label 1 there are for one of label 0; the sample's own
    odds are replaced by them, so that scores are probabilities for the whole table.
    """
    y = np.array(labels, dtype=np.float32)
    net = _start(seed)
    if len(set(labels)) < 2:
        net.constant = float(y[0]) if len(y) else 0.5
        return net
    data = [_padded(t) for t in texts]
    weight = [np.zeros_like(p) for p in net.parts()], [np.zeros_like(p) for p in net.parts()]
    rng, step = np.random.default_rng(seed), 0
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        order = rng.permutation(len(data))
        for i in range(0, len(order), BATCH):
            rows = order[i:i + BATCH]
            step += 1
            grads = _gradients(net, [data[r] for r in rows], y[rows])
            for p, g, m, v in zip(net.parts(), grads, *weight):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    net.offset += np.float32(np.log(odds * (1 - y.mean()) / y.mean()))
    return net


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", per_class: int = PER_CLASS) -> Network:
    """Fit on the bounded sample of labelled rows outside the held-out fold."""
    require(docs, id_col, text_col)
    require(labels, id_col, label_col)
    known = (labels.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_y"))
             .filter(F.col("_id").isNotNull() & F.col("_y").isin(0, 1))
             .filter(~held_out(F.col("_id")))
             .groupBy("_id").agg(F.max("_y").alias("_y")))
    texts = (docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t"))
             .filter(F.octet_length("_t") <= TRAIN_BYTES))
    # one text an id, by its hash, before any id is picked
    short = texts.groupBy("_id").agg(F.min(F.xxhash64("_t")).alias("_h"))
    usable = known.join(short, "_id")
    order = [F.xxhash64("_id"), F.col("_id")]
    picked = [r for y in (0, 1) for r in usable.filter(F.col("_y") == y).orderBy(*order)
              .limit(per_class).collect()]
    picked = docs.sparkSession.createDataFrame(picked, usable.schema)
    rows = (texts.withColumn("_h", F.xxhash64("_t"))
            .join(F.broadcast(picked), ["_id", "_h"])     # at most 2 * per_class ids
            .groupBy("_id", "_y").agg(F.array_min(F.collect_set("_t")).alias("_t"))
            .orderBy("_id").collect())
    ones, zeros = known.agg(F.sum("_y"), F.sum(1 - F.col("_y"))).first()
    odds = ones / zeros if ones and zeros else 1.0
    return fit([r["_t"].encode() for r in rows], [r["_y"] for r in rows], odds)


# --- scoring --------------------------------------------------------------

class Scorer:
    """The network with its filters folded into one table per byte pair and place."""

    def __init__(self, net: Network):
        self.net = net
        low, high = np.arange(65_536) & 255, np.arange(65_536) >> 8
        per_byte = [net.byte_vectors @ net.filters[j * DIM:(j + 1) * DIM] for j in range(WIDTH)]
        self.tables = [(per_byte[2 * k][low] + per_byte[2 * k + 1][high]).astype(np.float32)
                       for k in range(WIDTH // 2)]
        self.bias = net.bias.astype(np.float32)

    def _unit_tops(self, texts: list[np.ndarray]) -> np.ndarray:
        """Largest response per unit and filter over some padded texts."""
        x, edge = np.concatenate(texts), _edge_windows(texts)
        pairs = np.concatenate([x, np.zeros(WIDTH, dtype=np.uint8)]).view("<u2")
        step, tops = BLOCK // 2, []
        for a in range(0, len(x) // 2, step):
            n = min(step, len(x) // 2 - a)
            total = self.tables[0].take(pairs[a:a + n], axis=0)
            for k in range(1, len(self.tables)):
                total += self.tables[k].take(pairs[a + k:a + k + n], axis=0)
            total[edge[(edge >= a) & (edge < a + n)] - a] = -1e30
            tops.append(total.reshape(-1, UNIT, FILTERS).max(axis=1))
        return np.concatenate(tops) + self.bias

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """Probabilities of a list of texts, some megabytes at a time."""
        out = np.empty(len(texts))
        i = 0
        while i < len(texts):
            group, size = [], 0
            while i + len(group) < len(texts) and (not group or size < 4 * BLOCK):
                group.append(_padded(texts[i + len(group)]))
                size += len(group[-1])
            tops, at = self._unit_tops(group), 0
            for j, t in enumerate(group):
                k = len(t) // (2 * UNIT)
                first, end = _chunks(k)
                # padding units take part in no maximum
                fill = np.full((CHUNK, FILTERS), -np.inf, dtype=np.float32)
                own = np.concatenate([tops[at:at + k], fill])
                pooled = own[first]
                for s in range(1, CHUNK):
                    pooled = np.maximum(pooled, own[np.minimum(first + s, k)])
                relu = np.maximum(pooled, 0).astype(float)
                feats = np.concatenate([relu.mean(axis=0), relu.max(axis=0)])
                out[i + j] = 1 / (1 + np.exp(-(feats @ self.net.weights + self.net.offset[0])))
                at += k
            i += len(group)
        return out


def score_column(text: Column, net: Network) -> Column:
    """Column expression: probability of label 1 for a text column."""
    if net.constant is not None:
        return F.lit(net.constant)
    made: list[Scorer] = []

    @F.arrow_udf("double")
    def run(texts: pa.Array) -> pa.Array:
        if not made:
            made.append(Scorer(net))
        return pa.array(made[0].scores([(t.as_py() or "").encode() for t in texts]))
    return run(text)


def held_out(id_value: Column) -> Column:
    """Whether crc32(id as text) is divisible by ``FOLDS`` (null ids are not held out)."""
    return F.coalesce(F.pmod(F.crc32(id_value.cast("string").cast("binary")),
                             F.lit(FOLDS)) == 0, F.lit(False))


def score_documents(docs: DataFrame, net: Network, text_col: str = "text",
                    threshold: float = THRESHOLD) -> DataFrame:
    """Add ``score`` and ``predicted`` (1 where score >= threshold) to every row."""
    require(docs, text_col)
    scored = docs.withColumn("score", score_column(F.col(text_col), net))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
