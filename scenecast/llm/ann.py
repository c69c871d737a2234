"""Approximate nearest neighbours by multiprobe p-stable hashing.

Vectors are scaled to length one, where Euclidean distance orders like cosine.  Each of
several tables hashes a vector by Gaussian projections cut into steps of one width.  Besides its own bucket, a query visits perturbed buckets (one step up or down in
some projections) in the order of their estimated success: a perturbation costs the
squared distances to the boundaries it crosses, and the cheapest sets are taken.
All rows of a visited bucket are candidates; their exact cosine in double precision on the
original vectors ranks them.

Parameters follow the data.  ``profile`` compares a bounded sample of ``PROFILE`` vectors with all
vectors in one pass, which gives the distances of true neighbours and of any two rows;
``chosen`` simulates the hashing at these distances and takes, of all settings whose
expected recall is ``RECALL`` or more, the one with the least work for this number of rows:
with more rows, finer buckets and more probes, so the visited share falls.

Distribution.  Buckets are joined, not gathered: index rows and probes meet per
(table, bucket, block).  A bucket with many rows or many probes is dealt into blocks of
at most ``BLOCK_ROWS`` rows and ``BLOCK_PROBES`` probes, so a bucket that holds a third of all
rows is many tasks.  A block returns at most k rows per probe.  Equal vectors are ranked by
vec_id alone, so only the k + 1 smallest ids of each vector are indexed: none of the others
can be among k nearest (exact, and it is a group limit that works before the shuffle).

Queries left with fewer than k rows (vectors of a rare length, small tables, outliers) are
compared with all indexed vectors of their length, in the same blocks.

Edge cases: vectors that are null, empty, zero or hold null or non-finite components take no part, nor do
null ids; vectors of different length are never compared; repeated (vec_id, vector) rows
are one row; rows that share a vec_id but not the vector are rows of their own, as queries (told
apart by ``query_hash``) and as candidates of each other; a query
with fewer candidates in all returns all of them; ties go to the smaller vec_id; an empty
table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import product
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scenecast.llm.common import require, stored

PROFILE, RECALL = 48, 0.95
# Settings to choose from, and the work of a row written and of a bucket, in comparisons.
TABLES, HASHES, WIDTHS = range(2, 9), range(2, 8), (0.5, 0.7, 1.0, 1.4, 2.0, 2.8)
PROBES = (1, 4, 8, 16, 32, 64, 128, 256)
ROW_WORK, BUCKET_WORK = 100, 3_000
BLOCK_ROWS, BLOCK_PROBES = 4_096, 1_024
SEED = 17


def projections(dim: int, tables: int, hashes: int, width: float, seed: int = SEED
                ) -> tuple[np.ndarray, np.ndarray]:
    """Projection vectors and offsets in units of a step, the same in every task."""
    rng = np.random.default_rng([seed, dim])
    return (rng.normal(size=(dim, tables, hashes)) / width,
            rng.uniform(0, 1, size=(tables, hashes)))


def probe_sets(inside: np.ndarray, n: int) -> Iterator[tuple[tuple[int, int], ...]]:
    """Perturbation sets ((projection, step), ...) by rising cost, the empty one first.

    ``inside``: place of the query in its step per projection, 0 to 1.
    """
    moves = sorted([(x * x, i, -1) for i, x in enumerate(inside)]
                   + [((1 - x) ** 2, i, 1) for i, x in enumerate(inside)])
    yield ()
    heap, left = [(moves[0][0], (0,))], n - 1
    while heap and left:
        cost, picked = heapq.heappop(heap)
        used = [moves[k][1] for k in picked]
        if len(set(used)) == len(used):      # never both ways in one projection
            yield tuple((moves[k][1], moves[k][2]) for k in picked)
            left -= 1
        last = picked[-1]
        if last + 1 < len(moves):
            shift = moves[last + 1][0]
            heapq.heappush(heap, (cost - moves[last][0] + shift, picked[:-1] + (last + 1,)))
            heapq.heappush(heap, (cost + shift, picked + (last + 1,)))


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, h, v) of the rows that take part, ``h`` the vector's hash; no row twice."""
    v = F.col("v")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists(v, lambda x: x != 0)
    return (vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("v"))
            .filter(F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & fine & some)
            .select("vec_id", F.xxhash64("v").alias("h"), "v").distinct())


def _matrix(column: pa.Array, rows: np.ndarray) -> np.ndarray:
    """The given rows (all of one length) of a list column as a double matrix."""
    part = column.take(pa.array(rows))
    return part.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), -1)


def _unit(v: np.ndarray) -> np.ndarray:
    # scaled by the largest component first, so that no square overflows
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


# --- parameters from the data ----------------------------------------------

class Setting(NamedTuple):
    """Parameters of a search, with the recall and the share of rows visited to expect."""
    tables: int
    hashes: int
    width: float
    probes: int
    recall: float = 1.0
    share: float = 1.0


def profile(rows: DataFrame, k: int, sample: int = PROFILE) -> tuple[int, np.ndarray, np.ndarray]:
    """(number, distances to the k nearest, distances of any two) of vectors of the commonest length.

    Distances of a sample of ``sample`` vectors, the nearest over all rows.
    """
    common = (rows.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n"))
              .orderBy(F.col("n").desc(), "dim").first())
    if common is None:
        return 0, np.zeros(0), np.zeros(0)
    same = rows.filter(F.size("v") == common.dim)
    picked = same.orderBy(F.xxhash64("h", "vec_id"), "vec_id").limit(sample).collect()
    unit = _unit(np.array([r.v for r in picked], dtype=np.float64))
    own = {(r.vec_id, r.h): i for i, r in enumerate(picked)}
    own_hashes = np.array([r.h for r in picked])

    def nearest_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            gap = np.sqrt(np.maximum(2 - 2 * unit @ _unit(
                _matrix(batch.column("v"), np.arange(batch.num_rows))).T, 0))
            ids, hashes = batch.column("vec_id").to_numpy(), batch.column("h").to_numpy()
            for j in np.flatnonzero(np.isin(hashes, own_hashes)):
                if (ids[j], hashes[j]) in own:
                    gap[own[ids[j], hashes[j]], j] = np.inf
            gap = np.sort(gap, axis=1)[:, :k]
            at, _ = found = np.nonzero(np.isfinite(gap))
            yield pa.record_batch({"s": pa.array(at.astype(np.int32)), "gap": pa.array(gap[found])})

    order = Window.partitionBy("s").orderBy("gap")
    near = (same.select("vec_id", "h", "v").mapInArrow(nearest_of, "s int, gap double")
            .withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k).collect())
    two = np.triu_indices(len(unit), 1)
    any_two = np.sqrt(np.maximum(2 - 2 * (unit @ unit.T)[two], 0))
    return common.n, np.array([r.gap for r in near]), any_two


def hit_rates(gaps: np.ndarray, hashes: int, width: float, draws: int = 60) -> np.ndarray:
    """Chance that a row at each distance lies in a probed bucket of one table, per ``PROBES``."""
    rng = np.random.default_rng([SEED, hashes])
    steps = np.array(list(product((-1, 0, 1), repeat=hashes)))
    inside = rng.uniform(size=(len(gaps) * draws, hashes))
    moved = np.floor(inside + rng.normal(size=inside.shape) * np.repeat(gaps, draws)[:, None]
                     / width).astype(np.int64)
    cost = (inside ** 2) @ (steps == -1).T + ((1 - inside) ** 2) @ (steps == 1).T
    place = (np.clip(moved, -1, 1) + 1) @ (3 ** np.arange(hashes - 1, -1, -1))
    before = (cost < cost[np.arange(len(place)), place][:, None]).sum(axis=1)
    before[np.abs(moved).max(axis=1) > 1] = np.iinfo(np.int64).max
    return np.stack([(before < p).reshape(len(gaps), draws).mean(axis=1) for p in PROBES], axis=1)


def chosen(n: int, queries: float, near: np.ndarray, any_two: np.ndarray,
           recall: float = RECALL) -> Setting:
    """The setting of least expected work that finds ``recall`` of the neighbours."""
    if not len(near) or not len(any_two):
        return Setting(TABLES[0], HASHES[0], WIDTHS[-1], PROBES[1])
    at = (np.arange(24) + 0.5) / 24
    near, any_two = np.quantile(near, at), np.quantile(any_two, at)
    best, least, widest = None, np.inf, None
    for hashes in HASHES:
        for width in WIDTHS:
            hit = hit_rates(near, hashes, width)
            visit = hit_rates(any_two, hashes, width).mean(axis=0)
            buckets = min(n, (1 + 4 / width) ** hashes)
            for tables in TABLES:
                found = (1 - (1 - hit) ** tables).mean(axis=0)
                for j, probes in enumerate(PROBES):
                    if probes > 3 ** hashes:
                        continue
                    setting = Setting(tables, hashes, width, probes, float(found[j]),
                                      float(1 - (1 - visit[j]) ** tables))
                    if widest is None or found[j] > widest.recall:
                        widest = setting
                    work = tables * (queries * n * visit[j] + ROW_WORK * (n + queries * probes)
                                     + BUCKET_WORK * buckets)
                    if found[j] >= recall and work < least:
                        best, least = setting, work
    return best or widest


def _hasher(probes: int, tables: int, hashes: int, width: float):
    """mapInArrow function: rows (vec_id, h, v) to (vec_id, h, tab, bucket, v), ``probes`` per table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array(batch.column("v").value_lengths())
            for dim in np.unique(sizes):
                rows = np.flatnonzero(sizes == dim)
                for a in range(0, len(rows), 512):
                    yield place(batch, rows[a:a + 512], int(dim))

    def place(batch: pa.RecordBatch, rows: np.ndarray, dim: int) -> pa.RecordBatch:
        v = _matrix(batch.column("v"), rows)
        v = _unit(v)
        axes, offset = projections(dim, tables, hashes, width)
        at = np.tensordot(v, axes, axes=1) + offset
        step = np.floor(at).astype(np.int64)
        inside = at - step
        source, table, bucket = [], [], []
        for r in range(len(rows)):
            for t in range(tables):
                for moves in probe_sets(inside[r, t], probes) if probes > 1 else ((),):
                    code = step[r, t].copy()
                    for i, by in moves:
                        code[i] += by
                    source.append(rows[r])
                    table.append(t)
                    bucket.append(f"{dim}:" + ",".join(map(str, code)))
        take = pa.array(source)
        return pa.record_batch({"vec_id": batch.column("vec_id").take(take),
                                "h": batch.column("h").take(take),
                                "tab": pa.array(table, pa.int32()), "bucket": pa.array(bucket),
                                "v": batch.column("v").take(take)})
    return run


def _best_in_block(k: int):
    def run(key, index: pd.DataFrame, probes: pd.DataFrame) -> pd.DataFrame:
        if not len(index) or not len(probes):
            return pd.DataFrame({c: [] for c in ("query_id", "query_hash", "vec_id", "h", "score")})
        a = np.stack(probes["v"].to_list()).astype(np.float64)
        b = np.stack(index["v"].to_list()).astype(np.float64)
        qid, vid = probes["vec_id"].to_numpy(), index["vec_id"].to_numpy()
        qh, vh = probes["h"].to_numpy(), index["h"].to_numpy()
        sa, sb = np.abs(a).max(axis=1), np.abs(b).max(axis=1)
        near = (a / sa[:, None]) @ (b / sb[:, None]).T
        near /= np.sqrt(((a / sa[:, None]) ** 2).sum(axis=1))[:, None]
        near /= np.sqrt(((b / sb[:, None]) ** 2).sum(axis=1))[None, :]
        near[(qid[:, None] == vid[None, :]) & (qh[:, None] == vh[None, :])] = -np.inf
        if len(vid) > k:
            least = -np.partition(-near, k - 1, axis=1)[:, k - 1]
        else:
            least = np.full(len(qid), -2.0)
        q, i = np.nonzero((near >= least[:, None] - 1e-9) & np.isfinite(near))
        score = exact_cosine(a[q], b[i])
        out = pd.DataFrame({"query_id": qid[q], "query_hash": qh[q], "vec_id": vid[i], "h": vh[i],
                            "score": score})
        out = out.sort_values(["query_id", "query_hash", "score", "vec_id", "h"],
                              ascending=[True, True, False, True, True])
        return out.groupby(["query_id", "query_hash"], sort=False).head(k)
    return run


def exact_cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of row pairs in double precision, by the same sums for equal vectors.

    Rows are scaled by a power of two first (no rounding), so that no product overflows or
    vanishes.
    """
    if not len(a):
        return np.zeros(0)
    a, b = (np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None]) for x in (a, b))
    dot = (a * b).sum(axis=1)
    return dot / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def nearest(vectors: DataFrame, every: int = 50, k: int = 5, id_col: str = "vec_id",
            vec_col: str = "embedding", setting: Setting | None = None,
            block_rows: int = BLOCK_ROWS, block_probes: int = BLOCK_PROBES) -> DataFrame:
    """The ``k`` nearest found of every row whose id is divisible by ``every``.

    Returns query_id, rank (from 1), vec_id, score, query_hash.  ``setting``: parameters to use
    instead of those chosen from the data.
    """
    require(vectors, id_col, vec_col)
    rows = stored(usable(vectors, id_col, vec_col), "ann-vectors")
    kind = rows.schema["v"].dataType.simpleString()
    shape = f"vec_id bigint, h bigint, tab int, bucket string, v {kind}"
    same = Window.partitionBy("h", "v").orderBy("vec_id")
    small = rows.withColumn("_n", F.row_number().over(same)).filter(F.col("_n") <= k + 1)
    queries = rows.filter(F.col("vec_id") % every == 0).select("vec_id", "h", "v")
    if setting is None:
        setting = chosen_for(rows, queries, k)
    hashing = (setting.tables, setting.hashes, setting.width)
    index = stored(small.select("vec_id", "h", "v").mapInArrow(_hasher(1, *hashing), shape),
                   "ann-index")
    asked = stored(queries.mapInArrow(_hasher(setting.probes, *hashing), shape), "ann-probes")
    key, query = ["tab", "bucket"], ["query_id", "query_hash"]
    order = Window.partitionBy(*query).orderBy(F.col("score").desc(), "vec_id", "h")

    def compared(index: DataFrame, asked: DataFrame) -> DataFrame:
        held = index.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int")
                                       .alias("parts"))
        wanted = asked.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / block_probes).cast("int")
                                         .alias("askers"))
        grid = stored(held.join(wanted, key), "ann-buckets")      # buckets that some query visits

        def dealt(side: DataFrame, own: str, other: str, x: str, y: str) -> DataFrame:
            # its own block by hash, against every block of the other side
            return side.join(grid, key).select(
                *key, F.pmod(F.xxhash64("vec_id", "h"), F.col(own)).cast("int").alias(x),
                F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(y), "vec_id", "h", "v")

        left = dealt(index, "parts", "askers", "x", "y")
        right = dealt(asked, "askers", "parts", "y", "x").select(*key, "x", "y", "vec_id", "h", "v")
        group = [*key, "x", "y"]
        found = left.groupBy(*group).cogroup(right.groupBy(*group)).applyInPandas(
            _best_in_block(k),
            "query_id bigint, query_hash bigint, vec_id bigint, h bigint, score double")
        merged = found.groupBy(*query, "vec_id", "h").agg(F.max("score").alias("score"))
        return (merged.withColumn("rank", F.row_number().over(order))
                .filter(F.col("rank") <= k)
                .select("query_id", "rank", "vec_id", "score", "query_hash"))

    near = stored(compared(index, asked), "ann-found")
    counts = near.groupBy(*query).agg(F.count(F.lit(1)).alias("n"))
    named = queries.withColumnsRenamed({"vec_id": "query_id", "h": "query_hash"})
    short = stored(named.join(counts, query, "left").filter(F.coalesce("n", F.lit(0)) < k)
                   .select("query_id", "query_hash", "v"), "ann-short")

    def of_length(side: DataFrame) -> DataFrame:
        return side.select("vec_id", "h", F.lit(-1).alias("tab"),
                           F.size("v").cast("string").alias("bucket"), "v")

    # its rows replace those found by probing
    whole = compared(of_length(index.filter(F.col("tab") == 0)),
                     of_length(short.withColumnsRenamed({"query_id": "vec_id", "query_hash": "h"})))
    return near.join(short.select(*query), query, "left_anti").select(near.columns).unionByName(whole)


def chosen_for(rows: DataFrame, queries: DataFrame, k: int) -> Setting:
    """The setting for (vec_id, h, v) rows and queries."""
    n, near, any_two = profile(rows, k)
    return chosen(n, queries.count(), near, any_two)
