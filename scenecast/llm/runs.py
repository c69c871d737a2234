"""Periodic run detection over the words of whole texts.

A run is a longest stretch of words in which every word equals the one ``q`` words before
it, ``q`` being its smallest period, with a length of at least ``MIN_LENGTH`` words and
``MIN_POWER`` periods.

Method: an online sparse diagonal DP.  The words are read once, in order.  A word and an
earlier occurrence of it lie on a diagonal, named by their lag; a word that
follows one on the same diagonal makes that lag's match length grow, and a
diagonal that is not continued ends there and then: if it is long enough, its run is
emitted at once.

Which earlier occurrences count is bounded without losing a run.  For every scale
``g`` = 1, 2, 4, ... a word looks at the latest earlier place where it stands with
the same ``g - 1`` words in front, and only if that lag lies in ``(g / 2, g]``.  Inside a run of
smallest period ``q`` in that range, no shorter lag can match ``g >= q`` words
(two periods that overlap by so much have their greatest common divisor as a
period), so the latest place is exactly ``q`` words back; and a lag that lasts three
periods is the smallest period.  Each word therefore has at most one earlier
occurrence a scale: ``n log n`` steps for ``n`` words, also where one word
fills the whole text.  A run has at least ``SEED`` words in a row that match, so a text without
a repeated sequence of ``SEED`` words is done after one pass.

Nothing is shuffled; a lost task is run again from its input split.

Edge cases: null and empty texts have no words, no runs and an empty collapsed text; very
long texts cost ``n log n``; repeated rows are searched each; an empty table gives an empty
result; other columns pass through, but those named as the output columns are replaced.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scenecast.llm.common import CRC32_SQL, require

MIN_LENGTH = 24
MIN_POWER = 3

_MIX = np.uint64(0x9E3779B97F4A7C15)


def seed_words(min_length: int = MIN_LENGTH, min_power: int = MIN_POWER) -> int:
    """Words in a row that match on the diagonal of any run: the least ``length - q``."""
    return min(max(min_length, min_power * q) - q for q in range(1, min_length + 1))


def word_ids(words: list[bytes]) -> np.ndarray:
    """Equal words have equal numbers."""
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))


def may_have_runs(ids: np.ndarray, seed: int) -> bool:
    """False only if no sequence of ``seed`` words stands twice (by a hash: true may be wrong)."""
    if len(ids) <= seed:
        return False
    h, width = (ids.astype(np.uint64) + np.uint64(1)) * _MIX, 1
    while width < seed:
        step = min(width, seed - width)         # the last step overlaps what it adds
        h = (h[step:] ^ (h[:-step] >> np.uint64(29))) * _MIX + h[:-step]
        width += step
    h.sort()
    return bool((h[1:] == h[:-1]).any())


def earlier_occurrences(ids: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, lag, scale) of the matches the DP reads, by place; lags up to ``longest``.

    A place is the last word of a sequence of ``scale`` words.
    """
    found, g = [], 1
    at, gram = np.arange(len(ids)), ids
    while len(at) and g // 2 < longest:
        order = np.argsort(gram, kind="stable")
        twin = gram[order[1:]] == gram[order[:-1]]
        later, before = order[1:][twin], order[:-1][twin]
        lag = at[later] - at[before]
        near = (lag > g // 2) & (lag <= min(g, longest))
        found.append((at[later][near], lag[near], np.full(near.sum(), g)))
        # sequences of twice the length, of those that do not stand alone
        shared = np.zeros(len(at), dtype=bool)
        shared[later] = shared[before] = True
        whole = np.full(len(ids), -1)
        whole[at[shared]] = gram[shared]
        at = at[shared & (at >= g)]
        at = at[whole[at - g] >= 0]
        gram = np.unique(whole[at] * (len(ids) + 1) + whole[at - g], return_inverse=True)[1]
        g *= 2
    place, lag, scale = (np.concatenate(c) for c in zip(*found))
    order = np.argsort(place, kind="stable")
    return place[order], lag[order], scale[order]


def find_runs(words: list[bytes], min_length: int = MIN_LENGTH, min_power: int = MIN_POWER
              ) -> list[tuple[int, int, int]]:
    """Runs as (start, length, period), by start and period."""
    if min_power < 3:
        raise ValueError("the lags that are read find runs of three periods or more")
    ids = word_ids(words)
    if len(ids) < min_length or not may_have_runs(ids, seed_words(min_length, min_power)):
        return []
    runs: list[tuple[int, int, int]] = []
    active: dict[int, list[int]] = {}         # lag -> [last place, match length]

    def end(lag: int) -> None:
        last, matched = active.pop(lag)
        if matched + lag >= max(min_length, min_power * lag):
            runs.append((last + 1 - matched - lag, matched + lag, lag))

    matches = earlier_occurrences(ids, len(ids) // min_power)
    for i, lag, g in zip(*(m.tolist() for m in matches)):
        for ended in [d for d, (last, _) in active.items() if last < i - 1]:
            end(ended)
        if lag in active:
            active[lag][0] = i
            active[lag][1] += 1
        else:
            active[lag] = [i, g]
    for lag in list(active):
        end(lag)
    return sorted((s, n, q) for s, n, q in runs)


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    if not runs:
        return words
    gone = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    return [w for w, k in zip(words, np.cumsum(gone).tolist()) if not k]


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()),
                            ("period", pa.int64())]))
_FOUND = pa.struct([("runs", _RUNS), ("collapsed", pa.string())])


def runs_column(text: Column, min_length: int = MIN_LENGTH, min_power: int = MIN_POWER) -> Column:
    """Column expression: ``runs`` and ``collapsed`` text of a text column."""
    @F.arrow_udf("runs array<struct<start:long,length:long,period:long>>, collapsed string")
    def run(texts: pa.Array) -> pa.Array:
        spans, kept = [], []
        for t in texts:
            words = (t.as_py() or "").encode().split()
            runs = find_runs(words, min_length, min_power)
            spans.append([{"start": s, "length": n, "period": q} for s, n, q in runs])
            kept.append(b" ".join(collapse(words, runs)).decode())
        return pa.StructArray.from_arrays(
            [pa.array(spans, _RUNS), pa.array(kept, pa.string())], fields=list(_FOUND))
    # marked so that expressions over the result never repeat the search
    return run.asNondeterministic()(text)


def periodic_runs(docs: DataFrame, text_col: str = "text", min_length: int = MIN_LENGTH,
                  min_power: int = MIN_POWER) -> DataFrame:
    """Add ``runs`` (by start and period) and ``collapsed`` to every row."""
    require(docs, text_col)
    others = [f"`{c}`" for c in docs.columns if c not in ("runs", "collapsed")]
    found = runs_column(F.col(text_col), min_length, min_power)
    return (docs.withColumn("__found", found)
            .select(*others, F.col("__found.runs").alias("runs"),
                    F.col("__found.collapsed").alias("collapsed")))


def strongest(runs: Column) -> Column:
    """The run of greatest length / period (exactly), then smallest start and period.

    Null without runs.  ``runs`` are in the order of start and period.
    """
    def better(best: Column, run: Column) -> Column:
        more = run["length"] * best["period"] > best["length"] * run["period"]
        return F.when(best.isNull() | more, run).otherwise(best)
    return F.aggregate(runs, F.get(runs, F.lit(0)), better)


def runs_text(runs: Column) -> Column:
    """Every run as ``start,length,period`` and a line feed."""
    return F.array_join(F.transform(runs, lambda r: F.concat(
        F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")


def with_loop(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of one document in ten with a loop at their end; the others as they are.

    With h the CRC-32 of the decimal id and g = floor(h / 10): where 10 divides h, word i >= a
    of n becomes word a + (i - a) % p, a = g % n and p = 1 + floor((n - a) / (3 + g % 8)).
    """
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def looped_text(doc_id: Column, text: Column) -> Column:
    """Column expression: :func:`with_loop` on a text column (null ids and texts stay)."""
    @F.arrow_udf("string")
    def run(ids: pa.Array, texts: pa.Array) -> pa.Array:
        out = []
        for i, t in zip(ids.to_pylist(), texts):
            text = t.as_py()
            words = (text or "").encode().split()
            looped = with_loop(i, words)
            out.append(text if looped is words else b" ".join(looped).decode())
        return pa.array(out, pa.string())
    return run(doc_id, text)


# --- SQL of the query --------------------------------------------------------

ORACLE = f"""
WITH d AS (
  SELECT doc_id, {CRC32_SQL.format('doc_id::VARCHAR')} AS h,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t-\\r]+'),
                     lambda w: w <> '') AS own
  FROM documents),
a AS (SELECT *, len(own) AS n, h // 10 AS g, CASE WHEN len(own) > 0 THEN h // 10 % len(own) END AS a
      FROM d),
p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM a),
t AS (
  SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i:
         own[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) ELSE own END AS words
  FROM p),
seeds AS (   -- sequences of 16 words: every run holds one of them twice, its period apart
  SELECT doc_id, n, i, array_to_string(words[i + 1:i + 16], ' ') AS seed
  FROM (SELECT *, unnest(range(n - 15)) AS i FROM t WHERE n >= {MIN_LENGTH})),
pairs AS (
  SELECT x.doc_id, x.i, y.i - x.i AS q
  FROM seeds x JOIN seeds y ON x.doc_id = y.doc_id AND x.seed = y.seed
    AND y.i > x.i AND y.i - x.i <= x.n // {MIN_POWER}),
stretches AS (
  SELECT doc_id, q, min(i) AS start, count(*) + 15 + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS part FROM pairs)
  GROUP BY doc_id, q, part),
runs AS (
  SELECT doc_id, start, length, min(q) AS period FROM stretches
  WHERE length >= greatest({MIN_LENGTH}, {MIN_POWER} * q) GROUP BY doc_id, start, length),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY
           length::HUGEINT * 1000000000000 // period DESC, start, period) AS rank
  FROM runs),
listed AS (
  SELECT doc_id, count(*) AS n_runs, sha256(string_agg(
           concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period)) AS digest
  FROM runs GROUP BY doc_id),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (
  SELECT u.doc_id, string_agg(w, ' ' ORDER BY u.i) AS text
  FROM (SELECT doc_id, unnest(words) AS w, unnest(range(n)) AS i FROM t) u
  LEFT JOIN gone USING (doc_id, i) WHERE gone.i IS NULL GROUP BY u.doc_id)
SELECT t.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start::BIGINT AS start,
       length::BIGINT AS length, period::BIGINT AS period,
       (1000 * length // period)::BIGINT AS exponent_milli,
       coalesce(digest, sha256('')) AS runs_sha256,
       sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM t LEFT JOIN ranked ON t.doc_id = ranked.doc_id AND rank = 1
LEFT JOIN listed ON t.doc_id = listed.doc_id LEFT JOIN kept ON t.doc_id = kept.doc_id
"""
