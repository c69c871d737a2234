"""Benchmark decontamination: BM25 index of the test items, searched with block-max WAND.

The test items are the indexed documents and every training passage is a query.

Index.  Items are grouped by length (factors of two), so that passages can be as long as
the items of their group ask for.  A posting's impact is the term's BM25 weight in
the item divided by the item's score for its own words, so a passage that holds all
words of an item scores 1 whatever the item.  Postings are sorted by item, in blocks of
``BLOCK`` that know their largest impact.

Search.  A text is cut into windows of two steps, a step being the longest item of the group:
each place where an item may stand lies whole in one window.  Items are also cut into
``RANGES`` ranges or fewer; a window whose words' largest impacts add up to ``threshold`` in no range
holds no pivot and is left at once (the WAND test on block maxima, done for all windows
of a text together); the others are walked term by term: the pivot by largest impacts, then by the blocks' largest impacts, with
jumps to the end of the shallowest block, and full scores only where both reach the
threshold.  All items above it are retrieved, not the best few.

Check.  The five-word shingles of the item (fewer words: the whole item) are looked up in
the document's own; ``overlap`` of them must be there, and at least ``part_overlap`` of the
question's and of the answer's (a part of fewer than five words is judged by its single
words in the window).  The question ends at an answer mark, else after the
last question mark; an item without either is judged as a whole (its part overlaps are null).

Statistics (items, mean length and document frequencies per length group) are Spark
aggregates over the whole benchmark, so scores do not depend on how it is cut.  The index is sent
to the tasks in shards of at most ``INDEX_BYTES`` bytes of item text; a larger benchmark takes
one stored pass per shard, so what is sent has a fixed bound.  Items are read from the
driver one shard at a time.  Documents are not shuffled.

Edge cases: null and empty texts and items match nothing; repeated items are searched once and
reported under every id; repeated documents are searched each; an empty benchmark finds
nothing; other columns pass through, whatever their names (``with_matches`` replaces a column
``matches``).
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scenecast.llm.common import require, stored

K1, B = 1.2, 0.75
BLOCK = 8
THRESHOLD = 0.65
OVERLAP, PART_OVERLAP = 0.8, 0.5
SHINGLE = 5
RANGES = 64
INDEX_BYTES = 1 << 20
GROUP = 100_000

FOUND = T.ArrayType(T.StructType([
    T.StructField("item_key", T.StringType()), T.StructField("item_id", T.StringType()), T.StructField("score", T.DoubleType()),
    T.StructField("overlap", T.DoubleType()), T.StructField("question_overlap", T.DoubleType()),
    T.StructField("answer_overlap", T.DoubleType())]))
_ARROW = pa.list_(pa.struct([("item_key", pa.string()), ("item_id", pa.string()), ("score", pa.float64()),
                             ("overlap", pa.float64()), ("question_overlap", pa.float64()),
                             ("answer_overlap", pa.float64())]))

_ANSWER_MARK = re.compile(r"\n\s*(?:answer|a)\s*:", re.IGNORECASE)


# Letters and digits make words; every other ASCII character parts them, so marks that
# stand around or behind a passage don't hide it.
_WORD_BYTES = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Words of a text: runs of letters and digits, A-Z lower-cased, as UTF-8."""
    return (text or "").encode().translate(_WORD_BYTES).lower().split()


def question_answer(text: str) -> tuple[list[bytes], ...]:
    """Words of the item's question and of its answer; nothing where it has no such parts."""
    mark = _ANSWER_MARK.search(text)
    cut = mark.start() if mark else text.rfind("?") + 1
    parts = words_of(text[:cut]), words_of(text[cut:])
    return parts if all(parts) else ()


def shingles(words: list[bytes], n: int = SHINGLE) -> set[bytes]:
    """Distinct ``n``-word shingles; fewer words give the whole sequence, none give none."""
    if not words:
        return set()
    n = min(n, len(words))
    return {b" ".join(words[i:i + n]) for i in range(len(words) - n + 1)}


@dataclass
class Statistics:
    """Of one length group over the whole benchmark; ``holders`` for the words of some items."""

    n: int
    mean: float
    holders: dict[bytes, int]


def length_group(n_words: int) -> int:
    """Number of an item's group: at most 16 words, 32, 64, ..."""
    return max(4, math.ceil(math.log2(n_words)))


@dataclass
class Postings:
    """One term's list: items ascending, impacts, and the largest impact per block."""

    items: list[int]
    impacts: list[float]
    tops: list[float] = field(default_factory=list)

    def seal(self) -> float:
        self.tops = [max(self.impacts[i:i + BLOCK]) for i in range(0, len(self.impacts), BLOCK)]
        return max(self.tops)


class Index:
    """Impact index of the items of one length group; ``terms`` numbers all groups' words."""

    def __init__(self, items: list[tuple[str, str]], terms: dict[bytes, int], stats: Statistics):
        self.ids = [i for i, _ in items]
        self.keys = [item_key(t) for _, t in items]
        self.whole = [shingles(words_of(t)) for _, t in items]
        # a part's five-word shingles, or its single words if it has fewer than five
        self.parts = [tuple((len(p) >= SHINGLE, shingles(p, SHINGLE if len(p) >= SHINGLE else 1))
                            for p in question_answer(t)) for _, t in items]
        counts = [Counter(words_of(t)) for _, t in items]
        lengths = [sum(c.values()) for c in counts]
        self.step = max(lengths)
        mean, n = stats.mean, len(items)
        idf = {w: math.log(1 + (stats.n - k + 0.5) / (k + 0.5)) for w, k in stats.holders.items()}
        self.terms = terms
        self.postings = {terms[w]: Postings([], []) for w in sorted({w for c in counts for w in c})}
        for item, (c, length) in enumerate(zip(counts, lengths)):
            scale = K1 * (1 - B + B * length / mean)
            weight = {w: idf[w] * tf * (K1 + 1) / (tf + scale) for w, tf in c.items()}
            own = sum(weight.values())
            for w, v in weight.items():
                p = self.postings[self.terms[w]]
                p.items.append(item)
                p.impacts.append(v / own)
        self.most = np.zeros(len(terms) + 1)      # the last one is for -1
        for t, p in self.postings.items():
            self.most[t] = p.seal()
        # largest impact of every term per range of items, for the test of whole windows
        size = max(BLOCK, -(-n // RANGES))
        self.tops = np.zeros((len(terms), -(-n // size)), dtype=np.float32)
        for t, p in self.postings.items():
            np.maximum.at(self.tops[t], np.array(p.items) // size, p.impacts)

    def windows(self, ids: np.ndarray, doc: np.ndarray, place: np.ndarray, threshold: float
                ) -> list[tuple[int, list[int]]]:
        """(text, distinct terms) of every window that could reach the threshold.

        ``ids`` are the words of many texts as term numbers, -1 for words of no item;
        ``doc`` and ``place`` say of which text and where.  Texts are kept a step apart.
        """
        at = np.flatnonzero(self.most[ids])
        if not len(at):
            return []
        steps = np.bincount(doc, minlength=int(doc[-1]) + 1) // self.step + 2
        base = np.cumsum(steps) - steps
        width = len(self.most)
        # distinct (step, term) pairs; a window is two neighbouring steps
        pairs = np.unique((base[doc[at]] + place[at] // self.step) * width + ids[at])
        step, term = pairs // width, pairs % width
        starts = np.flatnonzero(np.diff(step, prepend=-1))
        tops = self.tops[term]
        sums, steps_at = np.add.reduceat(tops, starts, axis=0), step[starts]
        # a term of both steps counts once
        again = np.searchsorted(pairs, pairs + width)
        again[again == len(pairs)] = 0
        twice = np.add.reduceat(tops * (pairs[again] == pairs + width)[:, None], starts, axis=0)
        after = np.append(steps_at[1:] == steps_at[:-1] + 1, False)
        both = sums - twice + np.where(after[:, None], np.roll(sums, -1, axis=0), 0)
        found = []
        ends = np.append(starts, len(term))
        for i in np.flatnonzero(both.max(axis=1) >= threshold - 1e-4):
            terms = np.unique(term[starts[i]:ends[i + 1 + bool(after[i])]])
            text = int(np.searchsorted(base, steps_at[i], side="right")) - 1
            found.append((text, terms.tolist()))
        return found

    def search(self, terms: list[int], threshold: float) -> list[tuple[int, float]]:
        """All items whose impacts of the given terms add up to the threshold (WAND)."""
        lists = [self.postings[t] for t in terms]
        most = [float(self.most[t]) for t in terms]
        if sum(most) < threshold:
            return []
        at, end, found = [0] * len(lists), len(self.ids), []
        eps = 1e-9

        def here(k: int) -> int:
            return lists[k].items[at[k]] if at[k] < len(lists[k].items) else end

        def jump(k: int, item: int) -> None:
            # to the first posting at or after the item, by blocks and then one by one
            items, i = lists[k].items, at[k]
            while (i // BLOCK + 1) * BLOCK < len(items) and items[(i // BLOCK + 1) * BLOCK] <= item:
                i = (i // BLOCK + 1) * BLOCK
            while i < len(items) and items[i] < item:
                i += 1
            at[k] = i

        live = list(range(len(lists)))
        while True:
            live = sorted((k for k in live if here(k) < end), key=here)
            total, pivot = 0.0, None
            for n, k in enumerate(live):
                total += most[k]
                if total >= threshold - eps:
                    pivot = n
                    break
            if pivot is None:
                return found
            item = here(live[pivot])
            while pivot + 1 < len(live) and here(live[pivot + 1]) == item:
                pivot += 1
            upto = live[:pivot + 1]
            for k in upto:
                jump(k, item)
            upto = [k for k in upto if here(k) < end]
            bound = sum(lists[k].tops[at[k] // BLOCK] for k in upto)
            if bound >= threshold - eps:
                on = [k for k in upto if here(k) == item]
                score = sum(lists[k].impacts[at[k]] for k in on)
                if score >= threshold - eps:
                    found.append((item, score))
                for k in on:
                    at[k] += 1
            else:
                # no item up to the end of the shallowest block can reach the threshold
                ends = [lists[k].items[min(len(lists[k].items), (at[k] // BLOCK + 1) * BLOCK) - 1]
                        for k in upto]
                beyond = here(live[pivot + 1]) if pivot + 1 < len(live) else end
                target = min([*(e + 1 for e in ends), beyond])
                for k in upto:
                    jump(k, max(target, item + 1))

    def verified(self, words: list[bytes], best: dict[int, tuple[float, list[int]]],
                 overlap: float, part: float) -> list[dict]:
        """Those of the retrieved items whose question and answer stand in the text."""
        have = {n: shingles(words, n) for n in range(1, SHINGLE + 1) if n <= len(words)}
        out = []
        for item, (score, terms) in best.items():
            whole = self.whole[item]
            share = _share(whole, have.get(next(iter(whole)).count(b" ") + 1, set()))
            window = set(terms)
            near = {w for p in self.parts[item] if not p[0] for w in p[1]
                    if self.terms[w] in window}
            parts = [_share(p, have.get(SHINGLE, set()) if long else near)
                     for long, p in self.parts[item]]
            if share >= overlap and all(p >= part for p in parts):
                asked, told = parts or (None, None)
                out.append({"item_key": self.keys[item], "item_id": self.ids[item],
                            "score": float(score), "overlap": share,
                            "question_overlap": asked, "answer_overlap": told})
        return out


def _share(wanted: set[bytes], have: set[bytes]) -> float:
    return len(wanted & have) / len(wanted) if wanted else 1.0


def item_key(text: str) -> str:
    """Names an item's text."""
    return hashlib.sha256(text.encode()).hexdigest()


def statistics(items: list[tuple[str, str]]) -> dict[int, Statistics]:
    """Statistics of a benchmark that is at hand as a list."""
    groups: dict[int, list[list[bytes]]] = {}
    for _, text in items:
        if found := words_of(text):
            groups.setdefault(length_group(len(found)), []).append(found)
    return {g: Statistics(len(ws), sum(map(len, ws)) / len(ws), Counter(w for x in ws for w in set(x)))
            for g, ws in groups.items()}


def build(items: list[tuple[str, str]], stats: dict[int, Statistics] | None = None) -> list[Index]:
    """One index per length group; ``stats`` are the whole benchmark's (default: of the items)."""
    stats = statistics(items) if stats is None else stats
    groups: dict[int, list[tuple[str, str]]] = {}
    words: set[bytes] = set()
    for i, text in items:
        if found := words_of(text):
            words.update(found)
            groups.setdefault(length_group(len(found)), []).append((i, text))
    terms = {w: k for k, w in enumerate(sorted(words))}
    return [Index(groups[g], terms, stats[g]) for g in sorted(groups)]


def match_texts(texts: list[str | None], indexes: list[Index], threshold: float = THRESHOLD,
                overlap: float = OVERLAP, part: float = PART_OVERLAP) -> list[list[dict]]:
    """Verified items of each text; ``GROUP`` words or one text are searched at a time."""
    out: list[list[dict]] = [[] for _ in texts]
    if not indexes:
        return out
    get, group, parts, size = indexes[0].terms.get, [], [], 0

    def search() -> None:
        sizes = np.array([len(p) for p in parts])
        doc = np.repeat(np.arange(len(parts)), sizes)
        ids = np.concatenate(parts)
        place = np.arange(len(ids)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        for ix in indexes:
            best: dict[int, dict[int, tuple[float, list[int]]]] = {}
            for d, terms in ix.windows(ids, doc, place, threshold):
                for item, score in ix.search(terms, threshold):
                    own = best.setdefault(d, {})
                    own[item] = max((score, terms), own.get(item, (0.0, [])))
            for d, own in best.items():
                out[group[d]] += ix.verified(words_of(texts[group[d]]), own, overlap, part)

    for i, text in enumerate(texts):
        words = words_of(text)
        if not words:
            continue
        group.append(i)
        parts.append(np.fromiter(map(get, words, repeat(-1)), dtype=np.int64, count=len(words)))
        size += len(words)
        if size >= GROUP:
            search()
            group, parts, size = [], [], 0
    if group:
        search()
    return out


def match_text(text: str | None, indexes: list[Index], **options) -> list[dict]:
    """Verified items of one text."""
    return match_texts([text], indexes, **options)[0]


class Benchmark:
    """The distinct items of a benchmark, its statistics, and its shards of bounded size."""

    def __init__(self, benchmark: DataFrame, item_col: str, text_col: str):
        require(benchmark, item_col, text_col)
        items = (benchmark.select(F.col(item_col).cast("string").alias("i"),
                                  F.col(text_col).alias("t"))
                 .filter(F.col("t").isNotNull() & (F.length(F.trim("t")) > 0)))
        self.items = stored(items, "benchmark-items")

        @F.arrow_udf("array<binary>")
        def listed(texts: pa.Array) -> pa.Array:
            return pa.array([words_of(t.as_py()) for t in texts], pa.list_(pa.binary()))

        @F.arrow_udf("int")
        def group(sizes: pa.Array) -> pa.Array:
            return pa.array([length_group(n) for n in sizes.to_pylist()], pa.int32())

        self.distinct = self.items.groupBy("t").agg(F.min("i").alias("i"))
        words = (self.distinct.select(listed("t").alias("ws")).filter(F.size("ws") > 0)
                 .withColumn("n", F.size("ws")).withColumn("g", group("n")))
        self.groups = {r["g"]: (r["items"], r["mean"]) for r in words.groupBy("g").agg(
            F.count(F.lit(1)).alias("items"), F.avg("n").alias("mean")).collect()}
        self.holders = stored(words.select("g", F.explode(F.array_distinct("ws")).alias("w"))
                              .groupBy("g", "w").count(), "benchmark-words")

    def _statistics(self, shard: list[tuple[str, str]]) -> dict[int, Statistics]:
        """Whole-benchmark statistics for the words of one shard."""
        spark = self.items.sparkSession
        own = spark.createDataFrame([(w,) for w in sorted({w for _, t in shard for w in words_of(t)})],
                                    "w binary")
        out = {g: Statistics(n, mean, {}) for g, (n, mean) in self.groups.items()}
        for r in self.holders.join(own, "w").collect():        # bounded by the shard's words
            out[r["g"]].holders[bytes(r["w"])] = r["count"]
        return out

    def indexes(self):
        """Per shard its indexes, and whether it is the last one."""
        shard, size = [], 0
        for r in self.distinct.orderBy("i", "t").toLocalIterator():
            if shard and size + len(r["t"]) > INDEX_BYTES:
                yield build(shard, self._statistics(shard)), False
                shard, size = [], 0
            shard.append((r["i"], r["t"]))
            size += len(r["t"])
        if shard:
            yield build(shard, self._statistics(shard)), True

    def ids(self) -> DataFrame:
        """(item_key, item_id): every id of every text."""
        return self.items.select(F.sha2(F.col("t").cast("binary"), 256).alias("item_key"),
                                 F.col("i").alias("item_id")).distinct()


def _matches(text: Column, indexes: list[Index], threshold: float, overlap: float, part: float
             ) -> Column:
    @F.arrow_udf(FOUND)
    def run(texts: pa.Array) -> pa.Array:
        return pa.array(match_texts(texts.to_pylist(), indexes, threshold, overlap, part), _ARROW)
    return run(text)


def with_matches(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                 item_col: str = "item_id", item_text: str = "text",
                 threshold: float = THRESHOLD, overlap: float = OVERLAP,
                 part_overlap: float = PART_OVERLAP) -> DataFrame:
    """Add ``matches``: the verified items of every document (an array, maybe empty).

    A repeated item comes under its smallest id.
    """
    require(docs, text_col)
    found = F.array().cast(FOUND)
    for indexes, _ in Benchmark(benchmark, item_col, item_text).indexes():
        found = F.concat(found, _matches(F.col(text_col), indexes, threshold, overlap, part_overlap))
    return docs.withColumn("matches", found)


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                 text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
                 threshold: float = THRESHOLD, overlap: float = OVERLAP,
                 part_overlap: float = PART_OVERLAP) -> DataFrame:
    """One row per document and item id found in it, with score and overlaps."""
    require(docs, id_col, text_col)
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    bench = Benchmark(benchmark, item_col, item_text)
    out = None
    for indexes, last in bench.indexes():
        hits = texts.select("_id", F.explode(_matches(
            F.col("_text"), indexes, threshold, overlap, part_overlap)).alias("m"))
        hits = hits if last else stored(hits, "shard-matches")
        out = hits if out is None else out.unionByName(hits)
    if out is None:
        out = texts.limit(0).select("_id", F.explode(F.array().cast(FOUND)).alias("m"))
    return (out.select(F.col("_id").alias(id_col), "m.*").drop("item_id")
            .join(bench.ids(), "item_key")
            .select(id_col, "item_id", "score", "overlap", "question_overlap", "answer_overlap"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text",
                  threshold: float = THRESHOLD, overlap: float = OVERLAP,
                  part_overlap: float = PART_OVERLAP) -> DataFrame:
    """The documents in which no item was found."""
    require(docs, text_col)
    for indexes, last in Benchmark(benchmark, item_col, item_text).indexes():
        docs = docs.filter(F.size(_matches(F.col(text_col), indexes, threshold, overlap,
                                           part_overlap)) == 0)
        if not last:
            docs = stored(docs, "shard-clean")
    return docs
