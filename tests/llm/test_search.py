"""SimHash, nearest vectors and decontamination against brute force."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from scenecast.llm import ann, decontamination, simhash
from scenecast.llm.components import components
from scenecast.llm.queries import op4_decontamination, op5_nearest, op9_simhash, table
from tests.conftest import SF_SMALL


# --- SimHash ---------------------------------------------------------------

def plain_fingerprint(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", lowered) if w]
    if not words:
        return 0
    n = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + n]).encode(), 42)
              for i in range(len(words) - n + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    """Smallest doc_id reachable per row by comparing all pairs."""
    fps = [plain_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        key = (d is None, d or 0)
        least[find(i)] = min(least.get(find(i), key), key)
    return [(d, f"{f:016x}", None if least[find(i)][0] else least[find(i)][1])
            for i, ((d, _), f) in enumerate(zip(rows, fps))]


def near_copies(n, seed):
    """Texts in groups of copies, some with a few words changed."""
    rng, out = random.Random(seed), []
    base = [[f"w{rng.randrange(5_000)}" for _ in range(300)] for _ in range(12)]
    for i in range(n):
        words = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            words[rng.randrange(len(words))] = f"x{rng.randrange(100)}"
        out.append((i * 7 % (3 * n), " ".join(words)))
    return out


def as_set(df):
    return sorted((str(r["doc_id"]), r["fingerprint"], str(r["component_id"])) for r in df.collect())


@pytest.mark.parametrize("trees,leaf,shard,sample",
                         [(4, 8, 10_000, 8_192), (2, 8, 10_000, 8_192), (1, 8, 10_000, 8_192),
                          (2, 1_000, 10, 8_192), (2, 8, 12, 16), (1, 8, 12, 16)])
def test_components_equal_all_pairs(make_docs, trees, leaf, shard, sample):
    rows = near_copies(160, 3)
    want = sorted((str(a), b, str(c)) for a, b, c in plain_components(rows))
    got = simhash.simhash_components(make_docs(rows), trees=trees, leaf_rows=leaf,
                                     shard_rows=shard, sample=sample)
    assert as_set(got) == want
    assert len({c for _, _, c in want}) < len(rows) / 4


def test_simhash_odd_rows(odd_docs, odd_texts, empty_docs):
    want = sorted((str(a), b, str(c)) for a, b, c in plain_components(odd_texts))
    extra = odd_docs.withColumn("fp", F.lit("x")).withColumn("component_id", F.lit(1))
    assert as_set(simhash.simhash_components(extra)) == want
    kept = simhash.keep_one(odd_docs).collect()
    assert len(kept) == len({c for _, _, c in want})
    assert simhash.simhash_components(empty_docs).count() == 0
    assert simhash.keep_one(empty_docs).count() == 0


def test_simhash_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, SF_SMALL, "documents").collect()]
    want = sorted((str(a), b, str(c)) for a, b, c in plain_components(rows))
    assert as_set(op9_simhash(spark, SF_SMALL)) == want


def test_spanning_links_join_what_all_pairs_join():
    rng = np.random.default_rng(1)
    centre = rng.integers(0, 1 << 63, 6, dtype=np.uint64)
    points = [int(c) for c in centre]
    for _ in range(400):
        p = points[int(rng.integers(len(points)))]
        for _ in range(int(rng.integers(1, 6))):
            p ^= 1 << int(rng.integers(64))
        points.append(p)
    points = np.unique(np.array(points, dtype=np.uint64))
    links = simhash.spanning_links(points, 3)
    assert all((a ^ b).bit_count() <= 3 for a, b in links)
    group = {int(p): int(p) for p in points}

    def find(x):
        while group[x] != x:
            x = group[x]
        return x
    for a, b in links:
        assert find(a) != find(b)               # a spanning forest, no link too many
        group[find(a)] = find(b)
    for i, a in enumerate(points):
        for b in points[:i]:
            if (int(a) ^ int(b)).bit_count() <= 3:
                assert find(int(a)) == find(int(b))


def test_registered_trees_visit_shards_across_the_boundary():
    rng = np.random.default_rng(6)
    points = np.unique(rng.integers(0, 1 << 64, 4_000, dtype=np.uint64))
    near = points[::4] ^ (np.uint64(1) << rng.integers(0, 32, len(points[::4]), dtype=np.uint64))
    near ^= np.uint64(1) << rng.integers(32, 64, len(near), dtype=np.uint64)
    radius = simhash.MAX_BITS // simhash.TREES
    assert radius > 0
    met, parted = np.zeros(len(near), bool), 0
    for mask in simhash.bands(simhash.TREES):
        tree = simhash.grow(points, mask, radius, 50)
        homes, of_near = {}, {}
        for got, fps in ((homes, points[::4]), (of_near, near)):
            for rows, name in simhash.route(fps, tree, mask, radius):
                for r in rows:
                    got.setdefault(int(r), set()).add(name)
        assert len(set().union(*homes.values())) > 40
        # a point's own shard is the one it enters with no radius
        own = {int(r): name for rows, name in simhash.route(points[::4], tree, mask, 0) for r in rows}
        far = {int(r): name for rows, name in simhash.route(near, tree, mask, 0) for r in rows}
        parted += sum(own[r] != far[r] for r in own)
        met |= np.array([bool(homes[r] & of_near[r]) for r in range(len(near))])
        assert sum(map(len, homes.values())) < 3 * len(homes)     # few visits, no copy everywhere
    assert met.all() and parted > 100


def test_large_shards_get_trees_of_their_own(spark):
    rng = np.random.default_rng(8)
    fps = np.unique(rng.integers(-1 << 62, 1 << 62, 3_000))
    points = spark.createDataFrame([(int(x),) for x in fps], "fp long").repartition(3)
    placed = simhash.shards(points, leaf_rows=60, shard_rows=150, sample=32).collect()
    sizes = {}
    for r in placed:
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + 1
    assert any("/" in s for s in sizes) and max(sizes.values()) <= 150
    for t in range(simhash.TREES):
        assert {r["fp"] for r in placed if r["shard"].startswith(f"{t}:")} == set(map(int, fps))


def test_component_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 60)]
    links += [(7, 7), (200, 199), (199, 200), (-5, 200)]
    random.Random(4).shuffle(links)
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    want = {i: 0 for i in range(1, 41)} | {100 + i: 100 for i in range(1, 60)}
    assert got == want | {200: -5, 199: -5}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- nearest vectors ---------------------------------------------------------

def brute_nearest(rows, every, k):
    """Exact neighbours of (vec_id, vector) rows, smaller ids first among ties."""
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], dtype=np.float64)
    out = {}
    for r in np.flatnonzero(ids % every == 0):
        a = np.repeat(x[r][None], len(x), axis=0)
        score = ann.exact_cosine(a, x)
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != ids[r]][:k]
        out[int(ids[r])] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def answers(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


def test_recall_of_the_query(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in table(spark, SF_SMALL, "embeddings").collect()]
    want, got = brute_nearest(rows, 50, 5), answers(op5_nearest(spark, SF_SMALL))
    hits = sum(len({i for i, _ in want[q]} & {i for i, _ in got.get(q, [])}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    scores = {(q, i): s for q, found in brute_nearest(rows, 50, len(rows)).items() for i, s in found}
    for q, found in got.items():
        assert all(scores[q, i] == s for i, s in found)
        assert found == sorted(found, key=lambda p: (-p[1], p[0]))


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    base = [float(i + 1) for i in range(8)]
    rows = [(0, base), (1, base), (2, base), (3, [2 * x for x in base]), (4, base), (5, base),
            (6, base), (7, base), (50, None), (100, [0.0] * 8), (150, [None] + base[1:]),
            (200, [nan] + base[1:]), (250, [inf] + base[1:]), (None, base), (300, []),
            (350, [1.0, 2.0]), (0, base), (400, [1e300] * 8), (8, [-x for x in base])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn(
        "score", F.lit("x"))
    got = answers(ann.nearest(df, every=50, k=5))
    assert sorted(got) == [0, 400]              # 350 has nobody of its length
    assert [i for i, _ in got[0]][-1] == 6 or 3 in [i for i, _ in got[0]]
    assert [i for i, _ in got[0] if i != 3] == [1, 2, 4, 5, 6][:len([i for i, _ in got[0] if i != 3])]
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert ann.nearest(empty).count() == 0


def test_queries_with_few_candidates_return_them_all(spark):
    rng = np.random.default_rng(4)
    rare = {100 + i: v for i, v in enumerate(rng.normal(size=(6, 8)))}       # a rare length
    rare[105] = -rare[100]
    far = rng.normal(size=16)
    many = {1_000 + i: far + rng.normal(size=16) / 20 for i in range(60)}
    many[2_000] = -far                                                       # an outlier
    rows = [(i, [float(x) for x in v]) for i, v in {**rare, **many}.items()]
    got = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"),
                      every=1).collect()
    found = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    for group in (rare, many):
        for q in [100, 105] if group is rare else [2_000]:
            cos = {i: float(v @ group[q]) / np.linalg.norm(v) for i, v in group.items() if i != q}
            want = sorted(cos, key=lambda i: -cos[i])[:5]
            assert found[q] == list(enumerate(want, 1))
    assert all(len(f) == 5 for f in found.values()) and len(found) == len(rows)


def test_hot_vector_in_blocks(spark):
    rng = np.random.default_rng(3)
    hot = rng.normal(size=16)
    rows = [(i, hot.tolist() if i % 3 == 0 else (hot + rng.normal(0, 0.02, 16)).tolist())
            for i in range(600)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = answers(ann.nearest(df, every=50, k=5, block_rows=32, block_probes=16))
    want = brute_nearest(rows, 50, 5)
    hits = sum(len({i for i, _ in want[q]} & {i for i, _ in got[q]}) for q in want)
    assert hits >= 0.9 * 5 * len(want)
    assert got[0] == want[0]                     # ties to the smaller id


def test_rows_that_share_an_id_all_count(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(40, 8))
    x[9] = x[0] + 0.01
    ids = [i % 35 for i in range(40)]                  # ids 0 to 4 stand twice
    rows = [(i, [float(c) for c in v]) for i, v in zip(ids, x)] * 2       # each row repeated
    got = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"),
                      every=50, k=39).collect()
    assert len({r["query_hash"] for r in got}) == 2 and {r["query_id"] for r in got} == {0}
    assert len(got) == 2 * 39                          # every row but the query's own
    for q in {r["query_hash"] for r in got}:
        found = [(r["vec_id"], r["score"]) for r in sorted(got, key=lambda r: r["rank"])
                 if r["query_hash"] == q]
        at = 0 if found[0][0] == 9 else 35
        cos = ann.exact_cosine(np.repeat(x[at][None], 40, axis=0), x)
        assert found == sorted([(ids[j], cos[j]) for j in range(40) if j != at],
                               key=lambda p: (-p[1], p[0]))


def test_settings_follow_the_data():
    rng = np.random.default_rng(12)
    any_two = rng.normal(1.41, 0.12, 1_000)
    loose, tight = rng.normal(1.1, 0.08, 240), rng.uniform(0.0, 0.4, 240)
    shares = {}
    for name, near in (("loose", loose), ("tight", tight)):
        picked = [ann.chosen(n, n / 50, near, any_two) for n in (500, 100_000, 10 ** 9)]
        assert all(p.recall >= ann.RECALL for p in picked)
        shares[name] = [p.share for p in picked]
        assert shares[name][0] > shares[name][1] > shares[name][2]       # falls as rows grow
    assert shares["tight"][2] < 0.01 < 0.9 > shares["loose"][2]


def test_profile_finds_the_nearest(spark):
    rng = np.random.default_rng(13)
    x = rng.normal(size=(300, 16))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)],
                               "vec_id long, embedding array<double>").repartition(5)
    n, near, any_two = ann.profile(ann.usable(df, "vec_id", "embedding"), 3, sample=300)
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    gap = np.sqrt(np.maximum(2 - 2 * unit @ unit.T, 0))
    np.fill_diagonal(gap, np.inf)
    assert n == 300 and np.allclose(np.sort(near), np.sort(np.sort(gap, axis=1)[:, :3].ravel()))
    assert len(any_two) == 300 * 299 // 2


def test_probe_order():
    sets = list(ann.probe_sets(np.array([0.1, 0.6, 0.5]), 12))
    inside = [0.1, 0.6, 0.5]
    cost = [sum(inside[i] ** 2 if s < 0 else (1 - inside[i]) ** 2 for i, s in p) for p in sets]
    assert sets[0] == () and cost == sorted(cost) and len(set(sets)) == 12


# --- decontamination ----------------------------------------------------------

def overlap(text, item):
    a = decontamination.shingles(decontamination.words_of(item))
    n = min(5, len(decontamination.words_of(item)))
    words = decontamination.words_of(text)
    b = {b" ".join(words[i:i + n]) for i in range(len(words) - n + 1)}
    return len(a & b) / len(a) if a else 0.0


def test_every_planted_passage_is_found(spark):
    docs = table(spark, SF_SMALL, "documents").collect()
    items = table(spark, SF_SMALL, "benchmark").collect()
    got = {(r["doc_id"], r["item_id"]) for r in op4_decontamination(spark, SF_SMALL).collect()}
    whole = {(d["doc_id"], str(i["item_id"])) for d in docs for i in items
             if overlap(d["text"], i["text"]) == 1.0}
    some = {(d["doc_id"], str(i["item_id"])) for d in docs for i in items
            if overlap(d["text"], i["text"]) >= 0.8}
    assert whole and whole <= got <= some


def test_wand_retrieves_all_above_the_threshold():
    rng = random.Random(6)
    words = [f"t{i}" for i in range(120)]
    items = [(str(k), " ".join(rng.choice(words) for _ in range(rng.randrange(17, 33))))
             for k in range(150)]
    index, = decontamination.build(items)
    for _ in range(150):
        terms = sorted(rng.sample(sorted(index.postings), rng.randrange(3, 90)))
        least = rng.uniform(0.05, 0.9)
        score = {}
        for t in terms:
            for item, v in zip(index.postings[t].items, index.postings[t].impacts):
                score[item] = score.get(item, 0) + v
        got = dict(index.search(terms, least))
        assert set(got) == {i for i, s in score.items() if s >= least}
        assert all(abs(score[i] - s) < 1e-9 for i, s in got.items())


def test_decontamination_edges(spark, make_docs, odd_docs, empty_docs, monkeypatch):
    question = "What is the colour of the seventh moon of the planet that nobody named?"
    answer = "It is a pale green that turns to grey every second spring."
    bench = spark.createDataFrame(
        [(1, question + " " + answer), (2, None), (3, ""), (4, "one two"), (5, question + " " + answer),
         (6, "alpha beta gamma delta epsilon zeta eta theta iota kappa")],
        "item_id int, text string")
    filler = " ".join(f"filler{i}" for i in range(200))
    docs = make_docs([(1, f"{filler} {question} {answer} {filler}"), (2, f"{filler} {question}"),
                      (3, f"{filler}%%{question.upper()}&& {answer}&&&{filler}"), (4, None), (5, ""),
                      (6, "x one two y"), (7, "alpha beta gamma delta epsilon zeta eta"),
                      (1, f"{filler} {question} {answer} {filler}")])
    pairs = sorted((r["doc_id"], r["item_id"]) for r in decontamination.contaminated(
        docs.withColumn("matches", F.lit(0)), bench).collect())
    assert pairs == [(1, "1"), (1, "1"), (1, "5"), (1, "5"), (3, "1"), (3, "5"), (6, "4")]
    clean = decontamination.decontaminate(docs.withColumn("matches", F.lit(7)), bench)
    assert sorted(r["doc_id"] for r in clean.collect()) == [2, 4, 5, 7]
    assert clean.columns == [*docs.columns, "matches"]
    assert {r["matches"] for r in clean.collect()} == {7}
    monkeypatch.setattr(decontamination, "INDEX_BYTES", 20)     # one pass per item
    assert sorted((r["doc_id"], r["item_id"]) for r in decontamination.contaminated(
        docs, bench).collect()) == pairs
    assert sorted(r["doc_id"] for r in decontamination.decontaminate(docs, bench).collect()
                  ) == [2, 4, 5, 7]
    monkeypatch.undo()
    assert decontamination.contaminated(docs, bench.limit(0)).count() == 0
    assert decontamination.decontaminate(docs, bench.limit(0)).count() == 8
    assert decontamination.contaminated(empty_docs, bench).count() == 0
    assert decontamination.decontaminate(odd_docs, bench).count() == 15


def plain_scores(text, items):
    """BM25 of the item for a text that holds all its window, as a share of the item's own score."""
    words = {k: decontamination.words_of(t) for k, t in items}
    group = {k: decontamination.length_group(len(w)) for k, w in words.items()}
    have, out = set(decontamination.words_of(text)), {}
    for k, w in words.items():
        peers = [words[j] for j in words if group[j] == group[k]]
        mean = sum(map(len, peers)) / len(peers)
        weight = {}
        for t in set(w):
            held = sum(t in p for p in peers)
            idf = np.log(1 + (len(peers) - held + 0.5) / (held + 0.5))
            weight[t] = idf * w.count(t) * 2.2 / (w.count(t) + 1.2 * (0.25 + 0.75 * len(w) / mean))
        out[k] = sum(v for t, v in weight.items() if t in have) / sum(weight.values())
    return out


def test_scores_do_not_depend_on_the_shards(spark, make_docs, monkeypatch):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(60)]
    items = [(k, " ".join(rng.choice(words) for _ in range(rng.randrange(8, 16)))) for k in range(40)]
    bench = spark.createDataFrame(items, "item_id int, text string")
    # a tenth of the words at the end is lost; no item has a question mark
    docs = make_docs([(k, " ".join(t.split()[:-1])) for k, t in items])
    seen = []
    for size in (20, 1_000, 1 << 20):
        monkeypatch.setattr(decontamination, "INDEX_BYTES", size)
        got = decontamination.contaminated(docs, bench, overlap=0.75).collect()
        seen.append(sorted((r["doc_id"], r["item_id"], round(r["score"], 9), r["question_overlap"])
                           for r in got))
    assert seen[0] == seen[1] == seen[2]
    assert len({d for d, *_ in seen[0]}) > 20
    texts = dict(items)
    for d, i, score, asked in seen[0]:
        want = plain_scores(" ".join(texts[d].split()[:-1]), [(str(k), t) for k, t in items])
        assert score == pytest.approx(want[i]) and asked is None


def test_cosine_of_extreme_vectors():
    a = np.array([[1e300] * 8, [1e-300] * 8, [3.0, 4.0] + [0.0] * 6])
    b = np.array([np.arange(1.0, 9.0)] * 2 + [[4.0, 3.0] + [0.0] * 6])
    want = np.arange(1.0, 9.0).sum() / np.sqrt(8) / np.sqrt((np.arange(1.0, 9.0) ** 2).sum())
    assert ann.exact_cosine(a, b) == pytest.approx([want, want, 24 / 25], rel=1e-15)
