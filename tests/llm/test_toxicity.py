"""Toxicity: features, trees, calibration, held-out rows and odd tables."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from scenecast.llm import toxicity
from scenecast.llm.queries import op12_toxicity, table
from tests.conftest import SF_MID

LEXICON = {"nasty$": 3.0, "nast": 2.0, "grim": 1.6, "vile$": 4.0}


def named(text):
    return dict(zip(toxicity.FEATURES, toxicity.Reader(LEXICON).features(text)))


def test_words_stems_and_hidden_spellings():
    def found(token):
        t = toxicity.look_up(token, LEXICON)
        return t.weight, t.stem, t.hidden
    assert found("nasty") == (3.0, False, False) and found('"NASTY!"') == (3.0, False, False)
    assert found("nastiest") == (2.0, True, False) and found("grimly,") == (1.6, True, False)
    assert found("grim") == (0.0, False, False)           # a stem is shorter than its word
    for spelled in ("v1le", "V!LE", "v.i.l.e", "viiiile", "v-i-l-e"):
        assert found(spelled) == (4.0, False, True)
    assert found("") == (0.0, False, False) and found("%%%") == (0.0, False, False)


def test_features_of_a_text():
    f = named("You are vile! Well, GO away and stay away, all my nasty nasty friends ???")
    assert f["hits"] == 3 and f["distinct hits"] == 2 and f["largest weight"] == 4.0
    assert f["mean weight"] == pytest.approx(10 / 3) and f["near you"] == 1
    assert f["capital words"] == 1 / 15 and f["you density"] == 1 / 15
    assert f["marks"] == 1 / 15 and f["hit density"] == 3 / 15
    assert set(named("").values()) == {0.0}
    far = named("vile " + "word " * 40 + "you")
    assert far["near you"] == 0 and far["hits"] == 1


def test_features_do_not_depend_on_earlier_texts():
    reader = toxicity.Reader(LEXICON)
    texts = ["You nasty v1le one!", "a b c", "", "GRIMLY SAID", "You nasty v1le one!"]
    once = [toxicity.Reader(LEXICON).features(t) for t in texts]
    assert [reader.features(t) for t in texts] == once


def test_first_split_has_the_largest_gain():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 6, (80, 3)).astype(float)
    y = (x[:, 1] > 3).astype(float)
    weight = rng.uniform(0.5, 2, 80)
    tree = toxicity.boost(x, y, weight)[0]
    grad, hess = weight * (0.5 - y), weight * 0.25

    def term(rows):
        return grad[rows].sum() ** 2 / (hess[rows].sum() + toxicity.L2)
    gains = {(f, c): term(x[:, f] <= c) + term(x[:, f] > c) for f in range(3) for c in range(5)}
    assert (tree.features[0], tree.cuts[0]) == max(gains, key=gains.get) == (1, 3.0)
    # a leaf's value is the step of its own rows
    leaf = tree.margins(x)
    for v in np.unique(leaf):
        rows = leaf == v
        assert v == pytest.approx(-toxicity.RATE * grad[rows].sum() / (hess[rows].sum() + toxicity.L2))


def test_boosting_separates_what_one_tree_cannot():
    rng = np.random.default_rng(5)
    x = rng.uniform(0, 1, (600, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 2] > 0.4)).astype(float)
    p = toxicity.margins(toxicity.boost(x, y, np.ones(600)), x) > 0
    assert (p == y).mean() > 0.97


def test_isotonic_is_the_nearest_monotone_curve():
    rng = np.random.default_rng(7)
    for _ in range(50):
        n = int(rng.integers(1, 12))
        m, y = rng.integers(0, 6, n).astype(float), rng.integers(0, 2, n).astype(float)
        w = rng.uniform(0.2, 3, n)
        at, value = toxicity.isotonic(m, y, w)
        assert (np.diff(at) > 0).all() and (np.diff(value) >= 0).all()
        assert 0 <= value[0] and value[-1] <= 1
        # pooled means: max over starts of min over ends, with the two prior rows' shift
        groups = np.unique(m)
        num = np.array([(w * y)[m == g].sum() for g in groups])
        den = np.array([w[m == g].sum() for g in groups])
        best = [max(min(num[a:b + 1].sum() / den[a:b + 1].sum() for b in range(k, len(groups)))
                    for a in range(k + 1)) for k in range(len(groups))]
        same = [[j for j in range(len(groups)) if abs(best[j] - v) < 1e-12] for v in best]
        prior = (w * y).sum() / w.sum()
        want = [(num[s].sum() + prior) / (den[s].sum() + 1) for s in same]
        assert np.allclose(np.interp(groups, at, value), np.maximum.accumulate(want))


def test_query_on_held_out_rows(spark):
    rows = {r["doc_id"]: r for r in op12_toxicity(spark, SF_MID).collect()}
    assert len(rows) == table(spark, SF_MID, "documents").count()
    labels = {r["doc_id"]: r["toxic"] for r in table(spark, SF_MID, "labels").collect()}
    right = []
    for i, r in rows.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
        if r["held_out"] and i in labels:
            right.append(r["predicted"] == labels[i])
    assert len(right) > 50 and np.mean(right) >= 0.95


def toxic_corpus(n, start=0, seed=0):
    rng = random.Random(seed)
    plain = ["".join(rng.choice("aeioubcdfglmnprst") for _ in range(rng.randrange(2, 9)))
             for _ in range(600)]
    bad = ["snorkle", "blighter", "wazzock", "numpty", "gobbins"]
    rows = []
    for i in range(start, start + n):
        words = [rng.choice(plain) for _ in range(rng.randrange(5, 80))]
        toxic = i % 3 == 0
        for _ in range(rng.randrange(1, 4) if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(bad))
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_unseen_spellings_are_caught_and_clean_texts_left(spark):
    rows = toxic_corpus(900)
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.train(docs.drop("toxic"), docs.select("doc_id", "toxic"))
    new = toxic_corpus(300, 10_000, seed=1)
    hidden = str.maketrans("oe", "03")
    new = [(i, " ".join(w.translate(hidden) if w in ("snorkle", "blighter", "gobbins") else w
                        for w in t.split()), y) for i, t, y in new]
    got = {r["doc_id"]: r["predicted"] for r in toxicity.score_documents(
        spark.createDataFrame(new, docs.schema), model).collect()}
    assert np.mean([got[i] for i, _, y in new if y]) > 0.95
    assert np.mean([got[i] for i, _, y in new if not y]) < 0.02


def test_edges(spark, odd_docs, empty_docs):
    labels = spark.createDataFrame([(4, 1, 0), (5, 0, 0), (None, 1, 0), (6, None, 0), (999, 1, 0),
                                    (7, 0, 0), (7, 1, 0)], "doc_id long, toxic int, quality int")
    model = toxicity.train(odd_docs, labels)
    docs = odd_docs.withColumns({"score": F.lit("x"), "_t": F.lit(1), "_y": F.lit(2)})
    scored = toxicity.score_documents(docs, model).collect()
    assert len(scored) == 15 and all(0 <= r["score"] <= 1 for r in scored)
    assert {r["_t"] for r in scored} == {1}
    none = toxicity.train(odd_docs, labels.limit(0))
    assert none.constant == 0.5
    assert {r["score"] for r in toxicity.score_documents(odd_docs, none).collect()} == {0.5}
    one = toxicity.train(odd_docs, labels.filter("toxic = 0"))
    assert one.constant in (0.0, 0.5)
    assert toxicity.train(empty_docs, labels).constant == 0.5
    assert toxicity.score_documents(empty_docs, model).count() == 0


def test_sample_is_of_distinct_ids_and_bounded(spark, make_docs):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(200)],
                                   "doc_id long, toxic int, quality int")
    docs = make_docs([(0, f"copy {j}") for j in range(300)]
                     + [(i, f"text {i} " + "long " * 5_000) for i in range(1, 200)])
    rows, ones, zeros = toxicity.sample(docs, labels, "doc_id", "text", "toxic", 20)
    got = rows.collect()
    assert len({r["_id"] for r in got}) == len(got) == 40
    assert sum(r["_y"] for r in got) == 20 and ones + zeros == sum(
        zlib.crc32(str(i).encode()) % 5 != 0 for i in range(200))
