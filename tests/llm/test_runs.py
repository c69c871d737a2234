"""Periodic runs: against every lag at every place, odd rows, the query's loop and SQL."""

import hashlib
import random
import time
import zlib

import pytest
from pyspark.sql import functions as F

from scenecast.llm import runs
from scenecast.llm.queries import op13_periodic_runs, table
from tests.conftest import SF_SMALL


def every_lag(words, min_length=24, min_power=3):
    """Longest stretches of every lag; the smallest lag of those that coincide."""
    n, found = len(words), {}
    for q in range(1, n // min_power + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(min_length, min_power * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, length, q) for (s, length), q in found.items())


@pytest.mark.parametrize("min_length,min_power", [(24, 3), (3, 3), (6, 3), (8, 4), (1, 3), (30, 5)])
def test_runs_equal_every_lag(min_length, min_power):
    rng = random.Random(min_length * 10 + min_power)
    for _ in range(300):
        letters = rng.choice([1, 2, 3, 5, 30])
        words = [b"%d" % rng.randrange(letters) for _ in range(rng.randrange(130))]
        for _ in range(rng.randrange(4) if len(words) > 6 else 0):
            a = rng.randrange(len(words) - 3)
            p, end = rng.randrange(1, max(2, (len(words) - a) // 2)), rng.randrange(a, len(words))
            for i in range(a, end):
                words[i] = words[a + (i - a) % p]
        assert runs.find_runs(words, min_length, min_power) == every_lag(words, min_length, min_power)


def test_seed_words_is_the_least_match():
    assert runs.seed_words() == 16
    assert runs.seed_words(1, 3) == 2
    with pytest.raises(ValueError):
        runs.find_runs([b"a"] * 30, 24, 2)


def test_hash_of_sequences_never_misses_a_repeat():
    rng = random.Random(4)
    for seed in (2, 3, 5, 16):
        for _ in range(200):
            ids = runs.word_ids([b"%d" % rng.randrange(2) for _ in range(rng.randrange(40))])
            seen = [tuple(ids[i:i + seed]) for i in range(len(ids) - seed + 1)]
            if len(set(seen)) < len(seen):
                assert runs.may_have_runs(ids, seed)


@pytest.mark.parametrize("words", [[b"a"] * 400_000, [b"%d" % (i % 4999) for i in range(400_000)]])
def test_very_long_texts_are_not_quadratic(words):
    t0 = time.perf_counter()
    assert [(s, n) for s, n, _ in runs.find_runs(words)] == [(0, 400_000)]
    assert time.perf_counter() - t0 < 30


def test_collapse_keeps_the_first_period():
    words = [b"x"] + [b"a", b"b"] * 15 + [b"y"]
    found = runs.find_runs(words)
    assert found == [(1, 30, 2)]
    assert runs.collapse(words, found) == [b"x", b"a", b"b", b"y"]


def test_operator_on_odd_rows(spark, odd_docs, empty_docs):
    docs = odd_docs.withColumn("runs", F.lit("theirs")).withColumn("__x", F.lit(1))
    got = runs.periodic_runs(docs).collect()
    assert len(got) == odd_docs.count()
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[1]["runs"] == [] and by_id[1]["collapsed"] == ""
    assert by_id[2]["collapsed"] == "" and by_id[3]["collapsed"] == ""
    assert [(r["start"], r["length"], r["period"]) for r in by_id[4]["runs"]] == [(0, 30_000, 977)]
    assert len(by_id[4]["collapsed"].split()) == 977
    assert by_id[13]["collapsed"] == "\x00\x1c\x85 odd controls"       # only ASCII white space parts
    assert by_id[5]["__x"] == 1
    assert runs.periodic_runs(empty_docs).count() == 0


def test_strongest_run_is_exact(spark):
    rows = [([(0, 25, 8), (3, 50, 16), (4, 24, 8)],), ([],), ([(5, 30, 3), (5, 40, 4), (9, 60, 6)],)]
    df = spark.createDataFrame(rows, "runs array<struct<start:long,length:long,period:long>>")
    got = [r[0] for r in df.select(runs.strongest(F.col("runs"))).collect()]
    assert tuple(got[0]) == (0, 25, 8) and got[1] is None and tuple(got[2]) == (5, 30, 3)


def expected(doc_id, text):
    words = (text or "").encode().split()
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a, own = g % n, list(words)
        p = 1 + (n - a) // (3 + g % 8)
        for i in range(a, n):
            words[i] = own[a + (i - a) % p]
    found = every_lag(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    listing = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    best = min(found, key=lambda r: (-r[1] * 10 ** 30 // r[2], r[0], r[2]), default=None)
    return (len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            hashlib.sha256(listing.encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest())


def test_query_equals_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in table(spark, SF_SMALL, "documents").collect()}
    got = op13_periodic_runs(spark, SF_SMALL).collect()
    assert len(got) == len(texts)
    assert sum(r["n_runs"] > 0 for r in got) > 5
    for r in got:
        if len(texts[r["doc_id"]]) < 20_000:
            assert tuple(r)[1:] == expected(r["doc_id"], texts[r["doc_id"]])


def test_query_on_null_ids_and_texts(spark, odd_docs):
    found = runs.periodic_runs(odd_docs.select("doc_id", runs.looped_text(
        F.col("doc_id"), F.col("text")).alias("text"))).collect()
    assert len(found) == 15
    by_id = {r["doc_id"]: r for r in found}
    assert by_id[None]["runs"] == []
