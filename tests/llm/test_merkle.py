"""Merkle manifest: trees, proofs and multiproofs against a plain recursion."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from scenecast.llm import merkle
from scenecast.llm.queries import op11_merkle_manifest, table
from tests.conftest import SF_SMALL


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(r, text=...):
    values = [r["doc_id"], r["source"], r["lang"], r["n_chars"], r["text"] if text is ... else text]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_levels(level):
    out = [level]
    while len(out[-1]) > 1:
        now = out[-1]
        out.append([sha("".join(now[i:i + 3])) for i in range(0, len(now), 3)])
    return out


def way(levels, pos):
    """(left, right) siblings per level."""
    out = []
    for level in levels[:-1]:
        run = range(pos - pos % 3, min(len(level), pos - pos % 3 + 3))
        out.append(([level[p] for p in run if p < pos], [level[p] for p in run if p > pos]))
        pos //= 3
    return out


def plain_manifest(rows):
    """(id, leaf, subroot, root, siblings, folded root of the altered leaf) per row."""
    first = (lambda v: (v is not None, v.encode() if isinstance(v, str) else v or 0))
    sources = sorted({r["source"] for r in rows}, key=first)
    trees = {}
    for s in sources:
        own = sorted((r for r in rows if r["source"] == s),
                     key=lambda r: (first(r["doc_id"]), plain_leaf(r)))
        trees[s] = own, plain_levels([plain_leaf(r) for r in own])
    top = plain_levels([trees[s][1][-1][0] for s in sources])
    out = []
    for rank, s in enumerate(sources):
        own, levels = trees[s]
        for pos, r in enumerate(own):
            path = way(levels, pos) + way(top, rank)
            claim = plain_leaf(r)
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0:
                claim = plain_leaf(r, r["text"] and r["text"].replace("\n", ""))
            for left, right in path:
                claim = sha("".join([*left, claim, *right]))
            out.append((r["doc_id"], plain_leaf(r), levels[-1][0], top[-1][0],
                        [d for left, right in path for d in left + right], claim))
    return out


def key(t):
    return str(t)


def got_rows(manifest, partition):
    return sorted([(r["id"], r["leaf"], r["subroot"], manifest.root, list(r["siblings"]),
                    r["folded_root"]) for r in merkle.prove(
                        manifest, claim="claim", partition=partition).collect()], key=key)


@pytest.mark.parametrize("height,partition", [(1, 3), (2, 10), (8, 8192)])
def test_manifest_equals_the_recursion(spark, make_docs, odd_texts, height, partition):
    docs = make_docs(odd_texts + [(i, f"text\n{i}") for i in range(100, 175)])
    # one group with most rows, some of one row, a null one, rows that stand twice
    docs = docs.withColumn("source", F.when(F.col("doc_id") < 8, F.col("doc_id").cast("string"))
                           .when(F.col("doc_id") == 9, F.lit(None)).otherwise(F.lit("é hot")))
    docs = docs.withColumns({"leaf": F.lit("x"), "_g": F.lit(1), "rank": F.lit(2)})
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")).bitwiseAND(1) == 0
    altered = merkle.leaf(*[merkle.tampered() if f == "text" else F.col(f) for f in merkle.FIELDS])
    manifest = merkle.build(docs, keep={"claim": F.when(even, F.unhex(altered))}, height=height)
    want = sorted(plain_manifest([r.asDict() for r in docs.collect()]), key=key)
    assert got_rows(manifest, partition) == want
    manifest.drop()


def test_empty_table_and_single_rows(spark, make_docs, empty_docs):
    manifest = merkle.manifest_of_documents(empty_docs)
    assert manifest.root is None and merkle.prove(manifest, claim="claim").count() == 0
    one = make_docs([(7, "only")])
    manifest = merkle.manifest_of_documents(one)
    row = merkle.prove(manifest).first()
    assert row["leaf"] == row["subroot"] == manifest.root and row["siblings"] == []
    assert row["verified"]


def test_missing_is_the_least_union():
    """Nothing that is fetched follows from the rest, and all proofs can be expanded."""
    rng = random.Random(2)
    for _ in range(200):
        size = rng.randrange(1, 60)
        wanted = set(rng.sample(range(size), rng.randrange(1, size + 1)))
        levels = [[bytes.fromhex(d) for d in level]
                  for level in plain_levels([sha(str(i)) for i in range(size)])]
        need = merkle.missing({(5, size): wanted})
        assert len(set(need)) == len(need)
        covered = {(0, p) for p in wanted}
        for level in range(len(levels) - 1):
            covered |= {(level + 1, p // 3) for l, p in list(covered) if l == level}
        assert not {(l, p) for _, l, p in need} & covered
        built = merkle._tree_nodes(5, size, {p: levels[0][p] for p in wanted},
                                   {(5, l, p): levels[l][p] for _, l, p in need})
        assert built[-1] == {0: levels[-1][0]}
        for p in wanted:
            assert merkle.fold(levels[0][p], merkle._path(built, size, p)) == levels[-1][0]
        used = {(l, q) for p in wanted for l, (a, b) in enumerate(merkle._path(built, size, p))
                for q in [p // 3 ** l - len(a) + i for i in range(len(a))]
                + [p // 3 ** l + 1 + i for i in range(len(b))]}
        assert {(l, p) for _, l, p in need} <= used


def test_proofs_of_some_documents(spark, make_docs):
    docs = make_docs([(i, f"text {i}") for i in range(200)])
    manifest = merkle.manifest_of_documents(docs)
    some = manifest.leaves.filter("id % 37 = 5")
    got = {r["id"]: (r["leaf"], r["siblings"]) for r in merkle.prove(manifest, some).collect()}
    want = {t[0]: (t[1], t[4]) for t in plain_manifest([r.asDict() for r in docs.collect()])}
    assert got == {i: want[i] for i in range(200) if i % 37 == 5}


def test_query_equals_the_recursion(spark):
    want = sorted(plain_manifest([r.asDict() for r in table(spark, SF_SMALL, "documents").collect()]),
                  key=lambda t: t[0])
    got = op11_merkle_manifest(spark, SF_SMALL).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == [
        (t[0], t[1], t[2], t[3], sha("".join(t[4])), t[5], t[5] == t[3]) for t in want]
    assert 0 < sum(r["verified"] for r in got) < len(got)
