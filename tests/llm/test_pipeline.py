"""The pipeline stage by stage against brute force, and the entry point without it."""

import hashlib
import os
import shutil
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from scenecast.llm import decontamination, quality
from scenecast.llm.queries import table, vocabulary_path
from tests.conftest import SF_SMALL
from tests.llm.test_native import kept_lines
from tests.llm.test_search import overlap, plain_components

ROOT = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows after every stage, each written and read again."""
    docs = table(spark, SF_SMALL, "documents")
    out, folder = [docs.collect()], tmp_path_factory.mktemp("stages")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF_SMALL).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        out.append(docs.collect())
    return out


def test_columns_and_order(spark, stages):
    columns = table(spark, SF_SMALL, "documents").columns
    for rows in stages[:-1]:
        assert list(rows[0].asDict()) == columns
    assert [len(r) for r in stages] == sorted((len(r) for r in stages), reverse=True)


def test_quality_stage(spark, stages):
    labels = {r["doc_id"]: r["quality"] for r in table(spark, SF_SMALL, "labels").collect()}
    kept = {r["doc_id"] for r in stages[1]}
    net = quality.train(table(spark, SF_SMALL, "documents"), table(spark, SF_SMALL, "labels"))
    scores = quality.Scorer(net).scores([r["text"].encode() for r in stages[0]])
    assert kept == {r["doc_id"] for r, s in zip(stages[0], scores) if s >= quality.THRESHOLD}
    clean = [i for i, q in labels.items() if q == 1]
    assert sum(i in kept for i in clean) >= 0.95 * len(clean)


def test_line_stage(stages):
    rows = [(r["doc_id"], r["text"]) for r in stages[1]]
    want = {i: "\n".join(x for x, k in zip(t.split("\n"), f) if k)
            for (i, t), f in zip(rows, kept_lines(rows))}
    assert {r["doc_id"]: r["text"] for r in stages[2]} == want
    assert all(r["n_chars"] == len(r["text"]) for r in stages[2])


def test_near_dup_stage(stages):
    rows = [(r["doc_id"], r["text"]) for r in stages[2]]
    keep = {i for i, _, c in plain_components(rows) if i == c}
    assert sorted(r["doc_id"] for r in stages[3]) == sorted(keep) and len(keep) < len(rows)
    assert {r["doc_id"]: r["text"] for r in stages[3]} == {i: t for i, t in rows if i in keep}


def test_decontamination_stage(spark, stages):
    items = [r["text"] for r in table(spark, SF_SMALL, "benchmark").collect()]
    gone = {r["doc_id"] for r in stages[3]} - {r["doc_id"] for r in stages[4]}
    for r in stages[3]:
        best = max(overlap(r["text"], t) for t in items)
        assert r["doc_id"] in gone if best == 1.0 else True
        assert r["doc_id"] not in gone if best < decontamination.OVERLAP else True


def test_encode_stage(stages):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(vocabulary_path())
    texts = {r["doc_id"]: r["text"] for r in stages[4]}
    assert {r["doc_id"] for r in stages[5]} == set(texts)
    for r in stages[5]:
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        assert bytes(r["ids"]) == packed and r["n_tokens"] == len(ids)
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_run_equals_the_stages(spark, stages):
    got = {r["doc_id"]: r["ids_sha256"] for r in corpus_pipeline.run(spark, SF_SMALL).collect()}
    assert got == {r["doc_id"]: r["ids_sha256"] for r in stages[5]}


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES])
def test_stages_take_odd_and_empty_documents(spark, stage, odd_docs, empty_docs):
    assert stage(spark, empty_docs, SF_SMALL).count() == 0
    rows = stage(spark, odd_docs, SF_SMALL).collect()
    assert 0 < len(rows) <= odd_docs.count()


def test_entry_without_the_text_operators(tmp_path):
    """The other queries import when this subpackage and the pipeline are gone."""
    shutil.copytree(f"{ROOT}/scenecast", tmp_path / "scenecast",
                    ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); print('pipeline' in q, len(q) > 40)"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True,
                          text=True, env={**os.environ, "PYTHONPATH": str(tmp_path)}, timeout=120)
    assert done.stdout.strip() == "False True", done.stderr


def test_clashing_columns_keep_their_values(spark, odd_docs):
    names = ("n_lines", "n_dropped", "_flips", "_lines", "_k1", "_text", "matches", "fp", "_n")
    docs = odd_docs.withColumns({c: F.lit(f"their {c}") for c in names})
    for _, stage in corpus_pipeline.STAGES[1:-1]:
        out = stage(spark, docs, SF_SMALL)
        assert out.columns == docs.columns
        for r in out.collect():
            assert [r[c] for c in names] == [f"their {c}" for c in names]
