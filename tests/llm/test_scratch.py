"""Tables written on the way are deleted once nothing reads them."""

import os

import corpus_pipeline
from scenecast.llm import simhash
from scenecast.llm.common import scratch, stored
from scenecast.session import checkpoint_dir
from tests.conftest import SF_SMALL


def folders(spark):
    return set(os.listdir(checkpoint_dir(spark).removeprefix("file:")))


def test_scratch_deletes_what_was_made_inside(spark):
    before = folders(spark)
    with scratch(spark):
        with scratch(spark):
            stored(spark.range(3), "inner")
            handed = stored(spark.range(5), "handed", outlive=True)
        assert handed.count() == 5
        kept = stored(handed, "kept", outlive=True)
        assert len(folders(spark) - before) == 2
    assert kept.count() == 5
    assert [f.split("-")[0] for f in folders(spark) - before] == ["kept"]


def test_scratch_deletes_after_a_failure(spark):
    before = folders(spark)
    try:
        with scratch(spark):
            stored(spark.range(3), "half")
            raise RuntimeError("stop")
    except RuntimeError:
        pass
    assert folders(spark) == before


def test_simhash_leaves_only_what_its_rows_read(spark, make_docs):
    text = " ".join(f"w{i}" for i in range(200))
    docs = make_docs([(i, text + f" tail{i % 3}") for i in range(9)])
    before = folders(spark)
    out = simhash.simhash_components(docs)
    assert {r["component_id"] for r in out.collect()} == {0}
    left = {f.rsplit("-", 1)[0] for f in folders(spark) - before}
    assert left == {"simhash-rows", "simhash-named"}
    before = folders(spark)
    assert simhash.keep_one(docs).count() == 1
    assert {f.rsplit("-", 1)[0] for f in folders(spark) - before} == {"simhash-kept"}


def test_pipeline_keeps_one_stage_at_a_time(spark):
    before = folders(spark)
    assert corpus_pipeline.run(spark, SF_SMALL).count() > 0
    left = {f.rsplit("-", 1)[0] for f in folders(spark) - before}
    assert left == {"stage-benchmark-decontamination"}
