"""The corpus pipeline: five stages from raw documents to token ids.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before it
kept; all but the last return the columns of ``documents``.  ``run`` writes each stage as
Parquet in the shared checkpoint folder and reads it back, so a lost executor costs
one stage's tasks, never the stages before.  What a stage wrote on its way, and the rows
of the stage before it, are deleted once its own rows are written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scenecast.llm import bpe_codec, decontamination, line_dedup, quality, simhash
from scenecast.llm.common import drop_stored, scratch, stored
from scenecast.llm.queries import table, vocabulary_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    net = quality.train(docs, table(spark, sf_dir, "labels"))
    scored = quality.score_column(F.col("text"), net)
    return docs.filter(scored >= quality.THRESHOLD)


def _aside(docs: DataFrame, step: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``step`` on the documents, with names of other columns that its own cannot clash with."""
    names = {c: f"__doc_{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    out = step(docs.withColumnsRenamed(names)).select("doc_id", "text", *names.values())
    return out.withColumnsRenamed({v: k for k, v in names.items()}).select(docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that a later document repeats; ``n_chars`` follows the text."""
    kept = _aside(docs, line_dedup.apply_keep)
    if "n_chars" not in docs.columns:
        return kept
    return kept.withColumn("n_chars", F.char_length("text").cast("long"))


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return _aside(docs, lambda rows: simhash.keep_one(
        rows, shingle=simhash.SHINGLE, max_bits=simhash.MAX_BITS))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed token ids of every document that is left, with a check of the way back."""
    path = vocabulary_path()
    coded = bpe_codec.decode(bpe_codec.encode(docs, path), path)
    return coded.select("doc_id", "lang", "source", bpe_codec.n_tokens().alias("n_tokens"), "ids",
                        F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("SimHash near-dedup", near_dup_stage),
    ("benchmark decontamination", decontamination_stage),
    ("BPE encoding and decoding", encode_stage),
]

# Fingerprints, the two models and the merge loop have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        with scratch(spark):
            docs = stored(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"),
                          outlive=True)
        if before is not None:
            drop_stored(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
