"""The registered queries of the text operators: whole tables, production parameters."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scenecast.llm import (ann, bpe_codec, decontamination, html_blocks, line_dedup, merkle,
                           quality, runs, secrets, sharding, simhash, token_counts, toxicity)


def vocabulary_path() -> str:
    """Path of the byte-level vocabulary: ``BPE_VOCABULARY`` or the installed package's file."""
    if path := os.environ.get("BPE_VOCABULARY"):
        return path
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BPE ids of every document and the text decoded from them, as digests."""
    path = vocabulary_path()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe_codec.decode(bpe_codec.encode(docs, path), path)
    return coded.select("doc_id", bpe_codec.n_tokens().alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, owner-specific ones told from copied examples."""
    return secrets.digest(secrets.scan_secrets(table(spark, sf_dir, "documents")))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines dropped from every document, and the digest of what is kept."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.apply_keep(docs).select(
        "doc_id", "n_lines", "n_dropped",
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents, one row per document and item."""
    return decontamination.contaminated(table(spark, sf_dir, "documents"),
                                        table(spark, sf_dir, "benchmark"))


def op5_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five nearest vectors of every fiftieth."""
    return ann.nearest(table(spark, sf_dir, "embeddings"), every=50, k=5)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, vocabulary_path()).select(
        "doc_id", "n_bytes", "n_tokens", "over_limit")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard of every document by extendible hashing."""
    return sharding.extendible_shards(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    net = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score_documents(docs, net).select(
        "doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    weights = html_blocks.train(pages)
    return html_blocks.extract(pages, weights).select("page_id", "url", "text", "n_chars")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proof of every document against the manifest's root, half of them for an altered text."""
    manifest = merkle.manifest_of_documents(table(spark, sf_dir, "documents"))
    return merkle.prove(manifest, claim="claim").select(
        F.col("id").alias("doc_id"), "leaf", "subroot", F.lit(manifest.root).alias("root"),
        F.sha2(F.array_join("siblings", "").cast("binary"), 256).alias("proof_sha256"),
        "folded_root", "verified")


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_documents(docs, model).select(
        "doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document's words; one document in ten gets a loop first."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    looped = docs.select("doc_id", runs.looped_text(F.col("doc_id"), F.col("text")).alias("text"))
    found = runs.periodic_runs(looped)
    best = runs.strongest(F.col("runs"))
    return (found.select("doc_id", "runs", "collapsed", best.alias("best"))
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start",
                    "best.length", "best.period",
                    F.expr("1000 * best.length div best.period").alias("exponent_milli"),
                    F.sha2(runs.runs_text(F.col("runs")).cast("binary"), 256).alias("runs_sha256"),
                    F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_bpe_codec, op2_secret_scan, op3_line_dedup, op4_decontamination, op5_nearest,
        op6_token_counts, op7_sharding, op8_quality, op9_simhash, op10_main_text,
        op11_merkle_manifest, op12_toxicity, op13_periodic_runs)}

# SQL for the operators that it can express.  Positions count code points.
_STRIP = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_KEY = f"translate(trim(line, {_STRIP}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE: dict[str, str] = {
    "op3_line_dedup": f"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
k AS (SELECT doc_id, pos, line, {_KEY} AS key FROM l),
shared AS (
  SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= {line_dedup.MIN_CHARS}
  GROUP BY key HAVING count(DISTINCT doc_id) >= {line_dedup.MIN_DOCS}),
m AS (
  SELECT k.doc_id, k.pos, k.line,
         shared.key IS NOT NULL AND k.doc_id <> shared.keeper AS dropped
  FROM k LEFT JOIN shared USING (key))
SELECT doc_id, count(*)::BIGINT AS n_lines,
       count(*) FILTER (WHERE dropped)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), ''))
         AS kept_sha256
FROM m GROUP BY doc_id
""",
    "op7_sharding": sharding.ORACLE,
    "op11_merkle_manifest": merkle.ORACLE,
    "op13_periodic_runs": runs.ORACLE,
}
