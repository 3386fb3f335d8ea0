"""One registered query per corpus operator, over its whole tables, and their oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import conversation_repair, html_layout, line_quality, line_suffix, pca_centroids, pivotal_mix, quote_links, recompress, secret_forest, simple8b, superminhash, toxicity, winnow
from .frames import table
from .oracle import ORACLE


def op1_simple8b(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    segments, manifest = simple8b.encode_documents(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return simple8b.document_digests(segments, manifest)


def op2_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.judge(spark, table(spark, sf_dir, "documents")).drop("t")


def op3_html_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = html_layout.extract(spark, table(spark, sf_dir, "pages"))
    return out.select("page_id", F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"), "text")


def op4_line_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_suffix.dedup_lines(spark, table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", "n_runs", "longest_run", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op5_winnow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.contamination(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("t", "spans")


def op6_secret_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_forest.scan(spark, table(spark, sf_dir, "documents"))


def op7_recompress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recompress.remove_repeats(spark, table(spark, sf_dir, "documents"))


def op8_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return superminhash.classes(spark, table(spark, sf_dir, "documents")).drop("t")


def op9_pivotal_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivotal_mix.mix(spark, table(spark, sf_dir, "documents")).drop("t")


def op10_quote_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quote_links.conversations(spark, table(spark, sf_dir, "conversations"))


def op11_counterfactual(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_pca_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pca_centroids.digests(*pca_centroids.cluster(spark, table(spark, sf_dir, "embeddings")))


def op13_audit_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = conversation_repair.counted(table(spark, sf_dir, "conversations"))
    return conversation_repair.audits(spark, conversation_repair.damage(turns), turns)


QUERIES = {f.__name__: f for f in (op1_simple8b, op2_line_quality, op3_html_layout, op4_line_suffix, op5_winnow, op6_secret_forest, op7_recompress, op8_superminhash, op9_pivotal_mix, op10_quote_links, op11_counterfactual, op12_pca_centroids, op13_audit_repair)}
assert set(ORACLE) <= set(QUERIES)
