"""A training-data pipeline over ``documents``: five corpus operators, each on what the one
before it kept.

Every stage but the last returns the columns of its input; the last returns what was
written as token ids (doc_id, start, n_tokens, ids_crc32), where a document that the mix
takes twice is written twice.

Rows are told apart by doc_id and a hash of the text (null ids match each other), so
repeated ids, empty or null texts and clashing extra columns pass through every stage.
Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.llm import line_quality, pivotal_mix, simple8b, superminhash, winnow
from tallybook.llm.frames import Scratch, packed, same, table


def _without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """``docs`` but for the rows whose (doc_id, t) is rejected; only the rejected side is a small one."""
    gone = rejected.select(F.col("doc_id").alias("_d"), F.col("t").alias("_t")).distinct()
    rows = packed(docs, _id=docs["doc_id"], _key=F.xxhash64(docs["text"]))
    return rows.join(gone, same(rows["_id"], gone["_d"]) & (rows["_key"] == gone["_t"]), "left_anti").select("_row.*")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that pass, without the common lines that the rules take from them."""
    scratch = Scratch(spark, "lines")
    verdict = line_quality.judge(spark, docs, scratch=scratch)
    lost = spark.read.parquet(f"{scratch.root}/lost_lines")
    return line_quality.strip_common_lines(_without(docs, verdict.where(~F.col("kept"))), lost)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class: the one with the smallest id (rows that share that id: one of them)."""
    scratch = Scratch(spark, "neardedup")
    found = scratch.save(superminhash.classes(spark, docs), "found")
    left = _without(docs, found.where(~F.col("kept")))
    again = scratch.save(found.where("kept AND n_shingles > 0").groupBy(F.col("component_id").alias("_c")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_c"), "again")
    # Only repeated ids: their rows with words are brought to one, rows without words link with nothing.
    rows = packed(left, _id=left["doc_id"], _key=F.xxhash64(left["text"]), _worded=F.coalesce(left["text"], F.lit("")).rlike("[^\\x20\\x09-\\x0D]"))
    on = same(rows["_id"], again["_c"]) & rows["_worded"]
    one = rows.join(again, on, "left_semi").groupBy("_id").agg(F.min_by("_row", "_key").alias("_row"))
    return rows.join(again, on, "left_anti").select("_row.*").unionAll(one.select("_row.*"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = winnow.contamination(spark, docs, table(spark, sf_dir, "benchmark"))
    return _without(docs, found.where("contaminated"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pivotal_mix.mixed_rows(spark, docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    segments, manifest = simple8b.encode_documents(spark, docs, public_tokenizers.path("byte_bpe_50k.json"))
    return simple8b.document_digests(segments, manifest)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
    ("token_ids", token_ids),
]

#: The last stage's ids come from a tokenizer library, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = scratch.save(stage(spark, docs, sf_dir), name)
        if i:
            scratch.drop(STAGES[i - 1][0])
    return docs
