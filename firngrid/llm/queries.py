"""One registered query per operator, with production parameters over whole tables."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firngrid.llm import (
    byte_bpe,
    centroids,
    decontamination,
    filter_audit,
    fingerprints,
    jaccard_join,
    language_id,
    licenses,
    pii,
    quality,
    sharding,
    substring_dedup,
    token_rollup,
)
from firngrid.sources.shared import shared_dir, staged
from firngrid.sources.tables import read_table

#: The vocabulary and split pattern that the queries encode with.
BPE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


def fold(modulus: int, rest: int):
    """Whether crc32 of the id as text leaves ``rest``."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % modulus == rest, F.lit(False))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every text of documents, learned from three of four folds."""
    docs = read_table(spark, sf_dir, "documents")
    held_out = fold(4, 2)
    dictionaries = language_id.train(docs.where(~held_out))
    return language_id.identify(docs, dictionaries, {"held_out": held_out})


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices in every paragraph of documents."""
    docs = read_table(spark, sf_dir, "documents")
    return licenses.scan(docs, licenses.train(docs))


def quality_scores(spark: SparkSession, docs: DataFrame, sf_dir: str, *keep: str) -> DataFrame:
    """``doc_id``, ``keep``, ``score`` of ``docs``, learned from two of three folds of its labels."""
    profiled = staged(quality.profile(docs, *keep), "profile")
    part = F.crc32(F.col("doc_id").cast("string"))
    labels = read_table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    labelled = profiled.join(labels.where(part % 3 != 1), "doc_id").withColumn(
        "calibrate", F.floor(part / 3) % 4 == 0
    )
    return quality.score(profiled, quality.train(labelled), *keep)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every text of documents."""
    scored = quality_scores(spark, read_table(spark, sf_dir, "documents"), sf_dir)
    return scored.select(
        "doc_id",
        fold(3, 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op4_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token totals of documents: all inserted, toxic ones deleted, poor ones cut to a line.

    The second batch is sent twice, as after a lost answer.
    """
    docs = read_table(spark, sf_dir, "documents")
    counts = staged(token_rollup.counted(docs), "counts")
    lines = docs.withColumn("line", F.split("text", "\n")[0])
    line_counts = token_rollup.counted(lines, "line")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    toxic = labels.where("toxic = 1").select("doc_id")
    poor = labels.where("toxic = 0 and quality = 0").select("doc_id")
    rollup = token_rollup.TokenRollup(spark, f"{shared_dir(spark)}/firngrid/rollup-{uuid.uuid4().hex}")
    rollup.commit("inserts", token_rollup.signed_changes(counts, 1))
    for _ in range(2):
        rollup.commit("deletes", token_rollup.signed_changes(counts.join(toxic, "doc_id"), -1))
    cut = token_rollup.revised(counts.join(poor, "doc_id"), line_counts.join(poor, "doc_id"))
    rollup.commit("revisions", cut)
    return rollup.totals()


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of documents against every text of benchmark."""
    docs, items = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    return decontamination.hits(docs, items)


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of documents, of their edited texts, and how alike they are."""
    return fingerprints.compare_with_next(read_table(spark, sf_dir, "documents"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents under links of 4-word shingles at 0.85."""
    return jaccard_join.components(read_table(spark, sf_dir, "documents"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of documents without repeated windows of 50 words."""
    return substring_dedup.summary(read_table(spark, sf_dir, "documents"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of documents, encoded and decoded."""
    docs = read_table(spark, sf_dir, "documents")
    return byte_bpe.round_trip(docs, BPE_RANKS, PATTERN)


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every text of documents."""
    docs = read_table(spark, sf_dir, "documents")
    return pii.find(docs, pii.train(docs))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What filters A to E remove from documents, by part, order and step."""
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    return filter_audit.audit(filter_audit.with_words(docs, labels), "ABCDE")


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in 40 shards of nearly equal bytes."""
    rows = sharding.measured(read_table(spark, sf_dir, "documents"))
    return sharding.placed(rows, 40).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forty clusters of embeddings after five rounds."""
    return centroids.clustered(read_table(spark, sf_dir, "embeddings"), k=40, rounds=5, seed="2")


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_licenses": op2_licenses,
    "op3_quality": op3_quality,
    "op4_token_rollup": op4_token_rollup,
    "op5_decontamination": op5_decontamination,
    "op6_fingerprints": op6_fingerprints,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_pii": op10_pii,
    "op11_filter_audit": op11_filter_audit,
    "op12_sharding": op12_sharding,
    "op13_centroids": op13_centroids,
}

ORACLE_SQL: dict[str, str] = {
    "op4_token_rollup": token_rollup.ORACLE_SQL,
    "op5_decontamination": decontamination.ORACLE_SQL,
    "op7_jaccard_join": jaccard_join.ORACLE_SQL,
    "op8_substring_dedup": substring_dedup.ORACLE_SQL,
    "op11_filter_audit": filter_audit.ORACLE_SQL,
    "op13_centroids": centroids.ORACLE_SQL,
}
