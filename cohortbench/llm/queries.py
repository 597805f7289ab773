"""The registered queries: each operator on its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortbench.llm import (
    ann, chat, mixing, packing, pii, quality, resampling, sharding, simhash, topk, toxicity, url_rules, whitening,
)
from cohortbench.llm.rules import URL_RULES


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on every page; pages of low quality or toxic content are labelled ``block``."""
    labels = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("block"))
    return url_rules.judge(table(spark, sf_dir, "pages"), URL_RULES, labels)


def op2_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.spans_of(table(spark, sf_dir, "documents"))
    found = found.select(F.col("__row.doc_id").alias("doc_id"), "spans",
                         F.filter("spans", lambda s: s["base"]).alias("base"))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [(F.size("base") - F.size(F.array_remove(kinds, i))).cast("long").alias(f"n_{kind}")
              for i, kind in enumerate(pii.KINDS)]
    return found.select("doc_id", *counts, F.sha2(pii.written(F.col("base")), 256).alias("base_sha256"),
                        pii.written(F.col("spans")).alias("spans"))


def op3_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.mix(docs).select(F.col("__row.doc_id").alias("doc_id"), "source", "epoch", "block",
                                   "release", "deadline", "slot", "position")


def op4_graph_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = table(spark, sf_dir, "embeddings")
    return ann.nearest(base, base.where(F.col("vec_id") % 20 == 0))


def op5_toxicity_gru(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.measured(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        "base_failed", F.col("failed").isNull().alias("kept"))


def op7_simhash_gray(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.document_components(table(spark, sf_dir, "documents"))


def op8_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op9_lpt_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op10_chat_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.collapse(table(spark, sf_dir, "conversations"))


def op11_mtree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = table(spark, sf_dir, "embeddings")
    return topk.top_k(base, base.where(F.col("vec_id") % 100 == 0))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (
    op1_url_rules, op2_pii_spans, op3_pfair_mix, op4_graph_ann, op5_toxicity_gru, op6_quality_cascade,
    op7_simhash_gray, op8_length_buckets, op9_lpt_shards, op10_chat_snapshots,
    op11_mtree_topk, op12_whitening, op13_importance_resampling)}
