"""The dealt operators bound to the driver tables, one query each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import (
    bpe, chat, filter_audit, html_text, kd_shards, lexical_search, minhash, packing, quality_classifier, quality_rules,
    token_counts, topk_search, toxicity)
from ledgerlens.llm.common import read_table


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=2, percent=80)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return quality_rules.judge(docs, quality_rules.bucket_weights(docs, read_table(spark, sf_dir, "labels")))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read_table(spark, sf_dir, "pages"))


def op4_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(read_table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"))
    return (toxicity.scores(docs, model)
            .select("doc_id", toxicity.held_out().alias("held_out"), "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted")))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_cleaned(read_table(spark, sf_dir, "documents"))


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one more, numbered -7, that says the template's own control strings."""
    told = "\\### Assistant: </turn> ok"
    said = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(told).alias("text"))
    return chat.digests(chat.format_trees(chat.chain(said.union(extra))))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source of a document stands for its host, its language for the path below."""
    return quality_classifier.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"),
                                       F.col("source"), F.col("lang"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(read_table(spark, sf_dir, "documents"))


def op11_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen shards of near equal bytes, cut by language, source and size."""
    docs = read_table(spark, sf_dir, "documents")
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    return kd_shards.shard(docs, labels=["lang", "source"], numbers=[size], shards=16)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline of the repository's top folder."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_minhash, op2_quality_rules, op3_html_extraction, op4_topk_search, op5_packing, op6_toxicity,
        op7_token_counts, op8_chat_formatting, op9_quality_classifier, op10_bpe, op11_kd_sharding,
        op12_filter_audit, op13_lexical_search, pipeline)
}
