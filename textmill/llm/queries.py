"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.llm import (
    decontaminate,
    lm_scoring,
    merkle,
    minhash,
    mixing,
    packing,
    pii,
    quality_rules,
    spelling,
    suffix_dedup,
    tool_calls,
    url_rules,
    weak_quality,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = quality_rules.rate_documents(table(spark, sf_dir, "documents"))
    return rated.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "n_left",
    )


@query
def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_rules.judge_urls(table(spark, sf_dir, "pages"), url_rules.rules_frame(spark))
    return judged.withColumnRenamed("id", "page_id")


@query
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


@query
def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.col("size").cast("long").alias("n_shingles"),
        F.col("component").alias("component_id"),
        F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"),
    )


@query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumnRenamed("id", "doc_id")


@query
def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    # The prefix is bound outside the function: a second parameter of it would get the place in the array.
    of_kind = lambda prefix: F.filter("base", lambda s: F.startswith(s, F.lit(prefix)))
    counted = [F.size(of_kind(f"{kind}:")).cast("long").alias(f"n_{kind}") for kind in pii.KINDS]
    return found.select(
        F.col("id").alias("doc_id"),
        *counted,
        F.sha2(F.array_join("base", ","), 256).alias("base_sha256"),
        F.array_join("spans", ",").alias("spans"),
    )


@query
def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lm_scoring.score(table(spark, sf_dir, "documents"))
    return scored.withColumnRenamed("id", "doc_id")


@query
def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = tool_calls.from_conversations(table(spark, sf_dir, "conversations"))
    formatted = tool_calls.format_chat(messages)
    return formatted.withColumn("errors", F.array_join("errors", "; "))


@query
def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = weak_quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.withColumn("kept", F.col("label") == "clean").withColumnRenamed("id", "doc_id")


@query
def op8_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.find(table(spark, sf_dir, "documents"))
    return found.withColumnRenamed("id", "doc_id")


@query
def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query
def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.find(table(spark, sf_dir, "documents"))


@query
def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.check_documents(table(spark, sf_dir, "documents"))
