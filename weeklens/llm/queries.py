"""Registered queries of the training-data operators: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weeklens.llm import decontaminate, filter_audit, mixing, oracles, pii, quality, recurrent_lm, sharding, simhash, spelling, token_count, toxicity, warc, weak_rules
from weeklens.llm.common import table


def op1_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(docs.select("doc_id", "text"), model).select("doc_id", "held_out", "score", "predicted")


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.mix(table(spark, sf_dir, "documents")).rows
    return rows.select("doc_id", "size", "source_size", "target", "taken")


def op4_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(table(spark, sf_dir, "documents"))


def op5_weak_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return weak_rules.judged(table(spark, sf_dir, "documents")).select("doc_id", *counts, "base_failed", "kept", "probability")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.judged(docs, table(spark, sf_dir, "benchmark"), keep_text=False)
    digest = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    return found.select("doc_id", *[F.col(f"_{c}").alias(c) for c in digest])


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_count.with_token_counts(docs).select("doc_id", "n_tokens")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.scored(docs.select("doc_id", "text"), model).select("doc_id", "held_out", "score", "predicted")


def op9_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_recurrent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recurrent_lm.scored(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_contextual_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.found(table(spark, sf_dir, "documents")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    operators = (
        op1_warc_index, op2_toxicity, op3_mix_sources, op4_kd_shards, op5_weak_rules, op6_decontaminate, op7_token_counts,
        op8_quality, op9_simhash_groups, op10_recurrent_lm, op11_spelling_variants,
        op12_filter_audit, op13_contextual_pii,
    )
    return {f.__name__: f for f in operators} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return oracles.oracle_sql()
