"""The registered queries of this package, over whole tables, and the SQL they are compared with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from fiscalmill.llm import bit_sliced, chat, html_text, importance, mixing, near_dedup, pieces, quality_classifier, quality_rules, simhash, suffix_index, suffix_trees, whitening
from fiscalmill.llm.common import shipped, table


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.groups(table(spark, sf_dir, "documents"), near_dedup.CONTRACT)


def op2_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.segmentations(table(spark, sf_dir, "documents"))


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_bit_sliced_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = bit_sliced.quantised(table(spark, sf_dir, "embeddings"))
    return bit_sliced.top_k(vectors, vectors.where(F.col("vec_id") % 100 == 0))


def op6_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_index.repeats(table(spark, sf_dir, "documents"))


def op7_repeated_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_trees.repeats(table(spark, sf_dir, "documents"))


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan_documents(table(spark, sf_dir, "documents"))


def op10_format_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(table(spark, sf_dir, "conversations"))


def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.groups(table(spark, sf_dir, "documents"))


def op11_whiten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


LLM_QUERIES = {
    "op11_whiten": op11_whiten,
    "op12_simhash": op12_simhash,
    "op13_resample": op13_resample,
    "pipeline": corpus_pipeline.run,
    "op2_sentence_pieces": op2_sentence_pieces,
    "op7_repeated_words": op7_repeated_words,
    "op6_repeated_bytes": op6_repeated_bytes,
    "op1_near_dedup": op1_near_dedup,
    "op3_html_text": op3_html_text,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_bit_sliced_top_k": op5_bit_sliced_top_k,
    "op8_mix_sources": op8_mix_sources,
    "op10_format_chats": op10_format_chats,
    "op9_quality_rules": op9_quality_rules,
}

LLM_QUERIES = {name: shipped(query) for name, query in LLM_QUERIES.items()}

LLM_ORACLES = {
    "op13_resample": importance.ORACLE,
    "op7_repeated_words": suffix_trees.ORACLE,
    "op5_bit_sliced_top_k": bit_sliced.ORACLE,
    "op8_mix_sources": mixing.ORACLE,
    "op10_format_chats": chat.ORACLE,
    "op9_quality_rules": quality_rules.ORACLE,
}
