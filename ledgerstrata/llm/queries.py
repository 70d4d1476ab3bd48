"""Queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerstrata.llm import (
    collocations,
    compact_windows,
    curriculum,
    decontaminate,
    edit_counts,
    fuzzy_lines,
    packing,
    prefix_parse,
    projection,
    quotes,
    simhash_dedup,
    toxicity,
    whitening,
)
from ledgerstrata.llm.common import table

QUERIES = {}
ORACLE = {}


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f
    return register


@query("op1_embedding_near_dedup")
def embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projection.near_vectors(table(spark, sf_dir, "embeddings"))


@query("op2_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@query("op3_simhash_near_dedup")
def simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.simhash_groups(table(spark, sf_dir, "documents"))


@query("op4_token_counts")
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = edit_counts.with_redactions(table(spark, sf_dir, "documents"))
    return edit_counts.count_edited(docs).drop("tree")


@query("op5_toxicity")
def toxicity_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op6_suffix_dedup")
def suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_parse.remove_repeats(table(spark, sf_dir, "documents"))


@query("op7_benchmark_decontamination")
def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op8_chat_formatting", quotes.ORACLE_SQL)
def chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.formatted(table(spark, sf_dir, "conversations"))


@query("op9_line_dedup")
def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy_lines.line_dedup_report(table(spark, sf_dir, "documents"))


@query("op10_substring_dedup")
def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compact_windows.repeated_passages(table(spark, sf_dir, "documents"))


@query("op11_phrase_collocations", collocations.ORACLE_SQL)
def phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query("op12_embedding_whitening")
def embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


@query("op13_source_mixing", curriculum.ORACLE_SQL)
def source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curriculum.mixed(table(spark, sf_dir, "documents"))
