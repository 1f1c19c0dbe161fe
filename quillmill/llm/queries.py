"""Queries of this subpackage for the driver contract: ``opN_<name>`` over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillmill.llm.common import read_table
from quillmill.llm.oracles import ORACLE_SQL  # noqa: F401


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillmill.llm.token_counts import count_tokens

    return count_tokens(read_table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillmill.llm.language_id import fit, predict

    docs = read_table(spark, sf_dir, "documents")
    return predict(docs, fit(docs))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillmill.llm.packing import pack_documents

    return pack_documents(read_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op3_token_counts, op9_language_id, op10_packing)}


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillmill.llm.substring_dedup import dedup_substrings

    return dedup_substrings(read_table(spark, sf_dir, "documents"))


QUERIES["op1_substring_dedup"] = op1_substring_dedup


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillmill.llm.suffix_dedup import dedup_suffixes

    return dedup_suffixes(read_table(spark, sf_dir, "documents")).drop("kept")


QUERIES["op7_suffix_dedup"] = op7_suffix_dedup


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillmill.llm.jaccard_join import jaccard_components

    return jaccard_components(read_table(spark, sf_dir, "documents")).drop("set_key")


QUERIES["op8_ngram_jaccard_join"] = op8_ngram_jaccard_join


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillmill.llm.decontaminate import contaminations

    return contaminations(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillmill.llm.license_scan import scan_licenses

    return scan_licenses(read_table(spark, sf_dir, "documents")).drop("matches")


QUERIES["op5_benchmark_decontamination"] = op5_benchmark_decontamination
QUERIES["op2_license_scan"] = op2_license_scan


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillmill.llm.lm_score import score_documents

    return score_documents(read_table(spark, sf_dir, "documents"))


QUERIES["op6_lm_scoring"] = op6_lm_scoring


def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillmill.llm.embedding_dedup import near_duplicates

    return near_duplicates(read_table(spark, sf_dir, "embeddings"))


QUERIES["op4_embedding_near_dedup"] = op4_embedding_near_dedup
