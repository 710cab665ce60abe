"""The registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillpanel.llm.alignment import alignment_query
from tillpanel.llm.common import table
from tillpanel.llm.fingerprints import fingerprint_query
from tillpanel.llm.language import language_query
from tillpanel.llm.line_templates import line_query, line_sql
from tillpanel.llm.ngram_join import ngram_query, ngram_sql
from tillpanel.llm.packing import packing_query
from tillpanel.llm.piece_codec import codec_query
from tillpanel.llm.quality import quality_query, quality_sql
from tillpanel.llm.ranked_search import search_query, search_sql
from tillpanel.llm.sharding import sharding_query
from tillpanel.llm.token_counts import token_count_query
from tillpanel.llm.toxicity import toxicity_query
from tillpanel.llm.warc import warc_query, warc_sql


def op1_best_fit_packing(spark: SparkSession, tables_dir: str) -> DataFrame:
    return packing_query(table(spark, tables_dir, "documents"))


def op2_token_counts(spark: SparkSession, tables_dir: str) -> DataFrame:
    return token_count_query(table(spark, tables_dir, "documents"))


def op3_line_dedup(spark: SparkSession, tables_dir: str) -> DataFrame:
    return line_query(table(spark, tables_dir, "documents"))


def op4_toxicity(spark: SparkSession, tables_dir: str) -> DataFrame:
    return toxicity_query(table(spark, tables_dir, "documents"), table(spark, tables_dir, "labels"))


def op5_language_id(spark: SparkSession, tables_dir: str) -> DataFrame:
    return language_query(table(spark, tables_dir, "documents"))


def op6_ngram_jaccard_join(spark: SparkSession, tables_dir: str) -> DataFrame:
    return ngram_query(table(spark, tables_dir, "documents"))


def op7_piece_codec(spark: SparkSession, tables_dir: str) -> DataFrame:
    return codec_query(table(spark, tables_dir, "documents"))


def op8_warc(spark: SparkSession, tables_dir: str) -> DataFrame:
    return warc_query(table(spark, tables_dir, "pages"))


def op9_fingerprints(spark: SparkSession, tables_dir: str) -> DataFrame:
    return fingerprint_query(table(spark, tables_dir, "documents"))


def op10_quality_rules(spark: SparkSession, tables_dir: str) -> DataFrame:
    return quality_query(table(spark, tables_dir, "documents"))


def op11_ranked_search(spark: SparkSession, tables_dir: str) -> DataFrame:
    return search_query(table(spark, tables_dir, "documents"), table(spark, tables_dir, "benchmark"))


def op12_tokenizer_alignment(spark: SparkSession, tables_dir: str) -> DataFrame:
    return alignment_query(table(spark, tables_dir, "documents"))


def op13_sharding(spark: SparkSession, tables_dir: str) -> DataFrame:
    return sharding_query(table(spark, tables_dir, "documents"))


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    functions = (
        op1_best_fit_packing, op2_token_counts, op3_line_dedup, op4_toxicity, op5_language_id,
        op6_ngram_jaccard_join, op7_piece_codec, op8_warc, op9_fingerprints, op10_quality_rules,
        op11_ranked_search, op12_tokenizer_alignment, op13_sharding,
    )
    return {f.__name__: f for f in functions}


def llm_sql() -> dict[str, str]:
    return {
        "op3_line_dedup": line_sql(),
        "op6_ngram_jaccard_join": ngram_sql(),
        "op8_warc": warc_sql(),
        "op10_quality_rules": quality_sql(),
        "op11_ranked_search": search_sql(),
    }
