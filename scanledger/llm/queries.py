"""Registered queries of the corpus operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scanledger.llm import sql
from scanledger.llm.bpe import encode_and_decode
from scanledger.llm.conversations import damage, repair_conversations, repaired_digests
from scanledger.llm.exact import exact_groups
from scanledger.llm.language import fit_languages, predict_languages
from scanledger.llm.line_dedup import drop_repeated_lines
from scanledger.llm.mixing import mix_sources
from scanledger.llm.quality_rules import COUNTS, fit_rules, judge_quality
from scanledger.llm.repeats import remove_repeats
from scanledger.llm.secret_scan import KINDS, find_secrets, listed
from scanledger.llm.simhash import near_groups
from scanledger.llm.spelling import spelling_variants, word_counts
from scanledger.llm.token_files import token_files
from scanledger.llm.url_rules import judge_urls


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = fit_rules(docs, _table(spark, sf_dir, "labels"))
    return judge_quality(docs, rules).select(
        "doc_id", *(f"stats.{c}" for c in COUNTS), "base_failed", "kept", "rule"
    )


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_table(spark, sf_dir, "documents"))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(_table(spark, sf_dir, "documents"))


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_repeats(_table(spark, sf_dir, "documents"), with_bytes=False)
    left = (F.col("n_bytes") - F.col("n_removed")).alias("n_kept")
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", left)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_repeated_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    text = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(text, 256).alias("kept_sha256"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return predict_languages(docs, fit_languages(docs))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(_table(spark, sf_dir, "documents"), added_tokens=True)


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(_table(spark, sf_dir, "pages"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(_table(spark, sf_dir, "documents"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    digests = ("n_tokens", "ids_sha256", "decoded_sha256")
    return encode_and_decode(docs, with_ids=False).select("doc_id", *(f"encoded.{c}" for c in digests))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(word_counts(_table(spark, sf_dir, "documents"), damage=True))


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(_table(spark, sf_dir, "documents"))
    counts = (F.size(kind).cast("long").alias(f"n_{kind}") for kind in KINDS[:3])
    base = F.sha2(F.encode(listed(KINDS[:3]), "UTF-8"), 256)
    return found.select("doc_id", *counts, base.alias("base_sha256"), listed(KINDS).alias("spans"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = damage(_table(spark, sf_dir, "conversations"))
    return repaired_digests(rows, repair_conversations(rows))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_source_mixing": op2_source_mixing,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_suffix_array_dedup": op4_suffix_array_dedup,
    "op5_line_dedup": op5_line_dedup,
    "op6_language_id": op6_language_id,
    "op7_token_files": op7_token_files,
    "op8_url_filters": op8_url_filters,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_secret_scan": op12_secret_scan,
    "op13_conversation_repair": op13_conversation_repair,
}
ORACLES: dict[str, str] = {
    "op2_source_mixing": sql.SOURCE_MIXING,
    "op5_line_dedup": sql.LINE_DEDUP,
    "op8_url_filters": sql.URL_FILTERS,
    "op9_exact_dedup": sql.EXACT_DEDUP,
    "op11_spelling_variants": sql.SPELLING,
    "op12_secret_scan": sql.SECRET_SCAN,
    "op13_conversation_repair": sql.CONVERSATION_REPAIR,
}
