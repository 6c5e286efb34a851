"""One query per operator on the given tables, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from precedent.llm import (
    bpe,
    curriculum,
    decontaminate,
    html_extract,
    language,
    merkle,
    ngram_join,
    pii,
    quality_classifier,
    quality_rules,
    secret_scan,
    spelling,
    token_files,
)
from precedent.llm.common import read_table
from precedent.session import fresh_path

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (read_table(spark, sf_dir, name) for name in ("documents", "labels"))
    return quality_classifier.quality_scores(docs, labels)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = (read_table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return decontaminate.contaminated_documents(docs, items)


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(read_table(spark, sf_dir, "documents"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_rows(read_table(spark, sf_dir, "documents"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "token-files")
    token_files.write_token_files(read_table(spark, sf_dir, "documents"), path, TOKENIZER)
    rows = token_files.with_crc(token_files.read_tokens(spark, path))
    return rows.join(F.broadcast(token_files.part_starts(spark, path)), "part").select(
        "doc_id", (F.col("base") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"
    )


def op6_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(read_table(spark, sf_dir, "documents"), TOKENIZER)


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_documents(read_table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules.quality_columns(read_table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = secret_scan.scan_secrets(read_table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_text", 256).alias("base_sha256"), "spans"
    )


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_texts(read_table(spark, sf_dir, "pages"))


def op11_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = curriculum.mix(read_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "source_size", "target", "taken")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(read_table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(read_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_decontamination": op2_decontamination,
    "op3_pii": op3_pii,
    "op4_language": op4_language,
    "op5_token_files": op5_token_files,
    "op6_bpe_round_trip": op6_bpe_round_trip,
    "op7_ngram_join": op7_ngram_join,
    "op8_quality_rules": op8_quality_rules,
    "op9_secret_scan": op9_secret_scan,
    "op10_html_extraction": op10_html_extraction,
    "op11_curriculum_mix": op11_curriculum_mix,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_spelling_variants": op13_spelling_variants,
}
