"""The registered queries of the text operators, and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    decontaminate,
    filter_audit,
    html_text,
    language_id,
    license_scan,
    pii,
    piece_codec,
    quality_rules,
    secret_scan,
    simhash,
    substring_dedup,
    toxicity,
    vector_codes,
)
from tidemark.llm.common import read
from tidemark.llm.spans import listed
from tidemark.llm import sql

#: Where the vocabulary file is; a parameter of the operator.
MODEL = "piece_bpe_32k.model"


def _sha(text: Column) -> Column:
    return F.sha2(text, 256)


def _count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    rows = quality_rules.judge(docs, labels, keep=["doc_id"])
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = secret_scan.find_secrets(read(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.col("base_spans")
    return rows.select(
        "doc_id",
        _count(base, "assign").alias("n_assign"),
        _count(base, "access").alias("n_access"),
        _count(base, "hex").alias("n_hex"),
        _sha(listed(base)).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decontaminate.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return rows.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        _sha(F.array_join("items", ",")).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = license_scan.find_licenses(read(spark, sf_dir, "documents"), license_scan.known_texts(spark))
    return rows.select(
        F.col("id").alias("doc_id"),
        "digest",
        "license",
        "n_lines",
        F.array_join("line_licenses", ",").alias("line_licenses"),
    )


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pii.find_personal(read(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.col("base_spans")
    return rows.select(
        "doc_id",
        *[_count(base, kind).alias(f"n_{kind}") for kind in pii.BASE],
        _sha(listed(base)).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return piece_codec.digest_documents(docs, public_tokenizers.path(MODEL), keep=["doc_id"])


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return rows.select(F.col("id").alias("doc_id"), simhash.hex_of(F.col("fp")).alias("fingerprint"), "component_id")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = substring_dedup.dedup(read(spark, sf_dir, "documents"), digest=True)
    return rows.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.col("kept").alias("kept_sha256"))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = html_text.extract(read(spark, sf_dir, "pages"), keep=["page_id", "url"])
    return rows.select("page_id", "url", F.col("main_text").alias("text"), F.char_length("main_text").cast("long").alias("n_chars"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    rows = toxicity.score(docs, toxicity.train(docs, labels), keep=["doc_id"])
    return rows.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    rows = language_id.identify(docs, language_id.train(docs), keep=["doc_id"])
    return rows.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, coder = vector_codes.code_vectors(read(spark, sf_dir, "embeddings"))
    rows = vector_codes.with_label_error(rows)
    books = F.lit(coder.digest() if coder else None).cast("string")
    return rows.select(F.col("id").alias("vec_id"), "code", "error", "label_error", books.alias("codebooks_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        op2_secret_scan,
        op3_decontamination,
        op4_license_scan,
        op5_pii,
        op6_sentencepiece,
        op7_simhash,
        op8_substring_dedup,
        op9_html_extraction,
        op10_toxicity,
        op11_filter_audit,
        op12_language_id,
        op13_vector_codes,
    )
}

SQL: dict[str, str] = {
    "op2_secret_scan": sql.SECRETS,
    "op3_decontamination": sql.DECONTAMINATION,
    "op4_license_scan": sql.LICENSES,
    "op5_pii": sql.PII,
    "op8_substring_dedup": sql.SUBSTRINGS,
    "op11_filter_audit": sql.AUDIT,
}
