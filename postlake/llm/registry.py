"""The queries of the text operators and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.llm import (
    chunked_bpe,
    curriculum,
    language,
    lattice,
    line_runs,
    lz_dedup,
    rule_ledger,
    secret_scan,
    simhash,
    spellings,
    syncmers,
    token_align,
    token_files,
)
from postlake.llm.common import documents

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_files.new_path(spark, "token-files")
    token_files.write_token_files(documents(spark, sf_dir), path, BYTE_BPE)
    return token_files.token_digests(spark, path)


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir), size=3)
    return found.select("doc_id", simhash.as_hex().alias("fingerprint"), "component_id")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_runs.without_copied_runs(documents(spark, sf_dir)).select("doc_id", "line_dedup.*")
    return rows.withColumn("kept_sha256", F.sha2(F.coalesce("kept", F.lit("")), 256)).drop("kept")


def op4_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.compared(documents(spark, sf_dir))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(secret_scan.scan(documents(spark, sf_dir)))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    profiles = language.learn(docs)
    marked = docs.select("doc_id", language.held_out().alias("held_out"), "text")
    return language.predict(marked, profiles, ("doc_id", "held_out"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("doc_id", "size", "source_size", "target", "taken", "first_time", "second_time")
    return curriculum.plan(documents(spark, sf_dir)).select(*columns)


def op8_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunked_bpe.round_trip(documents(spark, sf_dir), WORD_BPE)


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lz_dedup.without_copies(documents(spark, sf_dir))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rule_ledger.judged(rule_ledger.ledger(rule_ledger.measure(documents(spark, sf_dir))))
    base = F.col("failed").bitwiseAND(F.lit(rule_ledger.mask(rule_ledger.BASE))) != 0
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), "kept", "failed",
    )


def op11_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_align.aligned(documents(spark, sf_dir), BYTE_BPE, PIECE_BPE)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spellings.variants(spellings.vocabulary(documents(spark, sf_dir), slips=97))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_token_files,
        op2_simhash_near_dedup,
        op3_line_dedup,
        op4_document_fingerprints,
        op5_secret_scan,
        op6_language_id,
        op7_mixing,
        op8_bpe_round_trip,
        op9_substring_dedup,
        op10_quality_rules,
        op11_embedding_near_dedup,
        op12_token_alignment,
        op13_spelling_variants,
    )
}
ORACLES: dict[str, str] = {
    "op3_line_dedup": line_runs.oracle(),
    "op9_substring_dedup": lz_dedup.oracle(),
    "op10_quality_rules": rule_ledger.oracle(),
    "op11_embedding_near_dedup": lattice.oracle(),
}
