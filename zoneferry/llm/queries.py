"""Registered queries: each applies one operator to its whole table."""

from __future__ import annotations

import string
import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from zoneferry.llm import decontam, lines, merkle, neardup, packing, pages, periodic, quality, secrets, substrings, tokencount, toxicity, warc
from zoneferry.llm.common import table, tokenizer_path


def op1_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.report(table(spark, sf_dir, "documents"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substrings.without_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pages.main_text(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    counted = tokencount.token_counts(
        table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )
    return counted.withColumn("path", F.regexp_extract("path", "(part-[0-9]+)-[^/]*$", 1)).withColumnRenamed("path", "file")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where 5 divides a document's crc32, its text is found in lower case later."""
    marked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    found = merkle.build(table(spark, sf_dir, "documents"), F.when(marked, lowered))
    return merkle.proofs(found).withColumnRenamed("proof", "proof_sha256")


def planted_period(doc_id: int | None, words: list) -> list:
    """The words, from some place on repeated with a period in every tenth document."""
    if doc_id is None or not words:
        return words
    g, tenth = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if tenth:
        return words
    start = g % len(words)
    period = 1 + (len(words) - start) // (3 + g % 8)
    return words[:start] + [words[start + i % period] for i in range(len(words) - start)]


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.find(table(spark, sf_dir, "documents"), planted_period)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = F.col("strongest")
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    held_out = toxicity.held_out(F.col("doc_id")).alias("held_out")
    return scored.select("doc_id", held_out, "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), "spans")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_minhash_neardup,
        op2_line_dedup,
        op3_secret_scan,
        op4_decontamination,
        op5_warc,
        op6_quality_rules,
        op7_packing,
        op8_substring_dedup,
        op9_html_extraction,
        op10_token_counts,
        op11_merkle_manifest,
        op12_periodic_runs,
        op13_toxicity,
    )
}
