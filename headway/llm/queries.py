"""The registered queries of this package; each reads whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm import (
    bpe,
    collocations,
    decontaminate,
    exact_dedup,
    license_scan,
    line_dedup,
    near_dedup,
    ppm,
    quality_rules,
    rule_ensemble,
    run_detection,
    substring_dedup,
    suffix_dedup,
)
from headway.session import materialize


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_partial_matching(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    out = ppm.score_documents(docs, ~held_out)
    return out.select("doc_id", (~F.col("learned")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = line_dedup.dedup_lines(docs)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def vocabulary() -> tuple[str, str]:
    """Path of the rank table and the pattern that goes with it."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, *vocabulary()).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = decontaminate.scan_documents(docs, table(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_dedup.near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept")


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    scored, _ = rule_ensemble.fit_and_score(docs, table(spark, sf_dir, "labels"), ~held_out)
    return scored.select("doc_id", (~F.col("learn")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = license_scan.scan_licenses(docs)
    return out.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = suffix_dedup.dedup_suffixes(docs, digest=True)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = substring_dedup.dedup_substrings(docs, digest=True)
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    measured = materialize(quality_rules.measure(docs).drop("text"), "op10-measured")
    out = quality_rules.quality_filter(measured)
    return out.select("doc_id", *quality_rules.STATS, "base_failed", "kept")


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("lang", "text")
    return collocations.collocations(docs).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_dedup.exact_duplicates(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op13_run_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = run_detection.detect_runs(docs, lay_periods=True, texts=False)
    return out.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


QUERIES = {
    "op1_partial_matching": op1_partial_matching,
    "op2_line_dedup": op2_line_dedup,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_decontamination": op4_decontamination,
    "op5_near_dedup": op5_near_dedup,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_license_scan": op7_license_scan,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_quality_rules": op10_quality_rules,
    "op11_phrase_collocations": op11_phrase_collocations,
    "op12_exact_dedup": op12_exact_dedup,
    "op13_run_detection": op13_run_detection,
}
