"""Corpus preparation: five operators of ``headway.llm`` in a row over the documents.

Each stage takes (spark, docs, sf_dir), works on every row that the one before it has
kept, and returns the columns of ``documents`` (the last one returns token ids).  ``run``
writes each stage's result as Parquet in the shared folder and reads it back for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm import bpe, decontaminate, line_dedup, near_dedup, quality_rules
from headway.llm.queries import table, vocabulary
from headway.session import materialize

#: The last stage cannot be written in SQL; the tests hold ``run`` against plain Python.
ORACLE_SQL = None


def _sized(docs: DataFrame) -> DataFrame:
    """``docs`` with n_chars brought up to date."""
    return docs.withColumn("n_chars", F.char_length("text").cast("long"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the fixed and the adaptive quality rules keep."""
    measured = materialize(quality_rules.measure(docs), "pipeline-measured")
    return quality_rules.quality_filter(measured).where("kept").select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that three documents or more hold stay in one of them; documents left without a word go."""
    out = line_dedup.dedup_lines(docs)
    emptied = (F.col("n_dropped") > 0) & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return _sized(out.where(~F.coalesce(emptied, F.lit(False))).select(*docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return near_dedup.drop_near_duplicates(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages cut out; documents that are mostly such passages go."""
    return _sized(decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark")))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids (little-endian unsigned 32-bit) and the text decoded from them."""
    out = bpe.encode_and_decode(docs.select("doc_id", "lang", "source", "text"), *vocabulary())
    return out.select("doc_id", "lang", "source", "n_tokens", "ids", "text")


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("near dedup", near_duplicates),
    ("decontamination", benchmark),
    ("byte BPE", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
