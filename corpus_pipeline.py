"""The corpus pipeline: toxic documents go, repeated lines go, one document of each group of similar ones stays,
documents with benchmark items go, and the rest is encoded and decoded.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; ``run`` writes each
stage's result as Parquet in the shared folder and reads it again. The first stage learns (no SQL says what), so there is
no ORACLE_SQL; tests hold each stage against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelex.llm import bpe, decontaminate, line_dedup, ngram_join, toxicity
from pagelex.llm.common import table, written


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from labels and these documents, finds toxic go."""
    return toxicity.without_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier line matches go, short ones too, and with them documents that lose every line with a word (all of it stands
    in others); n_chars follows the text."""
    kept = line_dedup.without_repeated_lines(docs, keep_emptied=False)
    return kept.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in kept.columns else kept


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents, the one of the smallest doc_id stays."""
    return ngram_join.one_of_each(docs)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of what is left."""
    return bpe.digest(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("line_dedup", without_repeated_lines),
    ("ngram_join", one_of_each),
    ("decontamination", without_leaks),
    ("byte_bpe", encoded),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
