"""The corpus pipeline: stages over documents, each written as Parquet and read again.

Every stage takes (spark, docs, sf_dir) and works on all that the one before kept. All but the
last return the columns of ``documents``. doc_id names a document: rows with the same
doc_id share a decision; rows with a NULL doc_id cannot be named and stay as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontaminate, host_rules, ngram_join, paragraphs, pieces_scan
from millrace.llm.linking import small
from millrace.sources import stage


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` without the rows whose doc_id is in ``ids``."""
    return docs.join(small(ids.select("doc_id").where("doc_id is not null").distinct()), "doc_id", "left_anti").select(*docs.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return _without(docs, host_rules.verdicts(docs).where("not kept"))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest doc_id stays."""
    return _without(docs, ngram_join.similarity_classes(docs).where("doc_id != component_id"))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that repeat other documents go; a document of which nothing is left goes too."""
    return paragraphs.without_repeats(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go."""
    return _without(docs, decontaminate.contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).where("contaminated"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id and the ids of every document that is left."""
    rows = pieces_scan.encoded(docs)
    return rows.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "round_trip", "ids")


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("SentencePiece", sentencepiece),
]
#: SQL has no way to express the encoding; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
