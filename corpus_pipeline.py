"""The corpus pipeline: five stages, each applying one operator to all rows its predecessor kept.

``run`` applies the stages to ``documents`` in memory of Spark alone; a driver may
as well write each stage's rows and read them again for the next. All stages but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import decontam, line_dedup, quality_rules, spdropout, worddup


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the base rules or the trained verdict reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_rules.keep_rows(docs, quality_rules.train(docs, labels))


def apply_line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the first of each component of near-duplicate lines; documents stay, with what is left of them."""
    return line_dedup.dedup(docs, count_column=None)


def apply_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each component of near-duplicates: SimHash of 5-word shingles, MinHash beyond its radius, exact Jaccard similarity of 0.8."""
    return worddup.keep_one(docs)


def apply_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark passage."""
    return decontam.keep_rows(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def apply_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encodes what is left; every row is decoded again and compared."""
    return spdropout.encode(docs)


STAGES = [
    ("quality_rules", apply_quality_rules),
    ("line_dedup", apply_line_dedup),
    ("near_dedup", apply_near_dedup),
    ("decontamination", apply_decontamination),
    ("sentencepiece", apply_encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs


#: The trained verdict, MinHash, XXH64 and the agenda have no SQL form; tests use brute force.
ORACLE_SQL = None
