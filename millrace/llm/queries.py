"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam, langid, line_dedup, quality_lr, quality_rules, secret_scan, simhash, spdropout, suffixdup, toxicity
from .runtime import bucket_of
from .sql import ORACLE_SQL as ORACLE_SQL


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("simhash"), 16, "0")).alias("fingerprint"), "component_id")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup(_read(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixdup.dedup(_read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels")
    remainder = bucket_of(F.col("doc_id"), 5)
    model = quality_lr.train(docs, labels, remainder != 0)
    scored = quality_lr.score(docs, model, (remainder == 0).alias("held_out"))
    return scored.select("doc_id", "held_out", F.col("quality_score").alias("score"), (F.col("quality_score") >= quality_lr.THRESHOLD).cast("int").alias("predicted"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    remainder = bucket_of(F.col("doc_id"), 4)
    return langid.identify(docs, langid.train(docs, remainder != 2), (remainder == 2).alias("held_out"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_all(_read(spark, sf_dir, "documents"))
    kinds = [r.kind for r in secret_scan.BASE_RULES]
    base = F.filter("findings", lambda f: f["kind"].isin(kinds))

    def count(kind: str) -> Column:
        return F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, kinds), F.sha2(secret_scan.digest(base).cast("binary"), 256).alias("base_sha256"), secret_scan.digest(F.col("findings")).alias("spans"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spdropout.encode(_read(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels")
    return toxicity.score(docs, toxicity.train(docs, labels))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels")
    return quality_rules.judge(docs, quality_rules.train(docs, labels))


QUERIES = {f.__name__: f for f in (op1_simhash_near_dedup, op2_line_dedup, op3_decontamination, op4_suffix_array_dedup, op5_quality_classifier, op6_language_id, op7_secret_scan, op8_sentencepiece, op9_toxicity, op10_quality_rules)}
