"""The registered queries of the package, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mosaiq.llm import decontamination, jaccard_join, license_scan, mixing, oracles, pii, quality_classifier, quality_rules, sharding, substring_dedup, suffix_dedup
from mosaiq.llm.common import documents

Query = Callable[[SparkSession, str], DataFrame]


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.spans_digest(documents(spark, sf_dir))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality_classifier.score_documents(docs, quality_classifier.learn(docs, documents(spark, sf_dir, "labels")))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digest(documents(spark, sf_dir))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(documents(spark, sf_dir))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(documents(spark, sf_dir), n_shards=16, law="rows")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(documents(spark, sf_dir))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join_documents(documents(spark, sf_dir))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leak_report(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As mix_sources; shard is -1 for documents of which nothing is taken."""
    return mixing.mix_sources(documents(spark, sf_dir)).drop("source").withColumn("shard", F.coalesce("shard", F.lit(-1)))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(documents(spark, sf_dir))


QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_pii, op2_quality_classifier, op3_substring_dedup, op4_suffix_dedup, op5_sharding, op6_quality_rules, op7_jaccard_join, op8_decontamination, op9_mixing, op10_license_scan)}
ORACLES: dict[str, str] = {"op3_substring_dedup": oracles.OP3, "op4_suffix_dedup": oracles.OP4, "op7_jaccard_join": oracles.OP7, "op9_mixing": oracles.OP9}
