"""The corpus pipeline: quality rules, near duplicates, benchmark leaks, the mix of sources, shards.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read again as the docs of the next.
All but the last return the columns of documents; the last returns the manifest of the shards: one row for each document
of the mix, as often as the mix repeats it, with its shard and slot. Each stage is told by its input alone, handles null
texts, ids, languages and sources as its operator does, and gives an empty table for an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mosaiq.llm import decontamination, jaccard_join, mixing, quality_rules, sharding
from mosaiq.llm.common import cut, documents


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the outlier test of their language and source keep."""
    return quality_rules.keep_good(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document of least doc_id."""
    return jaccard_join.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontamination.drop_leaked(docs, documents(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix; one that the mix repeats stands there as often, a part of it counting as a whole."""
    return mixing.mixed_documents(docs)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The manifest: shard and slot of every row, with shards of equal counts."""
    return sharding.shard_documents(docs, n_shards=16, law="rows")


STAGES = [
    ("quality_rules", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]
#: SQL can express neither the estimates nor the components, so a plain version in the tests takes its place.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        docs = docs if i == len(STAGES) - 1 else cut(docs)
    return docs
