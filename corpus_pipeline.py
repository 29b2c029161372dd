"""The training-data pipeline: five operators over the table of documents.

Each stage takes what its predecessor kept. ``run`` writes every stage to the shared
folder and reads it back, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stockflow.llm import decontaminate, host_rules, mixing, packing, similar
from stockflow.llm.ship import ship
from stockflow.session import prepare
from stockflow.storage import stored


def _ready(spark: SparkSession) -> SparkSession:
    ship(spark)
    return prepare(spark)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that meet the base rules, from hosts that mostly do."""
    _ready(spark)
    return host_rules.keep_good(docs)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    _ready(spark)
    return similar.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    _ready(spark)
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources meet their target weights."""
    _ready(spark)
    return mixing.mixed(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids packed into rows and written; a description of each row is returned."""
    _ready(spark)
    return packing.write_packed(docs)


STAGES = [
    ("quality_rules", quality),
    ("simhash_dedup", dedup),
    ("decontamination", decontamination),
    ("mixture", mixture),
    ("packed_ids", packed),
]

# Fingerprints, trees and tokenizers are beyond SQL: tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents."""
    docs = _ready(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
