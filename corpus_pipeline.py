"""The corpus pipeline: documents in, a mixed and sharded training corpus out.

Each stage takes and returns a DataFrame; ``run`` writes what a stage returns as Parquet and reads it for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siftlake.llm import crf_toxicity, fair_mixing, setsketch_dedup, simhash_decontamination, tree_sharding
from siftlake.workspace import Scratch


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold."""
    return crf_toxicity.without_toxic(docs, _table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the one with the smallest id."""
    return setsketch_dedup.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    return simhash_decontamination.without_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return fair_mixing.repeated(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard and its slot in it."""
    return tree_sharding.assign(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near-dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]

# Learned scores and sketches have no SQL form; the tests compare with the operators' brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. Each stage's rows stay until the next stage has read them."""
    scratch = Scratch(spark, "pipeline")
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before, docs = docs, scratch.settle(stage(spark, docs, sf_dir), name)
        if hasattr(before, "settled_at"):
            scratch.drop(before)
    return docs
