"""The corpus pipeline: stages that each take and return documents.

Quality rejection, near-duplicate removal, decontamination and mixing keep the
columns of documents; sharding, the last, names each row's shard.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quaywatch.llm import contamination, mixing, ngramjoin, quality, sharding
from quaywatch.llm.tables import table, written


def accept_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return ngramjoin.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return contamination.remove(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents once for each time that the mix takes them."""
    return mixing.mix(docs, place=False)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard of each row: doc_id, shard, depth, shard_bytes, shard_rows."""
    return sharding.shards(docs)


STAGES = [("quality", accept_quality), ("near_copies", drop_near_copies), ("decontaminate", decontaminate), ("mix", mix_sources), ("shard", shard)]
#: The classifier, the join over its survivors and the mix aren't for SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each stage's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"stage-{name}")
    return docs
