"""The operators' queries over the driver's tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quaywatch.llm import collisions, contamination, mixing, ngramjoin, oracles, packing, privacy, quality, repeats, secrets, sharding
from quaywatch.llm.tables import table


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(table(spark, sf_dir, "documents"))


def op2_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collisions.near_duplicates(table(spark, sf_dir, "embeddings"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.decide(table(spark, sf_dir, "documents"))


def op5_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.passages(table(spark, sf_dir, "documents")).drop("text_key")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digests(packing.pack(table(spark, sf_dir, "documents")))


def op7_ngramjoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramjoin.join(table(spark, sf_dir, "documents")).drop("text_key", "root")


def op8_privacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return privacy.find(table(spark, sf_dir, "documents"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_documents(table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_sharding, op2_collisions, op3_decontaminate, op4_mixing, op5_repeats, op6_packing, op7_ngramjoin, op8_privacy, op9_secrets, op10_quality)}


def oracle_sql() -> dict[str, str]:
    return {"op1_sharding": oracles.SHARDS, "op2_collisions": oracles.NEAR_VECTORS, "op7_ngramjoin": oracles.NGRAM_JOIN, "op3_decontaminate": oracles.DECONTAMINATE, "op5_repeats": oracles.REPEATS}
