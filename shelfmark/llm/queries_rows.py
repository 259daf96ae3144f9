"""Queries of operators 3, 6, 10 and 12; SQL cannot express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfmark.llm import best_fit, licenses, packing, sharding
from shelfmark.llm.frames import documents


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.with_shard(documents(spark, sf_dir).select("doc_id"))
    return placed.select("doc_id", F.col("_slot").alias("slot"), F.col("_shard").alias("shard"))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), tokenizer_path())


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


def op12_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.pack(documents(spark, sf_dir), tokenizer_path())


QUERIES = {"op3_sharding": op3_sharding, "op6_packing": op6_packing, "op10_license_scan": op10_license_scan,
           "op12_best_fit": op12_best_fit}
