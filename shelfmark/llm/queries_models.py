"""Queries of operators 1, 2 and 8; tested by held-out figures and brute force."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfmark.llm import lang_id, lm_score, toxicity
from shelfmark.llm.frames import documents, held_out


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    model = lang_id.train(docs, ~held_out("doc_id", 4, 2))
    rows = docs.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "text")
    return lang_id.identify(rows, model)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.train(docs, labels, ~held_out("doc_id", 5, 0))
    rows = docs.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "text")
    return toxicity.score(rows, model).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    out = lm_score.scored(docs, ~held_out("doc_id", 5, 1))
    return out.select("doc_id", held_out("doc_id", 5, 1).alias("held_out"), F.col("_n_tokens").alias("n_tokens"),
                      F.col("_n_known").alias("n_known"), F.col("_train_tokens").alias("train_tokens"),
                      F.col("_base").alias("base_score"), F.col("_score").alias("score"))


QUERIES = {"op1_language_id": op1_language_id, "op2_toxicity": op2_toxicity, "op8_lm_score": op8_lm_score}
