"""A corpus pipeline of five stages: raw documents in, packed sequences out.

Every stage takes (spark, docs, sf_dir) and works on all rows that its
predecessor kept; its result is written and read again before the next one
starts.  All but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfmark.llm import decontaminate, line_dedup, near_dup, packing, quality_rules
from shelfmark.llm.frames import documents, scratch_scope, written
from shelfmark.llm.queries_rows import tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text passes the threshold table."""
    return quality_rules.keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows; lines that an earlier document holds are cut, ``n_chars`` follows."""
    return line_dedup.cut_lines(docs, length_col="n_chars" if "n_chars" in docs.columns else None)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every group of near copies."""
    return near_dup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that share no window of words with the benchmark."""
    return decontaminate.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a training sequence."""
    return packing.pack(docs, tokenizer_path())


STAGES = [("quality_rules", quality), ("line_dedup", lines), ("near_dedup", near_duplicates),
          ("decontamination", decontamination), ("packing", packed)]

#: Tokens and the order along the curve have no SQL form; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        with scratch_scope(spark):  # a stage's own tables go when its result is written
            docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
