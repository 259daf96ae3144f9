"""Column profiles from stored sketches (A1): a new month does not rescan the old ones.

``add_sketches`` keeps, per part of a table (say a month) and column, row and value counts and a
HyperLogLog sketch; parts it is given again replace what was stored of them.  ``merged`` adds counts and unites sketches:
it reads a few kilobytes a part and column, whatever the table holds.  One aggregation, no copy of
the rows per column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG_BUCKETS = 12
#: About three standard errors (1.04 / sqrt(buckets)) of an estimate.
ERROR = 3 * 1.04 / 2 ** (LOG_BUCKETS / 2)


def column_sketches(df: DataFrame, columns: Sequence[str], part: str) -> DataFrame:
    """(part, column_name, n_rows, n_values, n_empty, sketch): one row per part and column."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for i, c in enumerate(columns):
        text = F.col(f"`{c}`").cast("string")
        aggs += [F.count(text).alias(f"v{i}"), F.count_if(F.trim(text) == "").alias(f"e{i}"), F.hll_sketch_agg(text, F.lit(LOG_BUCKETS)).alias(f"s{i}")]
    wide = df.groupBy(F.col(f"`{part}`").alias("part")).agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"v{i}").alias("n_values"), F.col(f"e{i}").alias("n_empty"), F.col(f"s{i}").alias("sketch"))
            for i, c in enumerate(columns)]
    return wide.select("part", "n_rows", F.inline(F.array(*rows)))


def add_sketches(df: DataFrame, columns: Sequence[str], part: str, path: str) -> None:
    """Store the sketches of the parts in ``df``; stored parts that ``df`` does not hold stay."""
    (column_sketches(df, columns, part).repartition("part").write.option("partitionOverwriteMode", "dynamic")
     .mode("overwrite").partitionBy("part").parquet(path))


def merged(stored: DataFrame) -> DataFrame:
    """(column_name, n_rows, n_values, n_null, n_empty, n_distinct: an estimate) over all parts."""
    return stored.groupBy("column_name").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_values").alias("n_values"), (F.sum("n_rows") - F.sum("n_values")).alias("n_null"),
        F.sum("n_empty").alias("n_empty"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_distinct"))


def profile_of(spark: SparkSession, path: str) -> DataFrame:
    return merged(spark.read.parquet(path))
